"""Registered queries: imputation and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom.functions.scalars import lookup, placeholder_to_null
from loanloom.operators import encode, impute
from loanloom.plans.applications import applications, split_tables
from loanloom.plans.quality_queries import rounded
from loanloom.plans.registry import query
from loanloom.session import stage

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("placeholder_to_missing", """
SELECT sk_id_curr, CASE WHEN name_type_suite <> 'xna' THEN name_type_suite END AS name_type_suite
FROM application""")
def placeholder_to_missing(spark, sf_dir):
    return applications(spark, sf_dir).select("sk_id_curr", placeholder_to_null("name_type_suite"))


@query("value_lookup", """
SELECT sk_id_curr, CASE code_gender WHEN 'M' THEN 1 ELSE 0 END AS gender,
  CASE region_rating_client WHEN '1' THEN 10 WHEN '2' THEN 20 ELSE -1 END AS region FROM application""")
def value_lookup(spark, sf_dir):
    return applications(spark, sf_dir).select(
        "sk_id_curr", lookup("code_gender", {"M": 1}, 0).alias("gender"),
        lookup("region_rating_client", {"1": 10, "2": 20}, -1).alias("region"))


_MODE_SQL = """, app AS (SELECT *, CASE WHEN sk_id_curr % 10 IN (2, 3) THEN 'Partner'
  WHEN sk_id_curr % 10 > 8 THEN name_type_suite END AS suite_or_gap FROM application), m AS (""" + (
    " UNION ALL ".join(f"""
SELECT '{c}' AS feature, coalesce({c}, 'Unknown') AS value FROM (SELECT {c} FROM app
  WHERE dataset = 'train' GROUP BY {c} ORDER BY count(*) DESC, {c} NULLS LAST LIMIT 1)"""
                       for c in ("name_type_suite", "suite_or_gap", "organization_type")) + ")")


@query("category_modes", _MODE_SQL + " SELECT feature, value FROM m")
def category_modes(spark, sf_dir):
    train, _ = split_tables(_with_gaps(spark, sf_dir))
    modes = impute.category_modes(train, ["name_type_suite", "suite_or_gap", "organization_type"])
    return spark.createDataFrame(list(modes.items()), "feature string, value string")


def _with_gaps(spark, sf_dir):
    digit = F.col("sk_id_curr") % 10
    return applications(spark, sf_dir).select(
        "sk_id_curr", "dataset", "name_type_suite", "organization_type",
        F.when(digit.isin(2, 3), "Partner").when(digit > 8, F.col("name_type_suite"))
        .alias("suite_or_gap"))


@query("mode_imputed", _MODE_SQL + """
SELECT sk_id_curr, coalesce(name_type_suite, (SELECT value FROM m WHERE feature = 'name_type_suite'))
    AS name_type_suite,
  coalesce(suite_or_gap, (SELECT value FROM m WHERE feature = 'suite_or_gap')) AS suite_or_gap
FROM app WHERE dataset = 'test'""")
def mode_imputed(spark, sf_dir):
    train, test = split_tables(_with_gaps(spark, sf_dir))
    return impute.impute_categorical_features(train, test, "target")[1].select(
        "sk_id_curr", "name_type_suite", "suite_or_gap")


_KNN = ["amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price", "days_birth",
        "days_id_publish", "ext_source_2", "ext_source_3"]
_KNN_SHARED = ["amt_income_total", "amt_credit", "amt_annuity", "days_birth", "days_id_publish"]


@query("knn_imputed", """, pair AS (SELECT q.sk_id_curr, d.amt_goods_price AS g, d.ext_source_2 AS e2,
  d.ext_source_3 AS e3, row_number() OVER (PARTITION BY q.sk_id_curr ORDER BY sqrt(8.0::DOUBLE / 5 * ("""
       + " + ".join(f"(CAST(q.{c} AS DOUBLE) - CAST(d.{c} AS DOUBLE)) ** 2" for c in _KNN_SHARED)
       + """)), d.sk_id_curr) AS rn FROM application q, application d
  WHERE q.amt_goods_price IS NULL AND d.amt_goods_price IS NOT NULL AND d.dataset = 'train')
SELECT sk_id_curr, round(avg(g), 4) AS amt_goods_price, round(avg(e2), 6) AS ext_source_2,
  round(avg(e3), 6) AS ext_source_3 FROM pair WHERE rn <= 5 GROUP BY 1""")
def knn_imputed(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select("sk_id_curr", "dataset", *_KNN))
    model = impute.NeighbourImputer(_KNN, "sk_id_curr").fit(apps.where("dataset = 'train'"))
    gaps = apps.where("amt_goods_price is null").drop("dataset")
    out = rounded(model.transform(gaps), "amt_goods_price", digits=4)
    return rounded(out, "ext_source_2", "ext_source_3").select(
        "sk_id_curr", "amt_goods_price", "ext_source_2", "ext_source_3")


_ENC = ["name_type_suite", "code_gender", "organization_type", "name_education_type", "target_signal"]


def _encoding_tables(spark, sf_dir):
    return split_tables(stage(applications(spark, sf_dir).select("sk_id_curr", "dataset", *_ENC)))


def _label_sql(c):
    return f"""(SELECT {c} AS value, row_number() OVER (ORDER BY {c}) - 1 AS code FROM (
  SELECT DISTINCT coalesce({c}, 'nan') AS {c} FROM application WHERE dataset = 'train'))"""


@query("label_encoded", f"""
SELECT sk_id_curr, CAST(coalesce(a.code, -1) AS INTEGER) AS name_type_suite,
  CAST(coalesce(b.code, -1) AS INTEGER) AS organization_type
FROM application LEFT JOIN {_label_sql('name_type_suite')} a
  ON a.value = coalesce(name_type_suite, 'nan')
LEFT JOIN {_label_sql('organization_type')} b ON b.value = organization_type""")
def label_encoded(spark, sf_dir):
    train, test = _encoding_tables(spark, sf_dir)
    features = ["name_type_suite", "organization_type"]
    coder = encode.LabelEncoder.fit(train, features)
    both = train.unionByName(test).select("sk_id_curr", *features)
    return coder.transform(both)


@query("label_encoded_keys", """, c AS (SELECT amt_credit AS value, row_number() OVER (
  ORDER BY CAST(amt_credit AS VARCHAR)) - 1 AS code FROM (SELECT DISTINCT CAST(
    CAST(amt_credit * 100 AS BIGINT) AS VARCHAR) AS amt_credit FROM application WHERE dataset = 'train'))
SELECT sk_id_curr, CAST(coalesce(code, -1) AS INTEGER) AS credit_code FROM application
LEFT JOIN c ON c.value = CAST(CAST(amt_credit * 100 AS BIGINT) AS VARCHAR)""")
def label_encoded_keys(spark, sf_dir):
    """Thousands of classes: the code table is built by ranges and joined."""
    cents = F.round(F.col("amt_credit") * 100, 0).cast("bigint").cast("string")
    apps = stage(applications(spark, sf_dir).select(
        "sk_id_curr", cents.alias("credit_code"), "dataset"))
    coder = encode.LabelEncoder.fit(apps.where("dataset = 'train'"), ["credit_code"])
    return coder.transform(apps.drop("dataset"))


@query("one_hot", """
SELECT sk_id_curr, """ + ", ".join(
    f"CASE WHEN name_type_suite = '{v}' THEN 1 ELSE 0 END AS name_type_suite_{v.lower()}"
    for v in ("Children", "Family", "Unaccompanied", "xna")) + " FROM application")
def one_hot(spark, sf_dir):
    train, test = _encoding_tables(spark, sf_dir)
    coder = encode.OneHotEncoder.fit(train, ["name_type_suite"])
    return coder.transform(train.unionByName(test).select("sk_id_curr", "name_type_suite"))


@query("loo_target_encoded", """, t AS (SELECT * FROM application WHERE dataset = 'train'),
g AS (SELECT avg(target_signal) AS m FROM t),
s AS (SELECT organization_type, sum(target_signal) AS s, count(*) AS n FROM t GROUP BY 1)
SELECT sk_id_curr, dataset, round(CASE WHEN n IS NULL OR n = 1 THEN m WHEN dataset = 'train'
  THEN (s - target_signal) / (n - 1.0::DOUBLE) ELSE s / n END, 8) AS organization_type
FROM application a LEFT JOIN s USING (organization_type), g""")
def loo_target_encoded(spark, sf_dir):
    train, test = _encoding_tables(spark, sf_dir)
    coder = encode.LeaveOneOutEncoder.fit(train, ["organization_type"], "target_signal")
    parts = [
        coder.transform(df, training).select(
            "sk_id_curr", F.lit(name).alias("dataset"), "organization_type")
        for df, training, name in ((train, True, "train"), (test, False, "test"))
    ]
    return rounded(parts[0].unionByName(parts[1]), "organization_type", digits=8)


@query("ordinal_encoded", """
SELECT sk_id_curr, CASE name_education_type WHEN '5-LOW' THEN 0.0::DOUBLE
  WHEN '3-MEDIUM' THEN 1.0::DOUBLE WHEN '1-URGENT' THEN 2.0::DOUBLE ELSE -1.0::DOUBLE END
  AS name_education_type FROM application""")
def ordinal_encoded(spark, sf_dir):
    apps = applications(spark, sf_dir).select("sk_id_curr", "name_education_type")
    return encode.ordinal_encode(apps, {"name_education_type": ["5-LOW", "3-MEDIUM", "1-URGENT"]})


@query("encoded_train_table", """, t AS (SELECT * FROM application WHERE dataset = 'train'),
s AS (SELECT organization_type, sum(target_signal) AS s, count(*) AS n FROM t GROUP BY 1)
SELECT sk_id_curr, CASE code_gender WHEN 'M' THEN 1 ELSE 0 END AS code_gender,
  CASE WHEN name_type_suite = 'Children' THEN 1 ELSE 0 END AS name_type_suite_children,
  CASE WHEN name_type_suite = 'Family' THEN 1 ELSE 0 END AS name_type_suite_family,
  CASE WHEN name_type_suite = 'Unaccompanied' THEN 1 ELSE 0 END AS name_type_suite_unaccompanied,
  round((s - target_signal) / (n - 1.0::DOUBLE), 8) AS organization_type,
  CAST(list_position(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'],
    name_education_type) - 1 AS DOUBLE) AS name_education_type, target_signal AS target
FROM t JOIN s USING (organization_type)""")
def encoded_train_table(spark, sf_dir):
    train, test = _encoding_tables(spark, sf_dir)
    out = encode.encode_categorical_features(
        train.withColumn("constant", F.lit("same")), test.withColumn("constant", F.lit("same")),
        ["code_gender"], ["name_type_suite", "constant"], ["organization_type"],
        ["name_education_type"], {"name_education_type": PRIORITIES}, "target_signal",
    )[0]
    return rounded(out, "organization_type", digits=8)
