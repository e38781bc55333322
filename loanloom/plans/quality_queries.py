"""Registered queries: schema, quality, features, outliers and summary tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom.functions.scalars import replace_infinite
from loanloom.operators import features, outliers, quality, schema, summary
from loanloom.operators.quantiles import fit_quantile_bins
from loanloom.operators.stats import binary_target
from loanloom.plans.applications import NUMERIC, applications, split_tables
from loanloom.plans.registry import query
from loanloom.session import shared_path, stage
from loanloom.sources import tables


def rounded(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


def each(names, template):
    """One UNION ALL branch per name for the check SQL."""
    return " UNION ALL ".join(template.format(c=n) for n in names)


AGE_SQL = """CASE WHEN -days_birth / 365.0::DOUBLE <= 0 THEN NULL
  WHEN -days_birth / 365.0::DOUBLE <= 25 THEN '18-25' WHEN -days_birth / 365.0::DOUBLE <= 35 THEN '26-35'
  WHEN -days_birth / 365.0::DOUBLE <= 45 THEN '36-45' WHEN -days_birth / 365.0::DOUBLE <= 55 THEN '46-55'
  WHEN -days_birth / 365.0::DOUBLE <= 65 THEN '56-65' WHEN days_birth IS NULL THEN NULL ELSE '65+' END"""


@query("default_rate_by_age_group", f""", g AS (SELECT {AGE_SQL} AS age_group, target FROM application),
c AS (SELECT age_group, t.target, count(g.target) AS n FROM (SELECT DISTINCT age_group FROM g) a
  CROSS JOIN (SELECT DISTINCT target FROM g) t LEFT JOIN g USING (age_group, target)
  WHERE age_group IS NOT NULL GROUP BY 1, 2)
SELECT age_group, target, n, round(n * 100.0 / sum(n) OVER (PARTITION BY age_group), 6) AS pct FROM c""")
def default_rate_by_age_group(spark, sf_dir):
    apps = applications(spark, sf_dir).select(
        "target", features.bin_age_into_groups("days_birth").alias("age_group")
    )
    return rounded(summary.category_by_target(apps, "age_group", "target"), "pct")


@query("read_csv_applications", """
SELECT sk_id_curr, amt_credit, days_birth, name_type_suite FROM application""")
def read_csv_applications(spark, sf_dir):
    path = shared_path(spark, "csv")
    source = applications(spark, sf_dir).select(
        "sk_id_curr", "amt_credit", "days_birth", "name_type_suite"
    )
    tables.write_csv(source.toDF(*[c.upper() for c in source.columns]), path)
    return schema.lower_column_names(tables.read_csv(
        spark, path, "SK_ID_CURR bigint, AMT_CREDIT double, DAYS_BIRTH int, NAME_TYPE_SUITE string"
    ))


@query("read_parquet_applications", """
SELECT dataset, count(*) AS n, round(sum(amt_credit), 2) AS credit FROM application GROUP BY 1""")
def read_parquet_applications(spark, sf_dir):
    path = shared_path(spark, "parquet")
    tables.write_parquet(
        applications(spark, sf_dir).select("sk_id_curr", "amt_credit", "dataset"), path, ["dataset"]
    )
    return tables.read_parquet(spark, path).groupBy(F.col("dataset").cast("string")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("amt_credit"), 2).alias("credit")
    )


@query("recoded_categories", """
SELECT sk_id_curr, CAST(CAST(round(target, 0) AS INTEGER) AS VARCHAR) AS target,
  CAST(CAST(round(CAST(region_rating_client AS DOUBLE), 0) AS INTEGER) AS VARCHAR)
    AS region_rating_client FROM application""")
def recoded_categories(spark, sf_dir):
    apps = applications(spark, sf_dir).select(
        "sk_id_curr", "target", F.col("region_rating_client").cast("double")
    )
    return schema.recode_as_category(apps, ["target", "region_rating_client"])


_INT_CASE = """CASE WHEN lo >= -128 AND hi <= 127 THEN 'tinyint'
  WHEN lo >= -32768 AND hi <= 32767 THEN 'smallint'
  WHEN lo >= -2147483648 AND hi <= 2147483647 THEN 'int' ELSE 'bigint' END"""
_INTS = {"sk_id_curr": "bigint", "target": "int", "loan_term_years": "int", "days_birth": "int",
         "days_id_publish": "int"}
_FLOATS = ["amt_income_total", "amt_credit", "amt_goods_price", "ext_source_2"]


@query("narrowed_types", ", b AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS old_type, min({c}) AS lo, max({c}) AS hi FROM application"
    for c, t in _INTS.items()) + ")" + f"""
SELECT column_name, old_type, {_INT_CASE} AS new_type FROM b
UNION ALL """ + each(_FLOATS, """SELECT '{c}', 'double', CASE WHEN min({c}) >= -3.4028234663852886e38
  AND max({c}) <= 3.4028234663852886e38 THEN 'float' ELSE 'double' END FROM application"""))
def narrowed_types(spark, sf_dir):
    return schema.narrow_types(applications(spark, sf_dir).select(*_INTS, *_FLOATS))[1]


@query("downscaled_test_rows", """
SELECT sk_id_curr, CAST(TRY_CAST(days_birth AS SMALLINT) AS INTEGER) AS days_birth,
  CASE WHEN organization_type IN (SELECT organization_type FROM application WHERE dataset = 'train')
    THEN organization_type END AS organization_type
FROM application WHERE dataset = 'test'""")
def downscaled_test_rows(spark, sf_dir):
    train, test = split_tables(stage(applications(spark, sf_dir).select(
        "sk_id_curr", "days_birth", "organization_type", "dataset")))
    narrow = schema.downscale_dtypes(train, test)[1]
    # the fitted types follow the data, the result type must not
    return narrow.select(F.col("sk_id_curr").cast("bigint"), F.col("days_birth").cast("int"),
                         "organization_type")


@query("aligned_columns", """
SELECT amt_credit, 0 AS name_housing_type_with_parents, code_gender FROM application""")
def aligned_columns(spark, sf_dir):
    return schema.align_columns(
        applications(spark, sf_dir), ["amt_credit", "name_housing_type_with_parents", "code_gender"]
    )


@query("table_shape", """
SELECT count(*) AS n_rows, CAST(25 AS BIGINT) AS n_columns FROM application""")
def table_shape(spark, sf_dir):
    return schema.shape(applications(spark, sf_dir).drop("application_time"))


@query("first_rows", """
SELECT sk_id_curr, amt_credit, target FROM application ORDER BY sk_id_curr LIMIT 5""")
def first_rows(spark, sf_dir):
    return schema.preview(
        applications(spark, sf_dir).select("sk_id_curr", "amt_credit", "target"), 5, ["sk_id_curr"]
    )


@query("null_guard", ", m AS (" + each(NUMERIC, """
SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing FROM application""")
       + ") SELECT column_name, n_missing FROM m WHERE n_missing > 0")
def null_guard(spark, sf_dir):
    return quality.missing_percentages(applications(spark, sf_dir).select(*NUMERIC)).drop("pct")


@query("infinity_replaced", """
SELECT sk_id_curr, CASE WHEN amt_income_total = 0 THEN 1e6::DOUBLE
  ELSE amt_credit / amt_income_total END AS ratio FROM application""")
def infinity_replaced(spark, sf_dir):
    income = F.col("amt_income_total")
    raw = F.when(income == 0, F.lit(float("inf"))).otherwise(F.try_divide("amt_credit", income))
    return applications(spark, sf_dir).select("sk_id_curr", replace_infinite(raw).alias("ratio"))


_ALL = NUMERIC + ["name_income_type", "organization_type", "name_type_suite"]


@query("kept_columns", ", u AS (SELECT * FROM application), " + """t AS (
  SELECT * FROM application WHERE dataset = 'train'), r AS (""" + each(NUMERIC, """
SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) * 1.0::DOUBLE / count(*) AS missing_ratio,
  var_samp({c}) AS variance, (SELECT abs(corr({c}, target_signal)) FROM t) AS r FROM u""") + """)
SELECT feature, round(missing_ratio, 6) AS missing_ratio, round(sqrt(variance), 4) AS std_dev,
  round(r, 6) AS abs_correlation, CAST(missing_ratio <= 0.3 AND variance > 0.01 AND r >= 0.05
    OR feature IN ('amt_income_total', 'amt_annuity') AS INTEGER) AS kept FROM r
UNION ALL """ + each(["name_income_type", "organization_type", "name_type_suite"], """
SELECT '{c}', round(count(*) FILTER ({c} IS NULL) * 1.0::DOUBLE / count(*), 6), NULL, NULL,
  CAST(count(*) FILTER ({c} IS NULL) * 1.0::DOUBLE / count(*) <= 0.3 AS INTEGER) FROM u"""))
def kept_columns(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select("target_signal", "dataset", *_ALL))
    train, test = split_tables(apps)
    report = quality.feature_reduction_report(
        train, test.drop("target_signal"), "target_signal",
        essential=["amt_income_total", "amt_annuity"],
    )
    rows = [(r["feature"], r["missing_ratio"], r["variance"], r["abs_correlation"], int(r["kept"]))
            for r in report]
    out = spark.createDataFrame(rows, "feature string, missing_ratio double, variance double, "
                                      "abs_correlation double, kept int")
    return rounded(out, "missing_ratio", "abs_correlation").withColumn(
        "std_dev", F.round(F.sqrt("variance"), 4)).drop("variance")


@query("reduced_tables", """
SELECT target_signal AS target, amt_income_total, amt_credit, amt_annuity, amt_goods_price
FROM application WHERE dataset = 'train'""")
def reduced_tables(spark, sf_dir):
    columns = ["amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price", "days_birth"]
    apps = stage(applications(spark, sf_dir).select("target_signal", "dataset", *columns))
    train, test = split_tables(apps.withColumnRenamed("target_signal", "target"))
    return quality.initial_feature_reduction(
        train, test.drop("target"), "target",
        essential=["amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price"],
    )[0]


@query("missing_top_n", ", m AS (" + each(
    ["amt_income_total", "amt_goods_price", "ext_source_2", "ext_source_3", "name_type_suite"], """
SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing,
  count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*) AS p FROM application""") + """)
SELECT column_name, n_missing, round(p, 2) AS pct FROM m WHERE n_missing > 0
ORDER BY p DESC, column_name LIMIT 3""")
def missing_top_n(spark, sf_dir):
    return quality.get_top_missing_value_percentages(applications(spark, sf_dir).select(
        "amt_income_total", "amt_goods_price", "ext_source_2", "ext_source_3", "name_type_suite"), 3)


@query("missing_by_dataset", ", m AS (" + each(["amt_goods_price", "ext_source_2", "name_type_suite"], """
SELECT dataset, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing,
  round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 2) AS pct
FROM application GROUP BY dataset""") + """)
SELECT * FROM m WHERE n_missing > 0""")
def missing_by_dataset(spark, sf_dir):
    train, test = split_tables(applications(spark, sf_dir).select(
        "dataset", "amt_goods_price", "ext_source_2", "name_type_suite"))
    return quality.analyze_missing_values(train, test, 5)


@query("duplicated_rows", """, g AS (SELECT count(*) AS n FROM application
  GROUP BY name_income_type, name_education_type, organization_type, days_birth, target)
SELECT CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS n_duplicated FROM g""")
def duplicated_rows(spark, sf_dir):
    return quality.count_duplicated_rows(applications(spark, sf_dir).select(
        "name_income_type", "name_education_type", "organization_type", "days_birth", "target"))


@query("describe_numeric", each(NUMERIC, """
SELECT '{c}' AS feature, count({c}) AS n, count(*) - count({c}) AS n_missing,
  round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
  CAST(max({c}) AS DOUBLE) AS max, round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 8) AS q1,
  round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 8) AS median,
  round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 8) AS q3 FROM application"""))
def describe_numeric(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select(*NUMERIC))
    out = rounded(quality.describe_numeric(apps), "mean", "std", digits=4)
    return rounded(out, "q1", "median", "q3", digits=8)


@query("value_counts_share", """
SELECT name_type_suite AS value, count(*) AS n,
  round(count(*) * 1.0::DOUBLE / sum(count(*)) OVER (), 6) AS share
FROM application WHERE name_type_suite IS NOT NULL GROUP BY 1""")
def value_counts_share(spark, sf_dir):
    return rounded(quality.value_counts(applications(spark, sf_dir), "name_type_suite"), "share")


@query("distinct_counts", each(["amt_income_total", "days_birth", "name_type_suite"], """
SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct FROM application"""))
def distinct_counts(spark, sf_dir):
    return quality.distinct_counts(
        applications(spark, sf_dir), ["amt_income_total", "days_birth", "name_type_suite"]
    )


@query("crosstab_counts", """
SELECT organization_type, t.target, count(a.target) AS n
FROM (SELECT DISTINCT organization_type FROM application) o
CROSS JOIN (SELECT DISTINCT target FROM application) t
LEFT JOIN application a USING (organization_type, target) GROUP BY 1, 2""")
def crosstab_counts(spark, sf_dir):
    return summary.crosstab(applications(spark, sf_dir), "organization_type", "target")


@query("target_diagnosis", """
SELECT 'rows' AS item, count(*) AS n FROM application
UNION ALL SELECT 'distinct', count(DISTINCT target) FROM application
UNION ALL SELECT 'missing', count(*) - count(target) FROM application
UNION ALL SELECT 'value=' || target, count(*) FROM application GROUP BY target""")
def target_diagnosis(spark, sf_dir):
    return quality.diagnose_target(applications(spark, sf_dir).select("target"), "target")


@query("constant_columns", """
SELECT 'rate' AS column_name UNION ALL
SELECT 'suite' FROM application HAVING count(DISTINCT CASE WHEN name_type_suite = 'xna'
  THEN name_type_suite END) = 1""")
def constant_columns(spark, sf_dir):
    suite = F.col("name_type_suite")
    apps = applications(spark, sf_dir).select(
        "amt_credit", F.lit(0.05).alias("rate"), F.when(suite == "xna", suite).alias("suite")
    )
    return spark.createDataFrame(
        [(c,) for c in schema.constant_columns(apps)], "column_name string"
    )


@query("quantile_bins", """, e AS (SELECT quantile_cont(amt_income_total, [0.2, 0.4, 0.6, 0.8]) AS i,
  quantile_cont(amt_credit, [0.2, 0.4, 0.6, 0.8]) AS c FROM application)
SELECT sk_id_curr,
  CASE WHEN amt_income_total <= i[1] THEN 'Q1' WHEN amt_income_total <= i[2] THEN 'Q2'
    WHEN amt_income_total <= i[3] THEN 'Q3' WHEN amt_income_total <= i[4] THEN 'Q4' ELSE 'Q5' END
    AS income_group,
  CASE WHEN amt_credit <= c[1] THEN 'Q1' WHEN amt_credit <= c[2] THEN 'Q2'
    WHEN amt_credit <= c[3] THEN 'Q3' WHEN amt_credit <= c[4] THEN 'Q4' ELSE 'Q5' END
    AS credit_amount_group
FROM application, e""")
def quantile_bins(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select("sk_id_curr", "amt_income_total", "amt_credit"))
    bins = fit_quantile_bins(apps, ["amt_income_total", "amt_credit"], 5)
    return apps.select(
        "sk_id_curr", bins["amt_income_total"].apply().alias("income_group"),
        bins["amt_credit"].apply().alias("credit_amount_group"),
    )


_RATIO_SQL = """
  CASE WHEN amt_income_total = 0 THEN 1e6::DOUBLE ELSE amt_credit / amt_income_total END
    AS debt_to_income_ratio,
  CASE WHEN amt_goods_price = 0 THEN 1e6::DOUBLE ELSE amt_credit / amt_goods_price END
    AS credit_to_goods_ratio,
  CASE WHEN amt_income_total = 0 THEN 1e6::DOUBLE ELSE amt_annuity / amt_income_total END
    AS annuity_to_income_ratio"""


@query("engineered_features", f""", e AS (
  SELECT quantile_cont(amt_income_total, [0.2, 0.4, 0.6, 0.8]) AS i,
    quantile_cont(amt_credit, [0.2, 0.4, 0.6, 0.8]) AS c FROM application),
f AS (SELECT sk_id_curr, {AGE_SQL} AS age_group,
  CASE WHEN amt_income_total <= i[1] THEN 'Q1' WHEN amt_income_total <= i[2] THEN 'Q2'
    WHEN amt_income_total <= i[3] THEN 'Q3' WHEN amt_income_total <= i[4] THEN 'Q4' ELSE 'Q5' END
    AS income_group,
  CASE WHEN amt_credit <= c[1] THEN 'Q1' WHEN amt_credit <= c[2] THEN 'Q2'
    WHEN amt_credit <= c[3] THEN 'Q3' WHEN amt_credit <= c[4] THEN 'Q4' ELSE 'Q5' END
    AS credit_amount_group,
  CASE WHEN amt_income_total = 0 THEN 1 ELSE 0 END AS zero_income_flag, {_RATIO_SQL},
  CASE WHEN amt_credit > amt_goods_price THEN 1 ELSE 0 END AS credit_exceeds_goods
  FROM application, e)
SELECT * REPLACE (round(debt_to_income_ratio, 6) AS debt_to_income_ratio,
  round(credit_to_goods_ratio, 6) AS credit_to_goods_ratio,
  round(annuity_to_income_ratio, 6) AS annuity_to_income_ratio) FROM f""")
def engineered_features(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select(
        "sk_id_curr", "days_birth", "amt_income_total", "amt_credit", "amt_goods_price",
        "amt_annuity"))
    ratios = ["debt_to_income_ratio", "credit_to_goods_ratio", "annuity_to_income_ratio"]
    return rounded(features.engineer_features(apps), *ratios).select(
        "sk_id_curr", "age_group", "income_group", "credit_amount_group", "zero_income_flag",
        *ratios, "credit_exceeds_goods",
    )


_FENCED = ["amt_income_total", "amt_credit", "amt_goods_price", "ext_source_2", "ext_source_3"]
_FENCE_SQL = ", fence AS (" + each(_FENCED, """
SELECT '{c}' AS feature, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM application)""") + """),
wide AS (SELECT """ + ", ".join(
    f"max(lo) FILTER (feature = '{c}') AS lo_{c}, max(hi) FILTER (feature = '{c}') AS hi_{c}"
    for c in _FENCED) + " FROM fence)"
_OUTSIDE_SQL = " OR ".join(f"coalesce({c} < lo_{c} OR {c} > hi_{c}, false)" for c in _FENCED)


@query("iqr_fences", _FENCE_SQL + """
SELECT feature, round(lo, 8) AS lower_fence, round(hi, 8) AS upper_fence FROM fence""")
def iqr_fences(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select(*_FENCED))
    return rounded(outliers.fences_table(apps, _FENCED), "lower_fence", "upper_fence", digits=8)


@query("iqr_anomalies", _FENCE_SQL + f"""
SELECT {', '.join(_FENCED)} FROM (SELECT DISTINCT sk_id_curr, target, {', '.join(_FENCED)}
  FROM application, wide WHERE {_OUTSIDE_SQL})""")
def iqr_anomalies(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select("sk_id_curr", "target", *_FENCED))
    return outliers.detect_anomalies_iqr(apps, _FENCED)


@query("anomaly_flag_rate", _FENCE_SQL + f"""
SELECT CAST({_OUTSIDE_SQL} AS INTEGER) AS is_anomaly, count(*) AS n,
  round(avg(target), 6) AS default_rate FROM application, wide GROUP BY 1""")
def anomaly_flag_rate(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select("target", *_FENCED))
    return outliers.flag_anomalies(apps, _FENCED).groupBy(
        F.col("is_anomaly").cast("int").alias("is_anomaly")
    ).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("target"), 6).alias("default_rate"))


@query("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM application"
    for a in NUMERIC for b in NUMERIC))
def correlation_matrix(spark, sf_dir):
    return rounded(
        summary.correlation_matrix(applications(spark, sf_dir).select(*NUMERIC), NUMERIC), "r"
    )


@query("histogram_percent", """, s AS (SELECT min(amt_credit) AS lo, max(amt_credit) AS hi,
  (max(amt_credit) - min(amt_credit)) / 40 AS w FROM application),
c AS (SELECT CAST(least(floor((amt_credit - lo) / w), 39) AS INTEGER) AS bin, count(*) AS n
  FROM application, s GROUP BY 1)
SELECT 'amt_credit' AS feature, CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * w, 4) AS bin_low,
  round(lo + (b.bin + 1) * w, 4) AS bin_high, coalesce(n, 0) AS n,
  round(coalesce(n, 0) * 100.0::DOUBLE / sum(coalesce(n, 0)) OVER (), 6) AS pct
FROM s, range(40) b(bin) LEFT JOIN c ON c.bin = b.bin""")
def histogram_percent(spark, sf_dir):
    out = summary.histogram(applications(spark, sf_dir).select("amt_credit"), ["amt_credit"], 40)
    return rounded(rounded(out, "bin_low", "bin_high", digits=4), "pct")


def _class_histogram_sql(c, bins):
    return f"""SELECT '{c}' AS feature, CAST(b.bin AS INTEGER) AS bin,
  round(lo + b.bin * w, 4) AS bin_low, round(lo + (b.bin + 1) * w, 4) AS bin_high,
  coalesce(n0, 0) AS n_class_0, coalesce(n1, 0) AS n_class_1, coalesce(n0 + n1, 0) AS n_overall
FROM (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) - min({c}) AS DOUBLE) / {bins} AS w
  FROM application) s, range({bins}) b(bin)
LEFT JOIN (SELECT CAST(least(floor(({c} - lo) / w), {bins - 1}) AS INTEGER) AS bin,
    count(*) FILTER (target_signal = 0) AS n0, count(*) FILTER (target_signal = 1) AS n1
  FROM application, (SELECT CAST(min({c}) AS DOUBLE) AS lo,
    CAST(max({c}) - min({c}) AS DOUBLE) / {bins} AS w FROM application)
  WHERE {c} IS NOT NULL GROUP BY 1) c ON c.bin = b.bin"""


@query("histogram_by_class", " UNION ALL ".join(
    _class_histogram_sql(c, 30) for c in ("amt_credit", "ext_source_2", "days_birth")))
def histogram_by_class(spark, sf_dir):
    names = ["amt_credit", "ext_source_2", "days_birth"]
    apps = stage(applications(spark, sf_dir).select("target_signal", *names))
    return rounded(
        summary.histogram_by_class(apps, names, "target_signal", 30), "bin_low", "bin_high", digits=4
    )


@query("box_summary", each(["amt_credit", "ext_source_3"], """
SELECT '{c}' AS feature, round(q1, 8) AS q1, round(q2, 8) AS median, round(q3, 8) AS q3,
  round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std,
  min({c}) FILTER ({c} >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
  max({c}) FILTER ({c} <= q3 + 1.5 * (q3 - q1)) AS whisker_high
FROM application, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2,
  quantile_cont({c}, 0.75) AS q3 FROM application) GROUP BY q1, q2, q3"""))
def box_summary(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select("amt_credit", "ext_source_3"))
    out = rounded(summary.box_summary(apps, ["amt_credit", "ext_source_3"]), "mean", "std", digits=4)
    return rounded(out, "q1", "median", "q3", digits=8)


@query("distribution_before_after", """, f AS (SELECT avg(amt_goods_price) AS m FROM application),
v AS (SELECT 'before' AS dataset, amt_goods_price AS x FROM application
  UNION ALL SELECT 'after', coalesce(amt_goods_price, m) FROM application, f),
s AS (SELECT min(x) AS lo, (max(x) - min(x)) / 20 AS w FROM v),
c AS (SELECT dataset, CAST(least(floor((x - lo) / w), 19) AS INTEGER) AS bin, count(*) AS n
  FROM v, s WHERE x IS NOT NULL GROUP BY 1, 2),
g AS (SELECT dataset, CAST(bin AS INTEGER) AS bin FROM (SELECT DISTINCT dataset FROM v), range(20) r(bin))
SELECT dataset, 'amt_goods_price' AS feature, bin, coalesce(n, 0) AS n,
  round(coalesce(n, 0) * 100.0::DOUBLE / sum(coalesce(n, 0)) OVER (PARTITION BY dataset), 6) AS pct
FROM g LEFT JOIN c USING (dataset, bin)""")
def distribution_before_after(spark, sf_dir):
    before = stage(applications(spark, sf_dir).select("amt_goods_price"))
    mean = before.agg(F.avg("amt_goods_price")).first()[0]
    after = before.fillna(mean)
    out = summary.distribution_comparison(before, after, "amt_goods_price", 20)
    return rounded(out, "pct").drop("bin_low", "bin_high")


@query("mean_standard_error", """
SELECT name_income_type, count(ext_source_2) AS n, round(avg(ext_source_2), 6) AS mean,
  round(stddev_samp(ext_source_2) / sqrt(count(ext_source_2)), 8) AS std_error
FROM application GROUP BY 1""")
def mean_standard_error(spark, sf_dir):
    out = summary.confidence_interval(
        applications(spark, sf_dir), ["name_income_type"], "ext_source_2"
    )
    return rounded(rounded(out, "mean"), "std_error", digits=8).drop("ci_low", "ci_high")


# The t quantile by its expansion in powers of 1 / v around the normal one.
@query("mean_interval", """, g AS (SELECT organization_type, count(amt_credit) AS n, avg(amt_credit) AS mean,
  stddev_samp(amt_credit) / sqrt(count(amt_credit)) AS std_error, CAST(count(amt_credit) - 1 AS DOUBLE) AS v,
  1.959963984540054::DOUBLE AS z FROM application GROUP BY 1),
t AS (SELECT *, z + (pow(z, 3) + z) / (4 * v) + (5 * pow(z, 5) + 16 * pow(z, 3) + 3 * z) / (96 * pow(v, 2))
  + (3 * pow(z, 7) + 19 * pow(z, 5) + 17 * pow(z, 3) - 15 * z) / (384 * pow(v, 3))
  + (79 * pow(z, 9) + 776 * pow(z, 7) + 1482 * pow(z, 5) - 1920 * pow(z, 3) - 945 * z) / (92160 * pow(v, 4)) AS q FROM g)
SELECT organization_type, n, round(mean, 1) AS mean, round(std_error, 1) AS std_error,
  round(mean - q * std_error, 1) AS ci_low, round(mean + q * std_error, 1) AS ci_high FROM t""")
def mean_interval(spark, sf_dir):
    out = summary.confidence_interval(
        applications(spark, sf_dir), ["organization_type"], "amt_credit"
    )
    return rounded(out, "mean", "std_error", "ci_low", "ci_high", digits=1)


_ATTR = {"amt_credit": 0.00001, "amt_annuity": -0.0002, "days_birth": 0.0001,
         "amt_income_total": -0.00005, "days_id_publish": 0.0003}
_ATTR_SQL = ", a AS (" + " UNION ALL ".join(
    f"""SELECT sk_id_curr AS row_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS feature_value,
  {b}::DOUBLE * ({c} - (SELECT round(avg({c}), 4) FROM application)) AS value FROM application"""
    for c, b in _ATTR.items()) + ")"


def _attributions(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select("sk_id_curr", *_ATTR))
    means = apps.agg(*[F.round(F.avg(c), 4).alias(c) for c in _ATTR]).first().asDict()
    return summary.linear_attributions(apps, "sk_id_curr", _ATTR, means)


@query("attribution_summary", _ATTR_SQL + """, m AS (SELECT feature, avg(abs(value)) AS mean_abs
  FROM a GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY mean_abs, feature) - 1 AS position,
  count(*) OVER () AS k FROM m)
SELECT feature, round(mean_abs, 6) AS mean_abs, CAST(position AS INTEGER) AS position,
  CAST((position >= floor(k * 0.25)) AS INTEGER) + CAST((position >= floor(k * 0.5)) AS INTEGER)
  + CAST((position >= floor(k * 0.75)) AS INTEGER) AS band FROM r""")
def attribution_summary(spark, sf_dir):
    return rounded(summary.attribution_summary(_attributions(spark, sf_dir)), "mean_abs")


@query("attribution_top", _ATTR_SQL + """, r AS (SELECT *, row_number() OVER (
  PARTITION BY row_id ORDER BY abs(value) DESC, feature) AS position FROM a)
SELECT row_id, feature, feature_value, round(value, 6) AS value, CAST(position AS INTEGER) AS position
FROM r WHERE position <= 3""")
def attribution_top(spark, sf_dir):
    return rounded(summary.attribution_top(_attributions(spark, sf_dir), 3), "value")


@query("union_train_test", """
SELECT count(*) AS n, round(sum(amt_credit), 2) AS credit FROM application""")
def union_train_test(spark, sf_dir):
    train, test = split_tables(applications(spark, sf_dir).select("amt_credit", "target", "dataset"))
    return train.drop("target").unionByName(test.drop("target")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("amt_credit"), 2).alias("credit"))


@query("ext_source_mean", """
SELECT sk_id_curr, round(CASE WHEN ext_source_2 IS NULL THEN ext_source_3
  WHEN ext_source_3 IS NULL THEN ext_source_2 ELSE (ext_source_2 + ext_source_3) / 2 END, 6)
  AS ext_source_mean FROM application""")
def ext_source_mean(spark, sf_dir):
    out = features.ext_source_mean(applications(spark, sf_dir))
    return rounded(out, "ext_source_mean").select("sk_id_curr", "ext_source_mean")


@query("ext_zscore_outliers", """, s AS (SELECT avg(amt_credit) AS m, stddev_samp(amt_credit) AS d
  FROM application)
SELECT sk_id_curr FROM application, s WHERE amt_credit < m - 1.5 * d OR amt_credit > m + 1.5 * d""")
def ext_zscore_outliers(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select("sk_id_curr", "amt_credit"))
    fences = outliers.ext_zscore_fences(apps, ["amt_credit"], 1.5)
    return apps.where(outliers.outside(fences)).select("sk_id_curr")


@query("ext_distinct_profiles", """
SELECT DISTINCT name_income_type, organization_type, code_gender, target FROM application""")
def ext_distinct_profiles(spark, sf_dir):
    return applications(spark, sf_dir).select(
        "name_income_type", "organization_type", "code_gender", "target").dropDuplicates()


@query("ext_related_debt", """
SELECT c_custkey, round(d, 2) AS open_debt FROM customer LEFT JOIN (
  SELECT o_custkey, sum(o_totalprice) AS d FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
       with_applications=False)
def ext_related_debt(spark, sf_dir):
    debts = tables.read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    out = features.ext_related_total(
        tables.read_table(spark, sf_dir, "customer").select("c_custkey"), debts, "c_custkey",
        "o_totalprice", "open_debt")
    return rounded(out, "open_debt", digits=2)


@query("ext_rows_without_gaps", """
SELECT sk_id_curr, amt_goods_price, name_type_suite FROM application
WHERE CAST(amt_goods_price IS NULL AS INTEGER) + CAST(name_type_suite IS NULL AS INTEGER) = 0""")
def ext_rows_without_gaps(spark, sf_dir):
    apps = applications(spark, sf_dir).select("sk_id_curr", "amt_goods_price", "name_type_suite")
    return quality.drop_missing(apps, max_row_ratio=0.0)


@query("dropped_columns", """
SELECT amt_credit, code_gender FROM application""")
def dropped_columns(spark, sf_dir):
    apps = applications(spark, sf_dir).select(
        "sk_id_curr", "target", "organization_type", "amt_credit", "code_gender")
    return schema.drop_columns(apps, ["organization_type", "target", "sk_id_curr"])


@query("class_split", """
SELECT target_signal, count(*) AS n, count(ext_source_2) AS n_scored, round(avg(amt_credit), 4) AS credit
FROM application GROUP BY 1""")
def class_split(spark, sf_dir):
    return applications(spark, sf_dir).groupBy("target_signal").agg(
        F.count(F.lit(1)).alias("n"), F.count("ext_source_2").alias("n_scored"),
        F.round(F.avg("amt_credit"), 4).alias("credit"))


@query("union_train_validation", """
SELECT dataset, count(*) AS n FROM (SELECT dataset FROM application WHERE dataset = 'train'
  UNION ALL SELECT dataset FROM application) GROUP BY 1""")
def union_train_validation(spark, sf_dir):
    """Stacking keeps duplicates."""
    apps = applications(spark, sf_dir).select("dataset")
    return apps.where("dataset = 'train'").unionByName(apps).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n"))


@query("target_codes", """
SELECT sk_id_curr, CASE WHEN target_signal = 1 THEN 1 ELSE 0 END AS code FROM application""")
def target_codes(spark, sf_dir):
    """A text target with the values 3 and 7 becomes 0 and 1."""
    apps = applications(spark, sf_dir).select(
        "sk_id_curr", F.when(F.col("target_signal") == 1, "7").otherwise("3").alias("answer"))
    return apps.select("sk_id_curr", binary_target(apps, "answer").alias("code"))


@query("missing_ratio_filter", ", m AS (" + each(_ALL, """
SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) * 1.0::DOUBLE / count(*) AS r
FROM application""") + ") SELECT column_name FROM m WHERE r <= 0.01")
def missing_ratio_filter(spark, sf_dir):
    kept = quality.filter_by_missing(applications(spark, sf_dir).select(*_ALL), 0.01)
    return spark.createDataFrame([(c,) for c in kept], "column_name string")


@query("variance_filter", ", m AS (" + each(NUMERIC, """
SELECT '{c}' AS column_name, var_samp({c}) AS v FROM application""")
       + ") SELECT column_name FROM m WHERE v > 1.0")
def variance_filter(spark, sf_dir):
    kept = quality.filter_by_variance(applications(spark, sf_dir).select(*NUMERIC), NUMERIC, 1.0)
    return spark.createDataFrame([(c,) for c in kept], "column_name string")


@query("correlation_filter", ", m AS (" + each(NUMERIC, """
SELECT '{c}' AS column_name, abs(corr({c}, target_signal)) AS r FROM application""")
       + ") SELECT column_name FROM m WHERE r >= 0.05")
def correlation_filter(spark, sf_dir):
    apps = applications(spark, sf_dir).select("target_signal", *NUMERIC)
    kept = quality.filter_by_correlation(apps, NUMERIC, "target_signal", 0.05)
    return spark.createDataFrame([(c,) for c in kept], "column_name string")
