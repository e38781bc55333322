"""Registered queries: stored profiles, repeated rows, guards, exact tests, the test halves."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom.functions.scalars import vocabulary_one_hot
from loanloom.functions.tails import fisher_two_sided
from loanloom.operators import duplicates, encode, features, profiles, quality, schema, stats, summary
from loanloom.plans.applications import NUMERIC, applications, split_tables
from loanloom.plans.encode_queries import PRIORITIES, _encoding_tables
from loanloom.plans.quality_queries import each, rounded
from loanloom.plans.registry import query
from loanloom.plans.stats_queries import _POOL_SQL, TARGET
from loanloom.session import shared_path, stage

SUITES = ["Children", "Family", "Unaccompanied", "xna"]


@query("merged_profiles", each(NUMERIC, """
SELECT '{c}' AS feature, count({c}) AS n, count(*) - count({c}) AS n_missing, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max
FROM application"""))
def merged_profiles(spark, sf_dir):
    """Profiles of parts are stored in two runs, one of them twice, and merged without the rows."""
    apps = stage(applications(spark, sf_dir).select("code_gender", "dataset", *NUMERIC))
    path = shared_path(spark, "profiles")
    part = F.concat_ws("/", "dataset", "code_gender")
    for runs in ("dataset = 'train'", "dataset = 'test' OR code_gender = 'M'"):
        # a part is complete in each run it is in
        profiles.add_profiles(apps.where(runs), path, NUMERIC, part)
    found = profiles.described(profiles.merge_profiles(profiles.read_profiles(spark, path)))
    return rounded(found, "mean", "std", digits=4).select("feature", "n", "n_missing", "mean", "std", "min", "max")


@query("repeated_rows", """
SELECT name_income_type, organization_type, days_birth, target, count(*) AS n_copies
FROM application GROUP BY ALL HAVING count(*) > 1""")
def repeated_rows(spark, sf_dir):
    return duplicates.repeated_rows(applications(spark, sf_dir).select(
        "name_income_type", "organization_type", "days_birth", "target"))


@query("cleaned_names", """
SELECT sk_id_curr AS sk_id_curr, amt_credit AS amt_credit_eur_, name_type_suite AS name_type_suite,
  days_birth AS _days_birth FROM application""")
def cleaned_names(spark, sf_dir):
    return schema.clean_column_names(applications(spark, sf_dir).select(
        F.col("sk_id_curr").alias("SK_ID_CURR"), F.col("amt_credit").alias("Amt Credit (EUR)"),
        F.col("name_type_suite").alias("NAME - TYPE: suite"), F.col("days_birth").alias("%Days.Birth")))


_GUARDED = ["amt_credit", "days_birth", "ext_source_2", "name_type_suite", "organization_type"]


@query("numeric_guard", ", one AS (SELECT * FROM application LIMIT 1)" + each(_GUARDED, """
SELECT '{c}' AS feature, CAST(typeof({c}) IN ('DOUBLE', 'INTEGER', 'BIGINT') AS INTEGER) AS usable FROM one""")
       + " UNION ALL SELECT 'unknown', 0")
def numeric_guard(spark, sf_dir):
    usable, skipped = schema.usable_numeric(applications(spark, sf_dir), [*_GUARDED, "unknown"])
    return spark.createDataFrame(
        [(f, 1) for f in usable] + [(f, 0) for f in skipped], "feature string, usable int")


@query("complete_columns", each(_GUARDED, """
SELECT '{c}' AS feature, CAST(count(*) = count({c}) AS INTEGER) AS complete FROM application"""))
def complete_columns(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select(*_GUARDED))

    def complete(column):
        try:
            schema.validate_data(apps, [column], "applications")
        except AssertionError:
            return 0
        return 1

    return spark.createDataFrame([(c, complete(c)) for c in _GUARDED], "feature string, complete int")


@query("dropped_by_name", "SELECT sk_id_curr, " + ", ".join(
    f"CASE WHEN name_type_suite = '{w}' THEN 1 ELSE 0 END AS name_type_suite_{w.lower()}" for w in SUITES[:3])
       + " FROM application")
def dropped_by_name(spark, sf_dir):
    wide = applications(spark, sf_dir).select("sk_id_curr", *vocabulary_one_hot("name_type_suite", SUITES))
    return schema.drop_by_name_pattern(wide)


@query("top_importances", """, t AS (SELECT organization_type AS feature,
  round(avg(target_signal), 8) AS importance FROM application GROUP BY 1)
SELECT * FROM t ORDER BY importance DESC, feature LIMIT (
  SELECT greatest(1, CAST(floor(count(*) * 0.3::DOUBLE) AS BIGINT)) FROM t)""")
def top_importances(spark, sf_dir):
    """The best 30 % of the organisations by their share of good answers."""
    table = applications(spark, sf_dir).groupBy(F.col("organization_type").alias("feature")).agg(
        F.round(F.avg(TARGET), 8).alias("importance"))
    return summary.top_share(table, "importance", 0.3)


@query("employed_to_age", """
SELECT sk_id_curr, round(days_id_publish / CAST(days_birth AS DOUBLE), 8) AS ratio FROM application""")
def employed_to_age(spark, sf_dir):
    return applications(spark, sf_dir).select("sk_id_curr", F.round(
        features.ext_employed_to_age("days_id_publish", "days_birth"), 8).alias("ratio"))


@query("fisher_tests", """, t AS (SELECT organization_type AS feature,
  count(*) FILTER (code_gender = 'M' AND target_signal = 1) AS a, count(*) FILTER (code_gender = 'M' AND target_signal = 0) AS b,
  count(*) FILTER (code_gender = 'F' AND target_signal = 1) AS c, count(*) FILTER (code_gender = 'F' AND target_signal = 0) AS d
  FROM application GROUP BY 1),
k AS (SELECT *, unnest(range(greatest(0, a - d), least(a + b, a + c) + 1)) AS k FROM t),
p AS (SELECT *, lgamma(a + b + 1) - lgamma(k + 1) - lgamma(a + b - k + 1) + lgamma(c + d + 1)
  - lgamma(a + c - k + 1) - lgamma(d - a + k + 1) - lgamma(a + b + c + d + 1) + lgamma(a + c + 1)
  + lgamma(b + d + 1) AS lp FROM k),
o AS (SELECT *, max(lp) FILTER (k = a) OVER (PARTITION BY feature) AS seen FROM p)
SELECT feature, a, b, c, d, round(least(1.0::DOUBLE, sum(exp(lp)) FILTER (lp <= seen + 1e-7)), 7) AS p_value
FROM o GROUP BY ALL""")
def fisher_tests(spark, sf_dir):
    """Exact test of gender against the answer in each of the 25 organisations."""
    def cell(gender, y):
        return F.count_if((F.col("code_gender") == gender) & (F.col(TARGET) == y))

    counts = applications(spark, sf_dir).groupBy(F.col("organization_type").alias("feature")).agg(
        cell("M", 1).alias("a"), cell("M", 0).alias("b"), cell("F", 1).alias("c"), cell("F", 0).alias("d"))
    rows = [(*r, round(fisher_two_sided(*r[1:]), 7)) for r in counts.collect()]
    return spark.createDataFrame(rows, counts.schema.add("p_value", "double"))


_ODD = ["name_income_type", "name_education_type", "region_rating_client", "weekday_appr_process_start"]


@query("categorical_p_values", _POOL_SQL + f""",
w AS (SELECT *, count(*) OVER (PARTITION BY feature) AS r, CAST(sum(n0) OVER (PARTITION BY feature) AS DOUBLE) AS t0,
  CAST(sum(n1) OVER (PARTITION BY feature) AS DOUBLE) AS t1 FROM c
  WHERE feature IN ({', '.join(repr(f) for f in _ODD)})),
x AS (SELECT feature, r, sum((n0 - (n0 + n1) * t0 / (t0 + t1)) ** 2 / ((n0 + n1) * t0 / (t0 + t1))
  + (n1 - (n0 + n1) * t1 / (t0 + t1)) ** 2 / ((n0 + n1) * t1 / (t0 + t1))) / 2 AS half FROM w GROUP BY 1, 2),
tail AS (SELECT feature, exp(-half) * list_sum(list_transform(range((r - 1) // 2),
  lambda i: half ** i / gamma(i + 1.0::DOUBLE))) AS p FROM x),
o AS (SELECT *, row_number() OVER (ORDER BY p, feature) AS i, count(*) OVER () AS m FROM tail)
SELECT feature, round(p, 9) AS p_value, round(least(1.0::DOUBLE, min(p * m / i) OVER (
  ORDER BY i DESC ROWS UNBOUNDED PRECEDING)), 9) AS corrected_p_value FROM o""")
def categorical_p_values(spark, sf_dir):
    """Chi-square p-values, raw and adjusted, of features with an odd number of categories.

    Their degrees of freedom are even, where the tail is a finite sum that SQL can state.
    """
    apps = applications(spark, sf_dir).select(TARGET, *_ODD)
    out = stats.run_statistical_analysis(apps, _ODD, TARGET, replicates=2)
    return rounded(out, "p_value", "corrected_p_value", digits=9).select("feature", "p_value", "corrected_p_value")


@query("reduced_test_table", """
SELECT amt_income_total, amt_credit, amt_annuity, amt_goods_price FROM application WHERE dataset = 'test'""")
def reduced_test_table(spark, sf_dir):
    columns = ["amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price", "days_birth"]
    apps = stage(applications(spark, sf_dir).select(TARGET, "dataset", *columns))
    train, test = split_tables(apps.withColumnRenamed(TARGET, "target"))
    return quality.initial_feature_reduction(
        train, test.drop("target"), "target",
        essential=["amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price"])[1]


@query("encoded_test_table", """, t AS (SELECT * FROM application WHERE dataset = 'train'),
s AS (SELECT organization_type, avg(target_signal) AS code, count(*) AS n FROM t GROUP BY 1)
SELECT sk_id_curr, CASE code_gender WHEN 'M' THEN 1 ELSE 0 END AS code_gender,
  CASE WHEN name_type_suite = 'Children' THEN 1 ELSE 0 END AS name_type_suite_children,
  CASE WHEN name_type_suite = 'Family' THEN 1 ELSE 0 END AS name_type_suite_family,
  CASE WHEN name_type_suite = 'Unaccompanied' THEN 1 ELSE 0 END AS name_type_suite_unaccompanied,
  round(CASE WHEN n > 1 THEN code ELSE (SELECT avg(target_signal) FROM t) END, 8) AS organization_type,
  CAST(list_position(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'],
    name_education_type) - 1 AS DOUBLE) AS name_education_type
FROM application LEFT JOIN s USING (organization_type) WHERE dataset = 'test'""")
def encoded_test_table(spark, sf_dir):
    """New rows take the category means of the training rows."""
    train, test = _encoding_tables(spark, sf_dir)
    out = encode.encode_categorical_features(
        train.withColumn("constant", F.lit("same")), test.withColumn("constant", F.lit("same")).drop(TARGET),
        ["code_gender"], ["name_type_suite", "constant"], ["organization_type"],
        ["name_education_type"], {"name_education_type": PRIORITIES}, TARGET)[1]
    return rounded(out, "organization_type", digits=8)
