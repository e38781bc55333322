"""Registered queries: rank tests, contingency tables, resampling, full analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom.operators import rank, resampling, stats
from loanloom.plans.applications import CATEGORICAL, NUMERIC, applications
from loanloom.plans.quality_queries import rounded
from loanloom.plans.registry import query
from loanloom.session import stage
from loanloom.sources.tables import read_table

TARGET = "target_signal"


def numeric_table(spark, sf_dir):
    return stage(applications(spark, sf_dir).select(TARGET, *NUMERIC))


_RANK_SQL = ", v AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, {TARGET} AS y FROM application WHERE {c} IS NOT NULL"
    for c in NUMERIC) + """), h AS (SELECT feature, value, count(*) FILTER (y = 0) AS n0,
  count(*) FILTER (y = 1) AS n1 FROM v GROUP BY 1, 2),
b AS (SELECT *, sum(n1) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) - n1
  AS before FROM h),
s AS (SELECT feature, CAST(sum(n0) AS DOUBLE) AS n0, CAST(sum(n1) AS DOUBLE) AS n1,
  CAST(sum(n0 * before) + sum(n0 * n1) * 0.5::DOUBLE AS DOUBLE) AS u,
  CAST(sum((n0 + n1) * (n0 + n1) * (n0 + n1) - (n0 + n1)) AS DOUBLE) AS tie_term
  FROM b GROUP BY 1)"""


@query("cliffs_delta", _RANK_SQL + """
SELECT feature, CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1,
  round(2 * u / (n0 * n1) - 1, 8) AS delta FROM s""")
def cliffs_delta(spark, sf_dir):
    out = stats.rank_statistics(numeric_table(spark, sf_dir), NUMERIC, TARGET)
    return rounded(out, "delta", digits=8).select("feature", "n0", "n1", "delta")


@query("mann_whitney_u", _RANK_SQL + """
SELECT feature, u, tie_term, round((greatest(u, n0 * n1 - u) - n0 * n1 / 2 - 0.5::DOUBLE)
  / sqrt(n0 * n1 / 12 * (n0 + n1 + 1 - tie_term / ((n0 + n1) * (n0 + n1 - 1)))), 6) AS z FROM s""")
def mann_whitney_u(spark, sf_dir):
    out = stats.rank_statistics(numeric_table(spark, sf_dir), NUMERIC, TARGET)
    return rounded(out, "z").select("feature", "u", "tie_term", "z")


_DOCUMENT_SQL = """WITH v AS (SELECT CAST(n_chars AS DOUBLE) AS value, quality AS y
  FROM documents JOIN labels USING (doc_id)),
h AS (SELECT value, count(*) FILTER (y = 0) AS n0, count(*) FILTER (y = 1) AS n1 FROM v GROUP BY 1),
b AS (SELECT *, sum(n1) OVER (ORDER BY value ROWS UNBOUNDED PRECEDING) - n1 AS before FROM h)
SELECT 'n_chars' AS feature, CAST(sum(n0) AS BIGINT) AS n0, CAST(sum(n1) AS BIGINT) AS n1,
  round(2 * (sum(n0 * before) + sum(n0 * n1) * 0.5::DOUBLE) / (sum(n0) * sum(n1)) - 1, 8) AS delta FROM b"""


@query("labelled_length_delta", _DOCUMENT_SQL, with_applications=False)
def labelled_length_delta(spark, sf_dir):
    labelled = stage(read_table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(
        read_table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id"))
    out = stats.rank_statistics(labelled, ["n_chars"], "quality")
    return rounded(out, "delta", digits=8).select("feature", "n0", "n1", "delta")


def _chi2_sql(x, y):
    return f""", cell AS (SELECT x, y, count(a.{x}) AS n
  FROM (SELECT DISTINCT {x} AS x FROM application WHERE {x} IS NOT NULL)
  CROSS JOIN (SELECT DISTINCT {y} AS y FROM application WHERE {y} IS NOT NULL)
  LEFT JOIN application a ON a.{x} = x AND a.{y} = y GROUP BY 1, 2),
m AS (SELECT *, CAST(sum(n) OVER (PARTITION BY x) AS DOUBLE) AS rn,
  CAST(sum(n) OVER (PARTITION BY y) AS DOUBLE) AS cn, CAST(sum(n) OVER () AS DOUBLE) AS total FROM cell),
d AS (SELECT (SELECT count(DISTINCT x) FROM cell) AS r, (SELECT count(DISTINCT y) FROM cell) AS k),
e AS (SELECT *, rn * cn / total AS e, abs(n - rn * cn / total) AS g FROM m, d),
c AS (SELECT sum(CASE WHEN r = 2 AND k = 2 THEN (g - least(0.5::DOUBLE, g)) ** 2 ELSE g ** 2 END / e) AS chi2,
  CAST(sum(n) AS DOUBLE) AS n, max(r) AS r, max(k) AS k FROM e),
f AS (SELECT *, greatest(0.0::DOUBLE, chi2 / n - (k - 1) * (r - 1) / (n - 1)) AS phi,
  least(r - (r - 1) ** 2 / (n - 1), k - (k - 1) ** 2 / (n - 1)) - 1 AS dim FROM c)
SELECT '{x}' AS feature, CAST(n AS BIGINT) AS n, CAST(r AS BIGINT) AS n_rows,
  CAST(k AS BIGINT) AS n_columns, round(chi2, 6) AS chi2,
  round(sqrt(chi2 / (n * greatest(1, least(r, k) - 1))), 8) AS cramers_v,
  round(sqrt(phi / dim), 8) AS cramers_v_corrected FROM f"""


def _chi2(spark, sf_dir, x, y):
    out = stats.chi_square(applications(spark, sf_dir).select(x, y), x, y)
    return rounded(rounded(out, "chi2"), "cramers_v", "cramers_v_corrected", digits=8).select(
        F.lit(x).alias("feature"), "*")


@query("chi2_statistic", _chi2_sql("organization_type", TARGET))
def chi2_statistic(spark, sf_dir):
    return _chi2(spark, sf_dir, "organization_type", TARGET)


@query("chi2_two_by_two", _chi2_sql("code_gender", TARGET))
def chi2_two_by_two(spark, sf_dir):
    return _chi2(spark, sf_dir, "code_gender", TARGET)


@query("cramers_v", _chi2_sql("name_education_type", "name_type_suite"))
def cramers_v(spark, sf_dir):
    return _chi2(spark, sf_dir, "name_education_type", "name_type_suite")


_POOL_SQL = ", v AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS category, {TARGET} AS y FROM application"
    for c in CATEGORICAL) + """), h AS (SELECT feature, category, count(*) FILTER (y = 0) AS n0,
  count(*) FILTER (y = 1) AS n1 FROM v GROUP BY 1, 2),
f AS (SELECT *, count(category) OVER (PARTITION BY feature) AS k,
  sum(n0 + n1) OVER (PARTITION BY feature) AS total, row_number() OVER (
    PARTITION BY feature ORDER BY category IS NULL, n0 + n1 DESC, category) AS rn FROM h),
p AS (SELECT feature, CASE WHEN k > 10 THEN CASE WHEN rn <= 9 AND category IS NOT NULL THEN category
    ELSE 'Other' END WHEN category IS NOT NULL AND n0 + n1 < greatest(total * 0.01, 5) THEN 'Other'
    ELSE category END AS category, n0, n1 FROM f),
c AS (SELECT feature, category, CAST(sum(n0) AS BIGINT) AS n0, CAST(sum(n1) AS BIGINT) AS n1
  FROM p WHERE category IS NOT NULL GROUP BY 1, 2)"""


@query("rare_pooled_counts", _POOL_SQL + " SELECT * FROM c")
def rare_pooled_counts(spark, sf_dir):
    apps = applications(spark, sf_dir).select(TARGET, *CATEGORICAL)
    return stats.pool_rare(stats.category_counts(apps, CATEGORICAL, TARGET))


@query("categorical_tests", _POOL_SQL + """,
w AS (SELECT *, count(*) OVER (PARTITION BY feature) AS r, CAST(sum(n0) OVER (PARTITION BY feature)
  AS DOUBLE) AS t0, CAST(sum(n1) OVER (PARTITION BY feature) AS DOUBLE) AS t1 FROM c),
e AS (SELECT *, (n0 + n1) * t0 / (t0 + t1) AS e0, (n0 + n1) * t1 / (t0 + t1) AS e1 FROM w),
g AS (SELECT *, abs(n0 - e0) AS g0, abs(n1 - e1) AS g1 FROM e),
s AS (SELECT feature, max(r) AS r, max(t0 + t1) AS n, bool_or(n0 = 0 OR n1 = 0) AS z,
  min(least(e0, e1)) AS low, sum(CASE WHEN r = 2 THEN (g0 - least(0.5::DOUBLE, g0)) ** 2 / e0
    + (g1 - least(0.5::DOUBLE, g1)) ** 2 / e1 ELSE g0 ** 2 / e0 + g1 ** 2 / e1 END) AS chi2
  FROM g GROUP BY 1)
SELECT feature, r AS n_categories, CAST(n AS BIGINT) AS n, round(chi2, 6) AS chi2,
  round(low, 6) AS min_expected,
  CASE WHEN z THEN 'chi2_simulated' WHEN r = 2 AND low < 5 THEN 'fisher'
    WHEN low < 1 THEN 'chi2_simulated' ELSE 'chi2' END AS test,
  CASE WHEN NOT z THEN round(sqrt(chi2 / n), 8) END AS cramers_v FROM s""")
def categorical_tests(spark, sf_dir):
    apps = applications(spark, sf_dir).select(TARGET, *CATEGORICAL)
    out = stats.table_statistics(stats.pool_rare(stats.category_counts(apps, CATEGORICAL, TARGET)))
    return rounded(rounded(out, "chi2", "min_expected"), "cramers_v", digits=8).select(
        "feature", "n_categories", "n", "chi2", "min_expected", "test", "cramers_v")


@query("bh_adjusted", """, d AS (SELECT organization_type AS feature,
  (1 + count(*) FILTER (target_signal = 1)) / (2.0::DOUBLE + count(*) + sum(amt_income_total) / 1000) AS p
  FROM application GROUP BY 1),
r AS (SELECT feature, p, row_number() OVER (ORDER BY p, feature) AS i, count(*) OVER () AS m FROM d)
SELECT feature, round(p, 10) AS p_value, round(least(1.0::DOUBLE, min(p * m / i) OVER (
  ORDER BY i DESC ROWS UNBOUNDED PRECEDING)), 10) AS corrected_p_value FROM r""")
def bh_adjusted(spark, sf_dir):
    shares = applications(spark, sf_dir).groupBy(F.col("organization_type").alias("feature")).agg(
        ((1 + F.count_if(F.col("target_signal") == 1))
         / (2.0 + F.count(F.lit(1)) + F.sum("amt_income_total") / 1000)).alias("p_value"))
    return rounded(rank.adjust_p_values(shares), "p_value", "corrected_p_value", digits=10)


@query("bootstrap_delta_ci")
def bootstrap_delta_ci(spark, sf_dir):
    hist = rank.class_histogram(numeric_table(spark, sf_dir), NUMERIC, TARGET)
    return resampling.bootstrap_delta(hist, 500, 42)


def _tables(spark, sf_dir):
    apps = applications(spark, sf_dir).select(TARGET, *CATEGORICAL)
    out = {}
    for r in stats.pool_rare(stats.category_counts(apps, CATEGORICAL, TARGET)).orderBy(
            "feature", "category").collect():
        out.setdefault(r["feature"], []).append([r["n0"], r["n1"]])
    return out


@query("simulated_p")
def simulated_p(spark, sf_dir):
    return resampling.resample_tables(spark, _tables(spark, sf_dir), 10_000, 42).select(
        "feature", "p_value")


@query("bootstrap_v_ci")
def bootstrap_v_ci(spark, sf_dir):
    return resampling.resample_tables(spark, _tables(spark, sf_dir), 500, 42).drop("p_value")


@query("statistical_analysis")
def statistical_analysis(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select(TARGET, *NUMERIC, *CATEGORICAL))
    return stats.run_statistical_analysis(apps, [*NUMERIC, *CATEGORICAL], TARGET)


# With two values in the smaller group the pairs of places (0-based, untied) with a rank sum of
# at most t + 1 can be counted one by one; twice their share is the exact p-value.
@query("mann_whitney_p_small_group", """WITH v AS (SELECT CAST(o_orderkey AS DOUBLE) AS value,
  CASE WHEN row_number() OVER (ORDER BY o_orderkey) IN (2, 5) THEN 1 ELSE 0 END AS y FROM orders),
r AS (SELECT y, row_number() OVER (ORDER BY value) - 1 AS place, count(*) OVER () AS n FROM v),
t AS (SELECT max(n) AS n, CAST(sum(place) - 1 AS BIGINT) AS u FROM r WHERE y = 1),
k AS (SELECT n, u, least(u, 2 * (n - 2) - u) AS tail FROM t),
c AS (SELECT sum(greatest(0, least(n - 1, tail + 1 - a) - a)) AS ways
  FROM k, (SELECT place AS a FROM r) WHERE a <= tail + 1)
SELECT n - 2 AS n0, CAST(2 AS BIGINT) AS n1,
  round(least(1.0::DOUBLE, 2.0::DOUBLE * ways / (n * (n - 1) / 2)), 12) AS p FROM k, c""", with_applications=False)
def mann_whitney_p_small_group(spark, sf_dir):
    """Two values against all others of the order table, however many there are."""
    from loanloom.functions.tails import mann_whitney_p

    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    picked = [r["key"] for r in orders.orderBy("key").limit(5).collect()]
    table = stage(orders.select(F.col("key").cast("double").alias("value"), F.col("key").isin(
        picked[1], picked[4]).cast("int").alias("y")))
    r = stats.rank_statistics(table, ["value"], "y").first()
    p = mann_whitney_p(r["u"], r["n0"], r["n1"], r["tie_term"])
    return spark.createDataFrame([(int(r["n0"]), int(r["n1"]), round(p, 12))], "n0 bigint, n1 bigint, p double")
