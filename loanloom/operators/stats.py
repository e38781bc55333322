"""Feature-against-target statistics computed over all rows.

Numeric features share one job (unpivot, merge equal values, prefix sums), categorical
features share another (count, pool rare categories, statistics per table).  What is left
per feature is one row, on which tail probabilities are computed in Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.tails import chi2_upper, fisher_two_sided, mann_whitney_p
from loanloom.operators.rank import adjust_p_values, class_histogram, prefix_sum
from loanloom.operators.resampling import bootstrap_delta, resample_tables
from loanloom.operators.summary import cell_counts
from loanloom.session import stage

OTHER = "Other"
MANY_CATEGORIES = 10
TOP_CATEGORIES = 9
RARE_SHARE = 0.01
RARE_ROWS = 5
LOW_EXPECTED = 5

RESULT_SCHEMA = (
    "feature string, p_value double, effect_size double, ci_low double, ci_high double, "
    "test string"
)


def binary_target(df: DataFrame, target: str) -> Column:
    """The target as 0/1.  Two other numeric values become 0 and 1 in ascending order."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    text = F.col(target).cast("string")
    seen = [r[0] for r in df.select(text).distinct().limit(3).collect()]
    if len(seen) != 2 or None in seen:
        raise ValueError(f"target {target!r} is not binary: {seen}")
    try:
        low, high = sorted(float(v) for v in seen)
    except ValueError as error:
        raise ValueError(f"target {target!r} is not numeric: {seen}") from error
    number = F.col(target).cast("double")
    if {low, high} <= {0.0, 1.0}:
        return number.cast("int")
    return F.when(number == low, 0).when(number == high, 1)


def rank_statistics(
    df: DataFrame, features: Sequence[str], target: str, ranges: int | None = None
) -> DataFrame:
    """``feature, n0, n1, u, tie_term, delta, z`` for a 0/1 target.

    ``u`` counts pairs in which class 0 is larger (ties half); ``delta`` is Cliff's delta
    of class 0 against class 1; ``z`` has the tie and continuity correction.
    """
    return _rank_statistics(class_histogram(df, features, target, ranges))


def _rank_statistics(hist: DataFrame) -> DataFrame:
    t = (F.col("n0") + F.col("n1")).cast("double")
    won = F.col("n0").cast("double") * (F.col("before_n1") + F.col("n1") / 2)
    sums = prefix_sum(hist, ["feature"], "value", ["n0", "n1"]).groupBy("feature").agg(
        F.first("total_n0").alias("n0"), F.first("total_n1").alias("n1"),
        F.sum(won).alias("u"), F.sum(t * t * t - t).alias("tie_term"),
    )
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    n, pairs = n0 + n1, n0 * n1
    variance = pairs / 12 * ((n + 1) - F.try_divide("tie_term", n * (n - 1)))
    gap = F.greatest(F.col("u"), pairs - F.col("u")) - pairs / 2 - 0.5
    return sums.withColumns({
        "delta": F.try_divide(2 * F.col("u"), pairs) - 1,
        "z": F.when(variance > 0, gap / F.sqrt(variance)),
    })


def calculate_cliff_delta(df: DataFrame, feature: str, target: str) -> float | None:
    """Cliff's delta of class 0 against class 1; None when a class has no values."""
    row = rank_statistics(df, [feature], target).first()
    return row["delta"] if row else None


def category_counts(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``feature, category, n0, n1``; a missing category is a null row."""
    y = F.col(target)
    cells = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("category"))
        for f in features
    ])
    return (
        df.where(y.isin(0, 1)).select(F.explode(cells).alias("c"), y.alias("y"))
        .groupBy("c.feature", "c.category")
        .agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"))
    )


def pool_rare(counts: DataFrame) -> DataFrame:
    """Merge categories into ``Other``.

    More than ten categories: the nine most frequent stay (ties by name) and everything
    else, missing values included, is pooled.  Otherwise categories with fewer rows than
    the larger of 1 % and 5 are pooled and missing values are left out.
    """
    # read three times below
    counts = stage(counts, "category_counts")
    n = F.col("n0") + F.col("n1")
    facts = counts.groupBy("feature").agg(
        F.count("category").alias("n_categories"), F.sum(n).alias("n_rows")
    )
    known = counts.where(F.col("category").isNotNull())
    order = Window.partitionBy("feature").orderBy(F.desc("n"), "category")
    # row_number <= k is cut per partition before the shuffle
    top = known.select("feature", "category", n.alias("n")).withColumn(
        "position", F.row_number().over(order)
    ).where(F.col("position") <= TOP_CATEGORIES).select("feature", "category", F.lit(True).alias("top"))
    joined = counts.join(facts, "feature").join(top, ["feature", "category"], "left")
    rare = n < F.greatest(F.col("n_rows") * RARE_SHARE, F.lit(float(RARE_ROWS)))
    pooled = F.when(
        F.col("n_categories") > MANY_CATEGORIES,
        F.when(F.col("top"), F.col("category")).otherwise(OTHER),
    ).when(F.col("category").isNotNull() & rare, OTHER).otherwise(F.col("category"))
    return (
        joined.withColumn("pooled", pooled).where(F.col("pooled").isNotNull())
        .groupBy("feature", F.col("pooled").alias("category"))
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    )


def table_statistics(cells: DataFrame, auto_correct: bool = False) -> DataFrame:
    """Per feature the table size, chi-square, smallest expected count, effect and test.

    ``cells`` has one row per feature and (pooled) category with counts of both classes;
    the statistic is continuity-corrected for 2 x 2 tables.
    """
    whole = Window.partitionBy("feature")
    sized = cells.withColumns({
        "t0": F.sum("n0").over(whole), "t1": F.sum("n1").over(whole),
        "r": F.count(F.lit(1)).over(whole),
    }).withColumn("n", F.col("t0") + F.col("t1")).withColumn(
        "k", (F.col("t0") > 0).cast("int") + (F.col("t1") > 0).cast("int")
    )
    row = F.col("n0") + F.col("n1")
    two_by_two = (F.col("r") == 2) & (F.col("k") == 2)

    def expected(total: str) -> Column:
        return row.cast("double") * F.col(total) / F.col("n")

    def part(count: str, total: str, corrected: bool) -> Column:
        gap = F.abs(F.col(count) - expected(total))
        if corrected:
            gap = F.when(two_by_two, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return F.when(F.col(total) > 0, gap * gap / expected(total)).otherwise(0.0)

    def zero(count: str, total: str) -> Column:
        return (F.col(total) > 0) & (F.col(count) == 0)

    smallest = F.least(F.when(F.col("t0") > 0, expected("t0")), F.when(F.col("t1") > 0, expected("t1")))
    facts = sized.groupBy("feature").agg(
        F.first("r").cast("bigint").alias("n_categories"),
        F.first("k").cast("bigint").alias("n_classes"), F.first("n").alias("n"),
        F.bool_or(zero("n0", "t0") | zero("n1", "t1")).alias("zero_cell"),
        F.min(smallest).alias("min_expected"),
        F.sum(part("n0", "t0", True) + part("n1", "t1", True)).alias("chi2"),
        F.sum(part("n0", "t0", False) + part("n1", "t1", False)).alias("chi2_plain"),
    )
    r, k, n = F.col("n_categories"), F.col("n_classes"), F.col("n").cast("double")
    cells_n = r * k
    low = F.col("min_expected") < LOW_EXPECTED
    test = (
        F.when(F.col("zero_cell"), "chi2_simulated")
        .when((r == 2) & (k == 2) & low, "fisher")
        .when((F.col("min_expected") < 1)
              | (F.lit(auto_correct) & low & (cells_n > 4)), "chi2_simulated")
        .otherwise("chi2")
    )
    smaller = F.greatest(F.lit(1), F.least(r, k) - 1)
    return facts.withColumns({
        "test": test,
        "low_expected": low & (cells_n > 4),
        "cramers_v": F.when(~F.col("zero_cell"), F.sqrt(F.col("chi2") / (n * smaller))),
    })


def chi_square(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row for any two columns: chi-square (corrected for 2 x 2), size, V and the
    bias-corrected V."""
    cells = stage(cell_counts(df, x, y).select(
        F.col(x).alias("x"), F.col(y).alias("y"), F.col("n").cast("double").alias("n")), "cells")
    rows = cells.groupBy("x").agg(F.sum("n").alias("row_n"))
    cols = cells.groupBy("y").agg(F.sum("n").alias("col_n"))
    # the margins as single rows: number of levels, sum of reciprocals
    margin = lambda t, c, a: t.agg(
        F.count(F.lit(1)).alias(a), F.sum(1 / F.col(c)).alias(f"{a}_inverse"), F.sum(c).alias(f"{a}_n"))
    base = cells.join(rows, "x").join(cols, "y")
    facts = base.agg(
        # cells that don't occur add nothing to the sum of n^2 / (row * column)
        F.sum(F.col("n") * F.col("n") / (F.col("row_n") * F.col("col_n"))).alias("share"),
        F.first(F.struct("n", "row_n", "col_n")).alias("one"))
    # three aggregates of one row each become one row
    facts = facts.unionByName(margin(rows, "row_n", "r"), True).unionByName(margin(cols, "col_n", "k"), True)
    facts = facts.agg(*[F.max(c).alias(c) for c in facts.columns])
    # in a 2 x 2 table every cell is equally far from its expectation
    total = F.col("r_n")
    gap = F.abs(F.col("one.n") - F.col("one.row_n") * F.col("one.col_n") / total)
    gap = gap - F.least(F.lit(0.5), gap)
    corrected_chi2 = gap * gap * total * F.col("r_inverse") * F.col("k_inverse")
    facts = facts.select(
        total.cast("bigint").alias("n"), "r", "k",
        F.when((F.col("r") == 2) & (F.col("k") == 2), corrected_chi2).otherwise(
            total * (F.col("share") - 1)).alias("chi2"))
    n, r, k = F.col("n").cast("double"), F.col("r").cast("double"), F.col("k").cast("double")
    phi2 = F.greatest(F.lit(0.0), F.col("chi2") / n - F.try_divide((k - 1) * (r - 1), n - 1))
    rc = r - F.try_divide((r - 1) * (r - 1), n - 1)
    kc = k - F.try_divide((k - 1) * (k - 1), n - 1)
    corrected = F.when((rc == 0) | (kc == 0), 0.0).otherwise(
        F.sqrt(F.try_divide(phi2, F.least(rc - 1, kc - 1)))
    )
    return facts.select(
        "n", F.col("r").alias("n_rows"), F.col("k").alias("n_columns"), "chi2",
        F.sqrt(F.col("chi2") / (n * F.greatest(F.lit(1.0), F.least(r, k) - 1))).alias("cramers_v"),
        corrected.alias("cramers_v_corrected"),
    )


def calculate_cramers_v(df: DataFrame, x: str, y: str) -> float | None:
    """Bias-corrected Cramer's V of two columns."""
    return chi_square(df, x, y).first()["cramers_v_corrected"]


def analyze_numeric(
    df: DataFrame, features: Sequence[str], target: str, replicates: int = 500, seed: int = 42,
    ranges: int | None = None,
) -> list[tuple]:
    """Result rows of the numeric features that have values in both classes."""
    hist = class_histogram(df, features, target, ranges).persist()
    try:
        facts = {r["feature"]: r for r in _rank_statistics(hist).collect()}
        bounds = {r["feature"]: r for r in bootstrap_delta(hist, replicates, seed).collect()}
    finally:
        hist.unpersist()
    out = []
    for f in features:
        r = facts.get(f)
        if r is None or not r["n0"] or not r["n1"]:
            continue
        p = mann_whitney_p(r["u"], r["n0"], r["n1"], r["tie_term"])
        ci = bounds.get(f)
        out.append((f, p, r["delta"], ci and ci["ci_low"], ci and ci["ci_high"], "mannwhitneyu"))
    return out


def analyze_categorical(
    df: DataFrame, features: Sequence[str], target: str, auto_correct: bool = False,
    replicates: int = 500, simulations: int = 10_000, seed: int = 42,
    null: str = "observed",
) -> list[tuple]:
    """Result rows of the categorical features.

    Pooling leaves at most eleven categories per feature, so the tables are small.
    """
    cells = pool_rare(category_counts(df, features, target))
    tables: dict[str, list[list[int]]] = {}
    for r in cells.orderBy("feature", "category").collect():
        tables.setdefault(r["feature"], []).append([r["n0"], r["n1"]])
    rows = [(f, str(i), a, b) for f, t in tables.items() for i, (a, b) in enumerate(t)]
    if not rows:
        return []
    spark = df.sparkSession
    small = spark.createDataFrame(rows, "feature string, category string, n0 bigint, n1 bigint")
    facts = {r["feature"]: r for r in table_statistics(small, auto_correct).collect()}
    simulated = [f for f, r in facts.items() if r["test"] == "chi2_simulated"]
    p_simulated = {}
    if simulated:
        got = resample_tables(spark, {f: tables[f] for f in simulated}, simulations, seed, null)
        p_simulated = {r["feature"]: r["p_value"] for r in got.collect()}
    bounds = {
        r["feature"]: r for r in resample_tables(spark, tables, replicates, seed, "observed").collect()
    }
    out = []
    for f in features:
        if f not in facts:
            continue
        r = facts[f]
        if r["test"] == "chi2_simulated":
            p = p_simulated[f]
        elif r["test"] == "fisher":
            (a, b), (c, d) = tables[f]
            p = fisher_two_sided(a, b, c, d)
        else:
            p = chi2_upper(r["chi2"], (r["n_categories"] - 1) * (r["n_classes"] - 1))
        ci = bounds[f]
        out.append((f, p, r["cramers_v"], ci["ci_low"], ci["ci_high"], r["test"]))
    return out


def split_features(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric (booleans included) and categorical features; unknown names raise."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    unknown = [f for f in features if f not in kinds]
    if unknown:
        raise KeyError(f"unknown features: {unknown}")
    numeric = [f for f in features if isinstance(kinds[f], T.NumericType | T.BooleanType)]
    return numeric, [f for f in features if f not in numeric]


def run_statistical_analysis(
    df: DataFrame, features: Sequence[str], target: str, auto_correct: bool = False,
    replicates: int = 500, simulations: int = 10_000, seed: int = 42,
    null: str = "observed", ranges: int | None = None,
) -> DataFrame:
    """Test, effect, interval and adjusted p-value per feature, most significant first.

    ``null="observed"`` simulates from the observed cell shares, which does not test
    independence; use ``null="independence"`` for inference.
    """
    numeric, categorical = split_features(df, features)
    kinds = dict(df.dtypes)
    base = df.select(
        binary_target(df, target).alias("__y"),
        *[F.col(f).cast("int").alias(f) if kinds[f] == "boolean" else F.col(f) for f in features],
    )
    rows = []
    if numeric:
        rows += analyze_numeric(base, numeric, "__y", replicates, seed, ranges)
    if categorical:
        rows += analyze_categorical(
            base, categorical, "__y", auto_correct, replicates, simulations, seed, null
        )
    return adjust_p_values(df.sparkSession.createDataFrame(rows, RESULT_SCHEMA))


def analyze_feature(df: DataFrame, feature: str, target: str, **options) -> DataFrame:
    return run_statistical_analysis(df, [feature], target, **options)
