"""Distributed order statistics: prefix sums, ranks, ROC and precision-recall points.

A running total over all rows in value order would put the whole table into one window
partition.  Here equal values are first merged into one counted row (map-side combine, so
a hot value is one row), the counted rows are cut into value ranges, each range is summed
on its own, and the few range totals give every range its starting offset.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.scalars import present
from loanloom.operators.quantiles import bucketed
from loanloom.session import stage

FEWEST_RANGES = 16
ROWS_PER_RANGE = 250_000
#: Ranges that the driver knows the cuts of; more are cut inside these, in the executors.
COARSE_RANGES = 1_024


def range_edges(df: DataFrame, columns: Sequence[str], ranges: int) -> dict:
    """Approximate quantiles of each column, one pass for all; only used to cut work."""
    probs = [i / ranges for i in range(1, ranges)]
    row = df.agg(
        *[F.percentile_approx(present(c), probs, 10 * ranges).alias(f"e{i}")
          for i, c in enumerate(columns)]
    ).first()
    found = {c: sorted({e for e in row[f"e{i}"] or [] if math.isfinite(e)}) for i, c in enumerate(columns)}
    return {c: edges or [0.0] for c, edges in found.items()}


def ranges_for(df: DataFrame) -> int:
    """Enough ranges that one of them stays small however large the table is."""
    return max(FEWEST_RANGES, df.count() // ROWS_PER_RANGE)


def value_histogram(
    df: DataFrame, features: Sequence[str], counts: dict[str, Column], ranges: int | None = None
) -> DataFrame:
    """Long counted values: ``feature, part, value`` plus the summed ``counts``.

    ``part`` is the value range (ascending).  Missing values are left out.  Tables that need
    more than :data:`COARSE_RANGES` ranges are cut in two steps, see :func:`refined`.
    """
    features = list(features)
    wanted = ranges or ranges_for(df)
    coarse = min(wanted, COARSE_RANGES)
    # counts are projected under fixed names, the features under positions
    base = df.select(
        # -0.0 and 0.0 are one value, on the same side of every cut
        *[(present(f) + F.lit(0.0)).alias(f"x{i}") for i, f in enumerate(features)],
        *[c.cast("bigint").alias(n) for n, c in counts.items()],
    )
    names = [f"x{i}" for i in range(len(features))]
    wide = bucketed(base, range_edges(base, names, coarse))
    cells = [
        F.when(F.col(n).isNotNull(), F.struct(
            F.lit(f).alias("feature"), F.col(n + "__b").cast("int").alias("part"),
            F.col(n).alias("value"),
        ))
        for n, f in zip(names, features, strict=True)
    ]
    hist = (
        wide.select(F.explode(F.array_compact(F.array(*cells))).alias("c"), *counts)
        .groupBy("c.feature", "c.part", "c.value")
        .agg(*[F.sum(n).alias(n) for n in counts])
    )
    return hist if coarse == wanted else refined(stage(hist, "ranges"), math.ceil(wanted / coarse))


def refined(hist: DataFrame, fine: int) -> DataFrame:
    """Each range of ``hist`` cut into up to ``fine`` ranges of about as many distinct values.

    The cuts are approximate quantiles inside a range and meet its values in a join, so they
    never come to the driver; a crowded range is split by adaptive execution.  A value finds its
    place among heads of runs of cuts, then in its run.
    """
    run = math.isqrt(fine - 1) + 1
    probs = [i / fine for i in range(1, fine)]
    cuts = hist.groupBy("feature", "part").agg(
        F.percentile_approx("value", probs, 10 * fine).alias("cuts"))
    heads = F.transform(F.sequence(F.lit(1), F.floor(F.size("cuts") / run).cast("int")), lambda i: F.get("cuts", i * run - 1))
    cuts = cuts.withColumn("heads", F.when(F.size("cuts") >= run, heads).otherwise(F.slice("cuts", 1, 0)))

    def reached(places: Column) -> Column:
        return F.size(F.filter(places, lambda cut: cut <= F.col("value")))

    first = reached(F.col("heads")) * run
    return hist.join(cuts, ["feature", "part"]).withColumn("first", first).select(
        "feature", (F.col("part") * fine + F.col("first") + reached(
            F.slice("cuts", F.col("first") + 1, F.lit(run)))).cast("int").alias("part"),
        *[c for c in hist.columns if c not in ("feature", "part")])


def prefix_sum(
    hist: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str],
    part: str = "part",
    descending: bool = False,
) -> DataFrame:
    """Add ``before_<s>`` (sum over rows ordered earlier) and ``total_<s>`` per key.

    ``hist`` has one row per key and order value, and ``part`` grows with the order value.
    """
    # the join below implies these filters on one side only; stated here they apply to both
    # sides, which keeps the aggregated exchange under ``hist`` shared instead of run twice
    for c in [*keys, part]:
        hist = hist.where(F.col(c).isNotNull())
    direction = F.desc if descending else F.asc
    inside = (
        Window.partitionBy(*keys, part).orderBy(direction(order))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = (
        Window.partitionBy(*keys).orderBy(direction(part))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*keys)
    zero = F.lit(0).cast("bigint")
    offsets = (
        hist.groupBy(*keys, part).agg(*[F.sum(s).alias(f"part_{s}") for s in sums])
        .select(
            *keys, part,
            *[F.coalesce(F.sum(f"part_{s}").over(earlier), zero).alias(f"off_{s}") for s in sums],
            *[F.sum(f"part_{s}").over(whole).alias(f"total_{s}") for s in sums],
        )
    )
    local = hist.select(
        "*", *[F.coalesce(F.sum(s).over(inside), zero).alias(f"in_{s}") for s in sums]
    )
    joined = local.join(offsets, [*keys, part])
    return joined.select(
        *[c for c in hist.columns],
        *[(F.col(f"in_{s}") + F.col(f"off_{s}")).alias(f"before_{s}") for s in sums],
        *[F.col(f"total_{s}") for s in sums],
    )


def average_ranks(df: DataFrame, features: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``feature, value, n, avg_rank``: mean rank of each distinct value."""
    hist = value_histogram(df, features, {"n": F.lit(1)}, ranges)
    return prefix_sum(hist, ["feature"], "value", ["n"]).select(
        "feature", "value", "n", (F.col("before_n") + (F.col("n") + 1) / 2).alias("avg_rank")
    )


def class_histogram(
    df: DataFrame, features: Sequence[str], target: str, ranges: int | None = None
) -> DataFrame:
    """Counted values with ``n0`` and ``n1`` rows of class 0 and 1; other rows are left out."""
    y = F.col(target)
    return value_histogram(
        df.where(y.isin(0, 1)), features,
        {"n0": F.when(y == 0, 1).otherwise(0), "n1": F.when(y == 1, 1).otherwise(0)}, ranges,
    )


def score_prefix(
    df: DataFrame, scores: Sequence[str], label: str, ranges: int | None = None
) -> DataFrame:
    """Per model and distinct score (highest first) the positives and negatives above it."""
    hist = class_histogram(df, scores, label, ranges)
    return prefix_sum(hist, ["feature"], "value", ["n0", "n1"], descending=True).select(
        F.col("feature").alias("model"), F.col("value").alias("score"), "n0", "n1",
        (F.col("before_n0") + F.col("n0")).alias("fp"),
        (F.col("before_n1") + F.col("n1")).alias("tp"),
        F.col("total_n0").alias("negatives"), F.col("total_n1").alias("positives"),
    )


def roc_points(
    df: DataFrame, scores: Sequence[str], label: str, ranges: int | None = None
) -> DataFrame:
    """``model, threshold, fpr, tpr`` at each distinct score and the (0, 0) start, whose
    threshold is null."""
    points = score_prefix(df, scores, label, ranges).select(
        "model", F.col("score").alias("threshold"),
        F.try_divide("fp", "negatives").alias("fpr"), F.try_divide("tp", "positives").alias("tpr"),
    )
    start = df.sparkSession.createDataFrame(
        [(s, None, 0.0, 0.0) for s in scores], points.schema
    )
    return points.unionByName(start)


def pr_points(
    df: DataFrame, scores: Sequence[str], label: str, ranges: int | None = None
) -> DataFrame:
    """``model, threshold, precision, recall`` and the closing point (1, 0)."""
    points = score_prefix(df, scores, label, ranges).select(
        "model", F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", "positives").alias("recall"),
    )
    close = df.sparkSession.createDataFrame(
        [(s, None, 1.0, 0.0) for s in scores], points.schema
    )
    return points.unionByName(close)


def auc(
    df: DataFrame, scores: Sequence[str], label: str, ranges: int | None = None
) -> DataFrame:
    """``model, auc``: exact area under the ROC curve from ranks, ties counted half."""
    hist = class_histogram(df, scores, label, ranges)
    # doubles: the product of two counts leaves the bigint range on large tables
    wins = F.col("n1") * (F.col("before_n0").cast("double") + F.col("n0") / 2)
    return (
        prefix_sum(hist, ["feature"], "value", ["n0", "n1"])
        .groupBy(F.col("feature").alias("model"))
        .agg((F.sum(wins) / F.nullif(
            F.first("total_n0").cast("double") * F.first("total_n1"), F.lit(0.0))).alias("auc"))
    )


def average_precision(
    df: DataFrame, scores: Sequence[str], label: str, ranges: int | None = None
) -> DataFrame:
    """``ext_``: area under the precision-recall steps."""
    step = F.col("n1") / F.col("positives") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return (
        score_prefix(df, scores, label, ranges).where("positives > 0")
        .groupBy("model").agg(F.sum(step).alias("pr_auc"))
    )


def ext_threshold_for_recall(
    df: DataFrame, scores: Sequence[str], label: str, recall: float
) -> DataFrame:
    """``ext_``: the highest score threshold whose recall reaches the target."""
    return (
        pr_points(df, scores, label).where(F.col("recall") >= recall)
        .groupBy("model").agg(F.max("threshold").alias("threshold"))
    )


def adjust_p_values(df: DataFrame, p: str = "p_value", key: str = "feature") -> DataFrame:
    """Add ``corrected_p_value`` (Benjamini-Hochberg); rows without a p-value are left out.

    The input has one row per feature, so one window partition is enough.
    """
    tests = df.where(F.col(p).isNotNull())
    everything = F.lit(1)
    ranked = tests.withColumns({
        "__m": F.count(F.lit(1)).over(Window.partitionBy(everything)),
        "__i": F.row_number().over(Window.partitionBy(everything).orderBy(p, key)),
    })
    downward = (
        Window.partitionBy(everything).orderBy(F.desc("__i"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    adjusted = F.min(F.col(p) * F.col("__m") / F.col("__i")).over(downward)
    return (
        ranked.withColumn("corrected_p_value", F.least(adjusted, F.lit(1.0)))
        .drop("__m", "__i").orderBy("corrected_p_value", key)
    )
