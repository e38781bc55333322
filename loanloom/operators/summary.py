"""Tables behind the usual plots: crosstabs, histograms, boxes, correlations, attributions."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.scalars import present
from loanloom.functions.tails import t_quantile
from loanloom.operators.gram import pair_correlations
from loanloom.operators.quantiles import exact_quantiles


def levels(df: DataFrame, column: str) -> list:
    """Sorted distinct values of a class-like column, as many as there are."""
    return sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().collect())


def cell_counts(df: DataFrame, x: str, y: str) -> DataFrame:
    """``x, y, n`` of the cells that occur; rows missing a side are left out."""
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(
        F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, x: str, y: str, fill: bool = True) -> DataFrame:
    """Long contingency table ``x, y, n``; rows missing a side are left out.

    With ``fill`` cells that don't occur have a row with 0: the levels of ``y`` become columns
    once and are turned back into rows, which needs no pairing of the two key sets but one
    column a level.  Without it the table is one grouped count for any number of levels.
    """
    if not fill:
        return cell_counts(df, x, y)
    ys = levels(df, y)
    names = [f"__y{i}" for i in range(len(ys))]
    counted = (
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x)
        .agg(*[F.count_if(F.col(y) == value).alias(n)
               for n, value in zip(names, ys, strict=True)])
    )
    kind = df.schema[y].dataType
    cells = F.array(*[F.struct(F.lit(v).cast(kind).alias("y"), F.col(n).alias("n"))
                      for n, v in zip(names, ys, strict=True)])
    return counted.select(x, F.explode(cells).alias("c")).select(
        x, F.col("c.y").alias(y), F.col("c.n").alias("n")
    )


def category_by_target(df: DataFrame, category: str, target: str) -> DataFrame:
    """Crosstab with the percentage within each category."""
    within = Window.partitionBy(category)
    return crosstab(df, category, target).withColumn(
        "pct", F.try_divide(F.col("n") * 100.0, F.sum("n").over(within))
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long ``x, y, r`` over all pairs, pairwise complete, undefined as null, from one scan."""
    names = list(columns)
    return pair_correlations(df, names, names).select("x", "y", "r")


def value_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Min and max per column; a constant column is widened by 0.5 on both sides."""
    row = df.agg(
        *[F.min(present(c)).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(present(c)).alias(f"hi{i}") for i, c in enumerate(columns)],
    ).first()
    out = {}
    for i, c in enumerate(columns):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is None:
            continue
        out[c] = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
    return out


def bin_index(column: str | Column, low: float, high: float, bins: int) -> Column:
    """Zero-based equal-width bin; the top edge belongs to the last bin."""
    x = present(column)
    width = (high - low) / bins
    return F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")


def _every_bin(spark, spans: dict[str, tuple[float, float]], bins: int) -> DataFrame:
    """All bins of all features with their edges, generated on the cluster."""
    spans_df = spark.createDataFrame(
        [(f, lo, (hi - lo) / bins) for f, (lo, hi) in spans.items()],
        "feature string, low double, width double",
    )
    return spans_df.select(
        "feature", "low", "width",
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
    ).select(
        "feature", "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("bin_low"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_high"),
    )


def _binned_counts(df, spans, bins, counts: dict[str, Column]) -> DataFrame:
    cells = [
        F.when(present(f).isNotNull(), F.struct(
            F.lit(f).alias("feature"), bin_index(f, lo, hi, bins).alias("bin")))
        for f, (lo, hi) in spans.items()
    ]
    wide = df.select(
        F.explode(F.array_compact(F.array(*cells))).alias("c"),
        *[c.alias(n) for n, c in counts.items()],
    )
    return wide.groupBy("c.feature", "c.bin").agg(*[F.sum(n).alias(n) for n in counts])


def histogram(
    df: DataFrame, features: Sequence[str], bins: int = 40,
    spans: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """``feature, bin, bin_low, bin_high, n, pct`` with empty bins."""
    spans = spans or value_ranges(df, features)
    counts = _binned_counts(df, spans, bins, {"n": F.lit(1).cast("bigint")})
    return (
        _every_bin(df.sparkSession, spans, bins).join(counts, ["feature", "bin"], "left")
        .withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
        .withColumn("pct", F.try_divide(
            F.col("n") * 100.0, F.sum("n").over(Window.partitionBy("feature"))))
    )


def histogram_by_class(
    df: DataFrame, features: Sequence[str], target: str, bins: int = 30
) -> DataFrame:
    """Common edges per feature, counts of class 0, class 1 and both."""
    spans = value_ranges(df, features)
    y, one, zero = F.col(target), F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    counts = _binned_counts(df, spans, bins, {
        "n_class_0": F.when(y == 0, one).otherwise(zero),
        "n_class_1": F.when(y == 1, one).otherwise(zero),
    })
    out = _every_bin(df.sparkSession, spans, bins).join(counts, ["feature", "bin"], "left")
    return out.withColumns(
        {n: F.coalesce(n, zero) for n in ("n_class_0", "n_class_1")}
    ).withColumn("n_overall", F.col("n_class_0") + F.col("n_class_1"))


def distribution_comparison(
    before: DataFrame, after: DataFrame, feature: str, bins: int = 40
) -> DataFrame:
    """Histograms of one feature in two tables over shared edges."""
    a, b = value_ranges(before, [feature]), value_ranges(after, [feature])
    both = [s[feature] for s in (a, b) if feature in s]
    if not both:
        raise ValueError(f"{feature!r} has no values in either table")
    spans = {feature: (min(lo for lo, _ in both), max(hi for _, hi in both))}
    parts = [
        histogram(df, [feature], bins, spans).select(F.lit(name).alias("dataset"), "*")
        for name, df in (("before", before), ("after", after))
    ]
    return parts[0].unionByName(parts[1])


def box_summary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Quartiles, mean, population deviation and 1.5 IQR whiskers per feature."""
    cuts = exact_quantiles(df, features, [0.25, 0.5, 0.75])
    rows = []
    for f in features:
        x, (q1, q2, q3) = present(f), cuts[f]
        lo = q1 - 1.5 * (q3 - q1) if q1 is not None else None
        hi = q3 + 1.5 * (q3 - q1) if q1 is not None else None
        rows.append(F.struct(
            F.lit(q1).cast("double").alias("q1"), F.lit(q2).cast("double").alias("median"),
            F.lit(q3).cast("double").alias("q3"), F.avg(x).alias("mean"),
            F.stddev_pop(x).alias("std"),
            F.min(F.when(x >= F.lit(lo), x)).alias("whisker_low"),
            F.max(F.when(x <= F.lit(hi), x)).alias("whisker_high"),
        ).alias(f))
    return df.agg(*rows).unpivot([], list(features), "feature", "s").select("feature", "s.*")


def confidence_interval(
    df: DataFrame, groups: Sequence[str], value: str, confidence: float = 0.95
) -> DataFrame:
    """Mean with Student t bounds per group; fewer than two values have no bounds."""

    @F.pandas_udf("double")
    def t_bound(n: pd.Series) -> pd.Series:
        # one value per group, cached per distinct size
        tail = 0.5 * (1.0 + confidence)
        return n.map(lambda k: t_quantile(tail, float(k - 1)) if k > 1 else None).astype("float64")

    x = present(value)
    facts = df.groupBy(*groups).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("s")
    )
    half = F.nanvl(t_bound("n"), F.lit(None)) * F.col("s") / F.sqrt(F.col("n"))
    enough = F.col("n") > 1
    return facts.select(
        *groups, "n", "mean",
        F.when(enough, F.col("s") / F.sqrt("n")).alias("std_error"),
        F.when(enough, F.col("mean") - half).alias("ci_low"),
        F.when(enough, F.col("mean") + half).alias("ci_high"),
    )


def attribution_summary(df: DataFrame) -> DataFrame:
    """From long ``row_id, feature, value``: mean absolute value and quartile band 0-3.

    Features are ranked ascending; band ``k`` starts at position ``int(n * k / 4)``.
    """
    everything = F.lit(1)
    means = df.groupBy("feature").agg(F.avg(F.abs(F.col("value"))).alias("mean_abs"))
    # one row per feature
    ranked = means.withColumns({
        "position": F.row_number().over(
            Window.partitionBy(everything).orderBy("mean_abs", "feature")) - 1,
        "__n": F.count(F.lit(1)).over(Window.partitionBy(everything)),
    })
    starts = [F.floor(F.col("__n") * q / 4).cast("int") for q in (1, 2, 3)]
    band = sum(((F.col("position") >= s).cast("int") for s in starts), F.lit(0))
    return ranked.withColumn("band", band).drop("__n")


def attribution_top(df: DataFrame, top_n: int | None = None) -> DataFrame:
    """Features of each row by absolute contribution, largest first."""
    order = Window.partitionBy("row_id").orderBy(F.desc(F.abs(F.col("value"))), "feature")
    ranked = df.withColumn("position", F.row_number().over(order))
    return ranked if top_n is None else ranked.where(F.col("position") <= top_n)


def linear_attributions(
    df: DataFrame, id_column: str, coefficients: dict[str, float], means: dict[str, float]
) -> DataFrame:
    """Long contributions of a linear model: coefficient times distance from the mean."""
    cells = [
        F.struct(F.lit(f).alias("feature"), present(f).alias("feature_value"),
                 (F.lit(float(b)) * (present(f) - F.lit(float(means[f])))).alias("value"))
        for f, b in coefficients.items()
    ]
    return df.select(F.col(id_column).alias("row_id"), F.explode(F.array(*cells)).alias("a")).select(
        "row_id", "a.*"
    )


def metric_table(long: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Long ``model, metric, value`` to one row per model; unknown metrics raise."""
    known = set(levels(long, "metric"))
    absent = [m for m in metrics if m not in known]
    if absent:
        raise ValueError(f"metrics not available: {absent}")
    return long.groupBy("model").pivot("metric", list(metrics)).agg(F.first("value"))


def rank_models(long: DataFrame) -> DataFrame:
    """Models by each metric, best first."""
    order = Window.partitionBy("metric").orderBy(F.desc("value"), "model")
    return long.withColumn("position", F.row_number().over(order))


def top_share(table: DataFrame, importance: str, threshold: float) -> DataFrame:
    """The ``max(1, int(n * threshold))`` most important features."""
    n = table.count()
    return table.orderBy(F.desc(importance), "feature").limit(max(1, int(n * threshold)))
