"""Column quality: missing values, variance, correlation, duplicates, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.scalars import present
from loanloom.operators.duplicates import duplicated_total, repeated_rows
from loanloom.operators.gram import pair_correlations
from loanloom.operators.quantiles import exact_quantiles
from loanloom.operators.schema import numeric_columns

# An aggregate with more expressions than this is cut into several jobs, so that the
# generated code stays compilable for very wide tables.
EXPRESSIONS_PER_JOB = 400


def is_missing(name: str, kind: str) -> Column:
    c = F.col(f"`{name}`")
    return c.isNull() | F.isnan(c) if kind in ("double", "float") else c.isNull()


def _aggregate(df: DataFrame, exprs: dict[str, Column]) -> dict:
    """Evaluate named aggregates, one job per block of expressions."""
    names, out = list(exprs), {}
    for start in range(0, len(names), EXPRESSIONS_PER_JOB):
        block = names[start:start + EXPRESSIONS_PER_JOB]
        row = df.agg(*[exprs[n].alias(f"a{i}") for i, n in enumerate(block)]).first()
        out.update({n: row[f"a{i}"] for i, n in enumerate(block)})
    return out


def missing_ratios(df: DataFrame) -> dict[str, float]:
    kinds = dict(df.dtypes)
    exprs = {c: F.count_if(is_missing(c, kinds[c])) for c in df.columns}
    got = _aggregate(df, {**exprs, "__rows": F.count(F.lit(1))})
    rows = got.pop("__rows")
    return {c: (n / rows if rows else 0.0) for c, n in got.items()}


def filter_by_missing(df: DataFrame, threshold: float) -> list[str]:
    return [c for c, ratio in missing_ratios(df).items() if ratio <= threshold]


def sample_variances(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return _aggregate(df, {c: F.var_samp(present(c)) for c in columns})


def filter_by_variance(df: DataFrame, columns: Sequence[str], threshold: float) -> list[str]:
    found = sample_variances(df, columns)
    return [c for c in columns if found[c] is not None and found[c] > threshold]


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> dict[str, float]:
    """Absolute correlation with the target; 0 when undefined."""
    got = {r["x"]: r["r"] for r in pair_correlations(df, columns, [target]).collect()}
    return {c: abs(got[c]) if got.get(c) is not None else 0.0 for c in columns}


def filter_by_correlation(
    df: DataFrame, columns: Sequence[str], target: str, threshold: float
) -> list[str]:
    found = target_correlations(df, columns, target)
    return [c for c in columns if found[c] >= threshold]


def feature_reduction_report(
    train: DataFrame,
    test: DataFrame,
    target: str,
    missing_threshold: float = 0.3,
    variance_threshold: float = 0.01,
    correlation_threshold: float = 0.05,
    essential: Sequence[str] = (),
    fit_on: str = "both",
) -> list[dict]:
    """Per column: missing ratio, variance, correlation and whether it is kept.

    Missing ratio and variance come from train and test together (``fit_on="train"``
    restricts them), the correlation from train only.
    """
    if target not in train.columns:
        raise ValueError(f"target column {target!r} not found")
    features = [c for c in train.columns if c != target]
    base = train.select(*features)
    if fit_on == "both":
        base = base.unionByName(test.select(*features))
    numbers = [c for c in numeric_columns(train) if c != target]
    kinds = dict(base.dtypes)
    got = _aggregate(base, {
        "rows": F.count(F.lit(1)),
        **{f"m:{c}": F.count_if(is_missing(c, kinds[c])) for c in features},
        **{f"v:{c}": F.var_samp(present(c)) for c in numbers},
    })
    corr = target_correlations(train, numbers, target) if numbers else {}
    report = []
    for c in features:
        ratio = got[f"m:{c}"] / got["rows"] if got["rows"] else 0.0
        variance, r = got.get(f"v:{c}"), corr.get(c)
        keep = ratio <= missing_threshold
        if c in numbers:
            keep = (keep and variance is not None and variance > variance_threshold
                    and r >= correlation_threshold)
        report.append({
            "feature": c, "missing_ratio": ratio, "variance": variance,
            "abs_correlation": r, "kept": bool(keep or c in essential),
        })
    return report


def initial_feature_reduction(
    train: DataFrame, test: DataFrame, target: str, **options
) -> tuple[DataFrame, DataFrame]:
    """Both tables cut to the kept columns in input order; train has the target first."""
    kept = [r["feature"] for r in feature_reduction_report(train, test, target, **options)
            if r["kept"]]
    return train.select(target, *kept), test.select(*kept)


def missing_percentages(df: DataFrame) -> DataFrame:
    """``column_name, n_missing, pct`` for every column that misses a value."""
    kinds = dict(df.dtypes)
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(is_missing(c, kinds[c])).alias(c) for c in df.columns],
    )
    return (
        counts.unpivot("__rows", list(df.columns), "column_name", "n_missing")
        .where("n_missing > 0")
        .withColumn("pct", F.col("n_missing") / F.col("__rows") * 100)
        .drop("__rows")
    )


def get_top_missing_value_percentages(df: DataFrame, top_n: int = 5) -> DataFrame:
    """The ``top_n`` columns by missing share; ordered before rounding, ties by name."""
    return (
        missing_percentages(df)
        .orderBy(F.desc("pct"), "column_name").limit(top_n)
        .withColumn("pct", F.round("pct", 2))
    )


def analyze_missing_values(train: DataFrame, test: DataFrame, top_n: int = 5) -> DataFrame:
    parts = [
        get_top_missing_value_percentages(df, top_n).select(F.lit(name).alias("dataset"), "*")
        for name, df in (("train", train), ("test", test))
    ]
    return parts[0].unionByName(parts[1])


def count_duplicated_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number of rows that belong to a group of equal rows (all members count)."""
    return duplicated_total(repeated_rows(df, columns))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, missing, mean, standard deviation, min, linear quartiles and max."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    schema = "feature string, q1 double, median double, q3 double"
    cuts = df.sparkSession.createDataFrame([(c, *quartiles[c]) for c in columns], schema)
    facts = df.select(
        *[
            F.struct(
                F.count(present(c)).alias("n"),
                F.count_if(present(c).isNull()).alias("n_missing"),
                F.avg(present(c)).alias("mean"),
                F.stddev_samp(present(c)).alias("std"),
                F.min(present(c)).alias("min"),
                F.max(present(c)).alias("max"),
            ).alias(c)
            for c in columns
        ]
    ).unpivot([], columns, "feature", "s").select("feature", "s.*")
    return facts.join(cuts, "feature")


def distinct_counts(
    df: DataFrame, columns: Sequence[str], approximate: bool = False
) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "n_distinct"
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``value, n, share`` without missing values."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    )
    total = df.agg(F.count(F.col(column))).scalar()
    return counts.select("value", "n", (F.col("n") / total).alias("share"))


def diagnose_target(df: DataFrame, target: str) -> DataFrame:
    """Rows, distinct values, missing and the counts per value as ``item, n`` rows."""
    facts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.col(target)).alias("distinct"),
        F.count_if(F.col(target).isNull()).alias("missing"),
    ).unpivot([], ["rows", "distinct", "missing"], "item", "n")
    counts = value_counts(df, target).select(
        F.concat(F.lit("value="), F.col("value")).alias("item"), "n"
    )
    return facts.unionByName(counts)


def drop_missing(df: DataFrame, max_column_ratio: float = 1.0, max_row_ratio: float = 1.0):
    """``ext_``: drop columns, then rows, whose missing ratio exceeds the limits."""
    kept = df.select(*filter_by_missing(df, max_column_ratio))
    kinds = dict(kept.dtypes)
    missing = sum((is_missing(c, kinds[c]).cast("int") for c in kept.columns), F.lit(0))
    return kept.where(missing / len(kept.columns) <= max_row_ratio)
