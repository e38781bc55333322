"""Interquartile fences, anomaly rows and flags, z-score outliers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.scalars import present
from loanloom.operators.quantiles import exact_quantiles
from loanloom.operators.schema import require_numeric

Fences = dict[str, tuple[float, float]]


def iqr_fences(df: DataFrame, features: Sequence[str], factor: float = 1.5) -> Fences:
    """``feature -> (lower, upper)``; features without values have no fence."""
    quartiles = exact_quantiles(df, require_numeric(df, features), [0.25, 0.75])
    return {
        f: (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
        for f, (q1, q3) in quartiles.items() if q1 is not None
    }


def fences_table(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(f, *bounds) for f, bounds in iqr_fences(df, features).items()],
        "feature string, lower_fence double, upper_fence double",
    )


def outside(fences: Fences) -> Column:
    """True when any feature is strictly outside its fence; missing is never outside."""
    checks = [
        F.coalesce((present(f) < F.lit(lo)) | (present(f) > F.lit(hi)), F.lit(False))
        for f, (lo, hi) in fences.items()
    ]
    return reduce(lambda a, b: a | b, checks, F.lit(False))


def detect_anomalies_iqr(
    df: DataFrame, features: Sequence[str], fences: Fences | None = None
) -> DataFrame:
    """Distinct anomalous rows (over all columns), projected to the features."""
    found = iqr_fences(df, features) if fences is None else fences
    return df.where(outside(found)).dropDuplicates().select(*features)


def flag_anomalies(
    df: DataFrame, features: Sequence[str], fences: Fences | None = None,
    output: str = "is_anomaly",
) -> DataFrame:
    """Add a boolean flag; pass training ``fences`` to flag another table with them."""
    return df.withColumn(output, outside(iqr_fences(df, features) if fences is None else fences))


def ext_zscore_fences(df: DataFrame, features: Sequence[str], limit: float = 3.0) -> Fences:
    """``ext_``: mean +/- ``limit`` sample standard deviations."""
    row = df.agg(
        *[F.avg(present(f)).alias(f"m{i}") for i, f in enumerate(features)],
        *[F.stddev_samp(present(f)).alias(f"s{i}") for i, f in enumerate(features)],
    ).first()
    return {
        f: (row[f"m{i}"] - limit * row[f"s{i}"], row[f"m{i}"] + limit * row[f"s{i}"])
        for i, f in enumerate(features) if row[f"s{i}"] is not None
    }
