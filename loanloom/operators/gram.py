"""Pairwise-complete second moments of many columns from one scan.

A batch of rows becomes a matrix of values and a matrix of marks for what is there.  Products
of the two give, for all pairs at once, how often both sides are there and the sums over those
rows.  Moments are centred per batch and merged pair by pair; means are kept as the distance
from a value of their column, so large ones lose no digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions.scalars import present

#: Moments kept per pair: rows with both sides, rows with an infinite side, a value of each side,
#: the means less that value, the sums of squares and of products about the means.
MOMENTS = ["n", "endless", "base_x", "base_y", "mean_x", "mean_y", "square_x", "square_y", "product"]
#: Partial results that one task merges at a time.
FAN_IN = 64
#: Levels of merging, for up to ``FAN_IN ** LEVELS`` partitions.
LEVELS = 3
#: Below this share of the squares about the batch's first value a pair is summed once more.
CANCELLED = 1e-9


def _pair(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Moments of one pair about its own first row, exact where a side is constant."""
    fx, fy = x - x[0], y - y[0]
    mx, my = fx.mean(), fy.mean()
    return (x[0], y[0], mx, my, ((fx - mx) ** 2).sum() if fx.any() else 0.0,
            ((fy - my) ** 2).sum() if fy.any() else 0.0, ((fx - mx) * (fy - my)).sum())


def batch_moments(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Moments of all pairs of a column of ``left`` and one of ``right``; NaN is a missing value."""

    def parts(values):
        there = ~np.isnan(values)
        usable = np.isfinite(values)
        first = np.where(usable.any(axis=0), values[usable.argmax(axis=0), np.arange(values.shape[1])], 0.0)
        return there.astype(float), usable.astype(float), first, np.where(usable, values - first, 0.0)

    with np.errstate(invalid="ignore"):
        there_x, mark_x, first_x, x = parts(left)
        there_y, mark_y, first_y, y = parts(right)
    n = mark_x.T @ mark_y
    safe = np.maximum(n, 1.0)
    sum_x, sum_y = x.T @ mark_y, mark_x.T @ y
    raw_x, raw_y = (x * x).T @ mark_y, mark_x.T @ (y * y)
    square_x, square_y = raw_x - sum_x**2 / safe, raw_y - sum_y**2 / safe
    product = x.T @ y - sum_x * sum_y / safe
    zero = np.zeros_like(n)
    found = np.stack([n, zero, first_x[:, None] + zero, first_y[None, :] + zero, sum_x / safe, sum_y / safe,
                      square_x, square_y, product])
    weak = ((raw_x > 0) & (square_x <= CANCELLED * raw_x)) | ((raw_y > 0) & (square_y <= CANCELLED * raw_y))
    for i, j in zip(*np.nonzero(weak), strict=True):
        both = (mark_x[:, i] > 0) & (mark_y[:, j] > 0)
        found[2:, i, j] = _pair(left[both, i], right[both, j])
    found[1] = there_x.T @ there_y - n
    return found


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of the rows of both; the first axis holds :data:`MOMENTS`."""
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1.0)
    weight = a[0] * share
    base = np.where(a[0] == 0, b[2:4], a[2:4])
    # values of one column are near each other, so their difference is exact where it matters
    from_a, from_b = a[4:6] + (a[2:4] - base), b[4:6] + (b[2:4] - base)
    step = from_b - from_a
    mean = np.where(a[0] == 0, from_b, np.where(b[0] == 0, from_a, from_a + step * share))
    both = np.concatenate([step * step, (step[0] * step[1])[None]]) * weight
    return np.concatenate([[n, a[1] + b[1]], base, mean, a[6:] + b[6:] + both])


def _merged_rows(parts: pd.DataFrame) -> pd.DataFrame:
    ordered = parts.sort_values("part")
    total = None
    for row in ordered[MOMENTS].itertuples(index=False):
        each = np.stack([np.asarray(v, dtype=float) for v in row])
        total = each if total is None else merged(total, each)
    out = {"x": [int(ordered["x"].iloc[0])], "part": [int(ordered["part"].iloc[0]) // FAN_IN]}
    return pd.DataFrame({**out, **{m: [total[i]] for i, m in enumerate(MOMENTS)}})


def pair_moments(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """``x`` (position in ``left``) with an array over ``right`` for each of :data:`MOMENTS`.

    One scan reads the columns; every partition sends one row per column of ``left``, and those
    are merged by a tree, :data:`FAN_IN` partitions at a time.  Missing values and NaN leave a
    row out of their pairs only.  An empty table gives no rows.
    """
    names = list(dict.fromkeys([*left, *right]))
    at = {name: i for i, name in enumerate(names)}
    x_at, y_at = [at[c] for c in left], [at[c] for c in right]
    schema = "x int, part bigint, " + ", ".join(f"{m} array<double>" for m in MOMENTS)

    def partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if not len(batch):
                continue
            values = batch.to_numpy(dtype=float, na_value=np.nan)
            found = batch_moments(values[:, x_at], values[:, y_at])
            total = found if total is None else merged(total, found)
        if total is not None:
            part = TaskContext.get().partitionId()
            yield pd.DataFrame({
                "x": np.arange(len(x_at), dtype=np.int32), "part": part,
                **{m: list(total[i]) for i, m in enumerate(MOMENTS)}})

    numbers = df.select(*[present(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(names)])
    found = numbers.mapInPandas(partition, schema)
    for _ in range(LEVELS):
        group = F.floor(F.col("part") / FAN_IN).alias("group")
        found = found.groupBy("x", group).applyInPandas(_merged_rows, schema)
    return found.drop("part")


def pair_correlations(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """Long ``x, y, n, r``: Pearson correlation over the rows that have both sides.

    ``r`` is null with fewer than two such rows or a constant side, and NaN with an infinite one.
    """
    left, right = list(left), list(right)
    if not left or not right:
        return df.sparkSession.createDataFrame([], "x string, y string, n bigint, r double")
    cells = pair_moments(df, left, right).select(
        "x", F.posexplode(F.arrays_zip(*MOMENTS)).alias("y", "m"))
    spread = F.sqrt(F.col("m.square_x")) * F.sqrt(F.col("m.square_y"))
    r = F.when(F.col("m.endless") > 0, F.lit(float("nan"))).when(
        F.col("m.n") > 1, F.col("m.product") / F.nullif(spread, F.lit(0.0)))
    x_names, y_names = (F.array(*[F.lit(c) for c in names]) for names in (left, right))
    return cells.select(
        F.get(x_names, "x").alias("x"), F.get(y_names, "y").alias("y"),
        (F.col("m.n") + F.col("m.endless")).cast("bigint").alias("n"), r.alias("r"))
