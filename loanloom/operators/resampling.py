"""Bootstrap and simulation replicates as Spark tasks."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.operators.rank import prefix_sum
from loanloom.session import stage

#: Neighbouring values that one draw deals with, and children of one node of the tree above them.
LEAF = 4096
FAN = 256


def _code(text: str) -> int:
    return zlib.crc32(text.encode())


def _generator(seed: int, feature: str, label: int, level: int, node: int) -> np.random.Generator:
    """A generator that the seed, feature, class and node of the tree alone decide."""
    name = f"{seed}:{label}:{level}:{node}:{feature}".encode()
    return np.random.Generator(np.random.Philox(key=int.from_bytes(hashlib.blake2b(name, digest_size=16).digest(), "little")))


def _dealt(rng: np.random.Generator, draws: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``draws[r]`` rows dealt to the places in proportion to ``counts``: one row a replicate."""
    out = np.zeros((len(draws), len(counts)), dtype=np.int64)
    some = np.flatnonzero(counts)
    if len(some):
        out[:, some] = rng.multinomial(draws, counts[some] / counts[some].sum())
    return out


_NODE = "feature string, node bigint, m0 array<bigint>, m1 array<bigint>, before array<bigint>"


def _splitter(seed: int, level: int):
    """Deals what one node got to its children, in their order."""

    def split(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, above = left.sort_values("node"), right.iloc[0]
        feature, node = above["feature"], int(above["node"])
        m = [_dealt(_generator(seed, feature, c, level, node), np.asarray(above[f"m{c}"]), left[f"n{c}"].to_numpy())
             for c in (0, 1)]
        before = np.asarray(above["before"])[:, None] + np.cumsum(m[1], axis=1) - m[1]
        return pd.DataFrame({"feature": feature, "node": left["node"].to_numpy(), "m0": list(m[0].T), "m1": list(m[1].T),
                             "before": list(before.T)})

    return split


def _shared_out(blocks: DataFrame, replicates: int, seed: int) -> DataFrame:
    """How many rows of each class every block gets in each replicate (_NODE), and how many of
    class 1 the blocks ``before`` it got.

    All rows of a class stand at the root; every node deals its rows to at most FAN children.
    The tree is over positions in the order of values, so it has one level for every factor of
    FAN in the number of blocks, and any cut of the table into ranges gives the same tree.
    """
    last = blocks.agg(F.max("node")).first()[0] or 0
    levels = 0
    while last // FAN**levels:
        levels += 1
    times = lambda c: F.array_repeat(c.cast("bigint"), replicates)
    drawn = blocks.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).select(
        "feature", F.lit(0).cast("bigint").alias("node"), times(F.col("n0")).alias("m0"), times(F.col("n1")).alias("m1"),
        times(F.lit(0)).alias("before"))
    for level in range(levels - 1, -1, -1):
        children = blocks.groupBy("feature", F.expr(f"node div {FAN**level}L").alias("node")).agg(
            F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).withColumn("parent", F.expr(f"node div {FAN}L"))

        drawn = children.groupBy("feature", "parent").cogroup(drawn.groupBy("feature", "node")).applyInPandas(_splitter(seed, level + 1), _NODE)
    return drawn


def bootstrap_replicates(hist: DataFrame, replicates: int = 500, seed: int = 42) -> DataFrame:
    """``feature, replicate, m0, m1, delta`` of Cliff's delta under resampling in each class.

    ``hist`` holds counted values per value range (``feature, part, value, n0, n1``).  Every
    replicate draws as many rows as a class has, with replacement: numbers of draws are
    multinomial, dealt down a tree over the ordered values, so ``m0`` and ``m1`` are the class
    sizes in all of them.  A draw depends on a node's place and its counts, not on where ranges
    are cut, so any partitioning gives the same replicates.  The cost is linear in the values.
    A block's pairs need its own values and the draws before it, which come down the tree.
    """
    # written first: the sides of the prefix sum read different columns, each would count the table anew
    own = stage(hist.select("feature", "part", "value", "n0", "n1", F.lit(1).cast("bigint").alias("n")), "histogram")
    values = stage(prefix_sum(own, ["feature"], "value", ["n"]).select(
        "feature", "value", "n0", "n1", F.expr(f"before_n div {LEAF}L").alias("node")), "bootstrap")
    blocks = values.groupBy("feature", "node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))

    def draw(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, above = left.sort_values("value"), right.iloc[0]
        feature, node = above["feature"], int(above["node"])
        w = [_dealt(_generator(seed, feature, c, 0, node), np.asarray(above[f"m{c}"]), left[f"n{c}"].to_numpy())
             for c in (0, 1)]
        below = np.asarray(above["before"])[:, None] + np.cumsum(w[1], axis=1) - w[1]
        return pd.DataFrame({
            "feature": feature, "replicate": np.arange(replicates, dtype="int32"), "m0": w[0].sum(axis=1),
            "m1": w[1].sum(axis=1), "won": (w[0] * (below + w[1] / 2)).sum(axis=1)})

    # a block is short and its draws long: the number of tasks must not follow the bytes
    spark = hist.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    drawn = values.repartition(tasks, "feature", "node").groupBy("feature", "node").cogroup(
        _shared_out(blocks, replicates, seed).groupBy("feature", "node")).applyInPandas(
        draw, "feature string, replicate int, m0 bigint, m1 bigint, won double")
    sums = drawn.groupBy("feature", "replicate").agg(
        F.sum("won").alias("won"), F.sum("m0").alias("m0"), F.sum("m1").alias("m1"))
    pairs = F.col("m0").cast("double") * F.col("m1")
    return sums.select("feature", "replicate", "m0", "m1", (F.try_divide(2 * F.col("won"), pairs) - 1).alias("delta"))


def bootstrap_delta(hist: DataFrame, replicates: int = 500, seed: int = 42) -> DataFrame:
    """``feature, ci_low, ci_high``: 2.5 and 97.5 percentiles over the replicates."""
    bounds = F.percentile("delta", F.array(F.lit(0.025), F.lit(0.975)))
    return (
        bootstrap_replicates(hist, replicates, seed).groupBy("feature").agg(bounds.alias("b"))
        .select("feature", F.col("b")[0].alias("ci_low"), F.col("b")[1].alias("ci_high"))
    )


def _chi2(tables: np.ndarray, corrected: bool) -> tuple[np.ndarray, np.ndarray]:
    """Chi-square of many r x c tables at once, and which of them have full margins."""
    rows, cols = tables.sum(axis=2), tables.sum(axis=1)
    expected = rows[:, :, None] * cols[:, None, :] / tables.sum(axis=(1, 2))[:, None, None]
    gap = np.abs(tables - expected)
    if corrected and tables.shape[1:] == (2, 2):
        gap = gap - np.minimum(0.5, gap)
    safe = np.where(expected > 0, expected, 1.0)
    value = np.where(expected > 0, gap**2 / safe, 0.0).sum(axis=(1, 2))
    return value, (rows > 0).all(axis=1) & (cols > 0).all(axis=1)


def resample_tables(
    spark: SparkSession, tables: dict[str, list[list[int]]], replicates: int, seed: int = 42,
    null: str = "observed",
) -> DataFrame:
    """Per feature a simulated p-value and an interval of Cramer's V.

    ``tables`` are small r x c counts.  ``null`` chooses the cell shares to draw from: the
    observed ones, or the product of the margins.  Replicates with an empty margin do not
    count for the interval; ``n_skipped`` says how many there were.
    """
    if null not in ("observed", "independence"):
        raise ValueError(f"unknown null {null!r}")
    for f, t in tables.items():
        if not t or sum(map(sum, t)) == 0:
            raise ValueError(f"the table of {f!r} is empty")
    names = list(tables)
    index = spark.range(len(names) * replicates, numPartitions=spark.sparkContext.defaultParallelism)
    keep = {f: [[float(v) for v in row] for row in t] for f, t in tables.items()}

    def draw(batches):
        for pdf in batches:
            parts = []
            for code, ids in pdf["id"].groupby(pdf["id"] // replicates):
                name = names[int(code)]
                observed = np.array(keep[name])
                n = observed.sum()
                shares = observed / n
                if null == "independence":
                    shares = np.outer(shares.sum(axis=1), shares.sum(axis=0))
                numbers = (ids % replicates).to_numpy()
                drawn = np.stack([
                    np.random.default_rng([seed + int(r), _code(name)])
                    .multinomial(int(n), shares.ravel()).reshape(observed.shape)
                    for r in numbers
                ]).astype("float64")
                plain, _ = _chi2(drawn, corrected=False)
                full_table = observed[None]
                reference, _ = _chi2(full_table, corrected=False)
                value, usable = _chi2(drawn, corrected=True)
                smaller = max(1, min(observed.shape) - 1)
                parts.append(pd.DataFrame({
                    "feature": name, "as_large": plain >= reference[0],
                    "v": np.where(usable, np.sqrt(value / (n * smaller)), np.nan),
                }))
            if parts:
                yield pd.concat(parts)

    drawn = index.mapInPandas(draw, "feature string, as_large boolean, v double")
    usable = F.when(~F.isnan("v"), F.col("v"))
    bounds = F.percentile(usable, F.array(F.lit(0.025), F.lit(0.975)))
    return drawn.groupBy("feature").agg(
        F.avg(F.col("as_large").cast("double")).alias("p_value"), bounds.alias("b"),
        F.count_if(usable.isNull()).alias("n_skipped"),
    ).select(
        "feature", "p_value", F.col("b")[0].alias("ci_low"), F.col("b")[1].alias("ci_high"),
        "n_skipped",
    )
