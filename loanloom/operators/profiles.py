"""Profiles that are stored per file and merged for any union of files.

A profile row describes one column of one file: counts, moments, ends, a quantile sketch and a
distinct sketch.  Rows are merged without reading the files again, so adding a day of data
costs one pass over that day.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.scalars import present
from loanloom.operators.schema import numeric_columns

#: Size of the quantile sketches: ranks are off by about 1.65 % of the rows at 200, 0.33 % here.
RANK_SIZE = 1_000
#: Binary logarithm of the places in a distinct sketch: a standard error of about 0.8 %.
DISTINCT_SIZE = 14
#: Columns described by one aggregation; each holds a sketch of ``2 ** DISTINCT_SIZE`` bytes.
COLUMNS_AT_ONCE = 50

PROFILE = ("file string, feature string, n bigint, n_missing bigint, n_finite bigint, mean double, "
           "squares double, low double, high double, ranks binary, distincts binary")


def _facts(name: str, kind: str, numeric: bool) -> Column:
    raw = F.col(f"`{name}`")
    number = present(raw) if numeric else F.lit(None).cast("double")
    there = number if numeric else raw
    finite = F.when(F.abs(number) != F.lit(float("inf")), number)
    text = (number + F.lit(0.0)).cast("string") if numeric and kind in ("double", "float") else raw.cast("string")
    return F.struct(
        F.lit(name).alias("feature"), F.count(there).alias("n"), F.count_if(there.isNull()).alias("n_missing"),
        F.count(finite).alias("n_finite"), F.avg(finite).alias("mean"),
        (F.var_pop(finite) * F.count(finite)).alias("squares"),
        F.min(number).alias("low"), F.max(number).alias("high"),
        F.kll_sketch_agg_double(number, F.lit(RANK_SIZE)).alias("ranks"),
        F.hll_sketch_agg(F.when(there.isNotNull(), text), F.lit(DISTINCT_SIZE)).alias("distincts"))


def file_profiles(df: DataFrame, columns: Sequence[str] | None = None, file: Column | None = None) -> DataFrame:
    """One row per file and column, with the columns of :data:`PROFILE`.

    ``file`` names the part a row belongs to, by default the path of the file it was read from.
    """
    names = list(columns or df.columns)
    numbers, kinds = set(numeric_columns(df)), dict(df.dtypes)
    part = (F.col("_metadata.file_path") if file is None else file).alias("file")
    base = df.select(part, *[F.col(f"`{c}`") for c in names])
    out = None
    for at in range(0, len(names), COLUMNS_AT_ONCE):
        block = names[at:at + COLUMNS_AT_ONCE]
        facts = base.groupBy("file").agg(F.array(*[_facts(c, kinds[c], c in numbers) for c in block]).alias("all"))
        rows = facts.select("file", F.explode("all").alias("c")).select("file", "c.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def merge_profiles(profiles: DataFrame, *keys: str) -> DataFrame:
    """Profiles of the union of all parts, per ``keys`` and feature, from their stored rows alone.

    Sketches are merged where they lie before they are exchanged.  Merging again what was merged
    before is allowed: ``merge(a + b) = merge(merge(a) + merge(b))`` for all counts and ends.
    """
    total = F.sum("n_finite")
    names = [*keys, "feature"]
    inner = profiles.groupBy(*names).agg(
        F.sum("n").alias("n"), F.sum("n_missing").alias("n_missing"), total.alias("n_finite"),
        (F.sum(F.col("mean") * F.col("n_finite")) / F.nullif(total, F.lit(0))).alias("mean"),
        F.sum("squares").alias("inside"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("ranks").alias("ranks"), F.hll_union_agg("distincts").alias("distincts"))
    # spread of the parts' means about the mean of all, which takes no large squares
    parts, centres = profiles.alias("p"), inner.select(*names, F.col("mean").alias("centre")).alias("c")
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"c.{k}")) for k in names]
    between = parts.join(centres, same).groupBy(*[F.col(f"p.{k}").alias(k) for k in names]).agg(
        F.sum(F.col("n_finite") * F.pow(F.col("p.mean") - F.col("centre"), 2)).alias("between"))
    both, extra = inner.alias("i"), between.alias("b")
    same = [F.col(f"i.{k}").eqNullSafe(F.col(f"b.{k}")) for k in names]
    return both.join(extra, same).select(
        *[F.col(f"i.{k}").alias(k) for k in names], "n", "n_missing", "n_finite", "mean",
        (F.col("inside") + F.coalesce("between", F.lit(0.0))).alias("squares"),
        "low", "high", "ranks", "distincts")


def described(profiles: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Readable form: counts, mean, standard deviation, ends, quantiles and distinct values.

    Counts and ends are exact, ``mean`` and ``std`` are over finite values; quantiles and the
    number of distinct values are estimates and named so.  A column without numbers has nulls.
    """
    keys = [c for c in profiles.columns if c not in {
        "feature", "n", "n_missing", "n_finite", "mean", "squares", "low", "high", "ranks", "distincts"}]
    holds = F.kll_sketch_get_n_double("ranks") > 0
    return profiles.select(
        *keys, "feature", "n", "n_missing", "mean",
        F.when(F.col("n_finite") > 1, F.sqrt(F.col("squares") / (F.col("n_finite") - 1))).alias("std"),
        F.col("low").alias("min"), F.col("high").alias("max"),
        *[F.when(holds, F.kll_sketch_get_quantile_double("ranks", F.lit(float(p)))).alias(
            f"q{round(p * 100):02d}_estimate") for p in probs],
        F.hll_sketch_estimate("distincts").alias("n_distinct_estimate"))


def add_profiles(df: DataFrame, path: str, columns: Sequence[str] | None = None, file: Column | None = None) -> None:
    """Store the profiles of the files behind ``df``; a file that was stored before is replaced.

    Every file has a folder of its own, so a repeated task or a second run leaves one profile.
    """
    rows = file_profiles(df, columns, file).withColumn("part", F.sha2("file", 256))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def read_profiles(spark: SparkSession, path: str, files: Sequence[str] | None = None) -> DataFrame:
    """Stored profiles, of all files or of the named ones; other folders aren't opened."""
    found = spark.read.schema(PROFILE + ", part string").parquet(path)
    if files is not None:
        found = found.where(F.col("part").isin([hashlib.sha256(f.encode()).hexdigest() for f in files]))
    return found.drop("part")
