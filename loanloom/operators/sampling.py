"""Exact stratified samples and splits in hash order.

Rows of a class are ordered by ``md5(seed:id)``.  Numbering them with one window per class
would put half of the table into one task, so only the cut positions are looked up: count
rows per class and hash prefix, find the prefix in which a cut falls, repeat with longer
prefixes until few rows remain, and read the hash at the cut.  The sample or split itself
is then a comparison with those cuts: one narrow pass, no shuffle of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.session import stage

PREFIX_STEP = 3
CUT_ROWS = 200_000


def hash_key(id_column: str, seed: int, use: str = "") -> Column:
    """Hash text that orders rows at random but reproducibly; the id breaks ties.

    ``use`` separates draws: rows split in one order must be drawn again in another.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:{use}"), F.col(id_column).cast("string")))
    return F.concat(digest, F.lit(":"), F.col(id_column).cast("string"))


def hash_unit(id_column: str, seed: int, use: str) -> Column:
    """Uniform number in [0, 1) from the row's hash."""
    digits = F.substring(hash_key(id_column, seed, use), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / float(2**32)


def small(table: DataFrame, most: int = 10_000) -> DataFrame:
    """``table`` to be sent to every task if it has at most ``most`` rows."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def _cut_keys(keyed: DataFrame, ranks: DataFrame, cut_rows: int) -> DataFrame:
    """``class, rank, key``: hash key of the ``rank``-th (one-based) row of each class.

    Searches are rows too: prefix so far and rows before it.  Each round counts rows per
    longer prefix, keeps the prefix that holds the rank, and reads the key where few rows
    are left.
    """
    found, length = None, 0
    open_ = ranks.select("class", "rank", F.lit("").alias("prefix"), F.lit(0).cast("bigint").alias("before"))
    open_ = stage(open_, "searches")
    while open_.head(1):
        near = keyed.withColumn("prefix", F.substring("key", 1, length) if length else F.lit("")).join(
            small(open_.select("class", "prefix").distinct()), ["class", "prefix"])
        length += PREFIX_STEP
        # at most 16^3 rows per class and prefix
        inside = Window.partitionBy("class", "prefix").orderBy("next")
        counts = (
            near.groupBy("class", "prefix", F.substring("key", 1, length).alias("next"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("upto", F.sum("n").over(inside))
        )
        hits = stage(counts.join(small(open_), ["class", "prefix"]).where(
            "before + upto - n < rank and rank <= before + upto"
        ).selectExpr("class", "rank", "next as prefix", "n", "before + upto - n as before"), "searches")
        few = (F.col("n") <= cut_rows) | F.lit(length >= 30)
        close = small(hits.where(few).select(
            "class", "prefix", (F.col("rank") - F.col("before")).alias("local"), "rank"))
        numbered = keyed.withColumn("prefix", F.substring("key", 1, length)).join(
            small(hits.where(few).select("class", "prefix").distinct()), ["class", "prefix"], "left_semi"
        ).withColumn("local", F.row_number().over(
            Window.partitionBy("class", "prefix").orderBy("key")).cast("bigint"))
        part = stage(numbered.join(close, ["class", "prefix", "local"]).select("class", "rank", "key"), "cuts")
        found = part if found is None else found.unionByName(part)
        open_ = stage(hits.where(~few).select("class", "rank", "prefix", "before"), "searches")
    return found


def _class_key(column: str) -> Column:
    return F.col(column).cast("string")


def cut_by_rank(
    df: DataFrame,
    class_column: str | None,
    id_column: str,
    seed: int,
    positions: Callable[[Column], Sequence[Column]],
    output: str,
    cut_rows: int = CUT_ROWS,
) -> DataFrame:
    """Add ``output``: how many of the class's cut positions lie before the row.

    ``positions(size)`` gives ascending one-based ranks as expressions of a class's size; a
    row at or below the first one gets 0.  Rows without a class are left out.
    """
    cls = _class_key(class_column) if class_column else F.lit("all")
    keyed = df.select(cls.alias("class"), hash_key(id_column, seed).alias("key")).where(
        "class is not null"
    )
    sizes = keyed.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    ranks = stage(sizes.select("class", F.posexplode(F.array(
        *[p.cast("bigint") for p in positions(F.col("n"))])).alias("place", "rank")), "ranks")
    keys = _cut_keys(keyed, ranks.where("rank > 0").select("class", "rank").distinct(), cut_rows)
    joined = ranks if keys is None else ranks.join(keys, ["class", "rank"], "left")
    key = F.lit("") if keys is None else F.coalesce("key", F.lit(""))
    table = stage(joined.groupBy(F.col("class").alias("__class")).agg(F.sort_array(F.collect_list(
        F.struct("place", key.alias("key")))).alias("__cuts")), "cuts")
    out = df.withColumns({"__k": hash_key(id_column, seed), "__class": cls}).join(small(table), "__class")
    before = F.size(F.filter("__cuts", lambda cut: cut["key"] < F.col("__k")))
    return out.withColumn(output, before.cast("int")).drop("__class", "__k", "__cuts")


def half_even(x: Column) -> Column:
    return F.bround(x, 0).cast("bigint")


def create_stratified_sample(
    df: DataFrame, target: str, sample_size: int, id_column: str, seed: int = 42,
    cut_rows: int = CUT_ROWS,
) -> DataFrame:
    """``round-half-even(fraction * n)`` rows of every class, without replacement."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    rows = df.count()
    if sample_size > rows:
        raise ValueError(f"sample size {sample_size} exceeds {rows} rows")
    fraction = sample_size / rows
    return cut_by_rank(
        df, target, id_column, seed, lambda n: [half_even(F.lit(fraction) * n)], "__part", cut_rows
    ).where("__part = 0").drop("__part")


def stratified_split(
    df: DataFrame, target: str, id_column: str, test_share: float = 0.2,
    validation_share: float = 0.25, seed: int = 42, output: str = "split",
    cut_rows: int = CUT_ROWS,
) -> DataFrame:
    """Add ``train`` / ``validation`` / ``test`` with exact shares within each class.

    ``validation_share`` is taken from what the test share leaves (60/20/20 by default).
    """

    def positions(n: Column) -> list[Column]:
        test = half_even(F.lit(test_share) * n)
        return [test, test + half_even(F.lit(validation_share) * (n - test))]

    part = F.col("__part")
    return cut_by_rank(df, target, id_column, seed, positions, "__part", cut_rows).withColumn(
        output, F.when(part == 0, "test").when(part == 1, "validation").otherwise("train")
    ).drop("__part")


def hash_folds(df: DataFrame, id_column: str, folds: int, seed: int = 42, output="fold"):
    """Add a fold number from the row's hash: no shuffle, near-equal sizes."""
    return df.withColumn(
        output, F.floor(hash_unit(id_column, seed, "fold:") * folds).cast("int"))
