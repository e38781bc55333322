"""Repeated rows of wide tables, found by fingerprints first.

A row travels as a fingerprint of 16 bytes.  Only fingerprints that occur again bring whole
rows into an exchange, and whole rows alone decide which are equal.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StringType, StructType, VariantType

#: Longs of the bit field of repeated fingerprints: 8 MB, whatever the size of the table.  It
#: keeps out nearly all other rows as long as a few million fingerprints repeat.
FIELD_WORDS = 1 << 20


def _any(kind: DataType, test: Callable[[DataType], bool]) -> bool:
    if isinstance(kind, ArrayType):
        return _any(kind.elementType, test)
    if isinstance(kind, StructType):
        return any(_any(f.dataType, test) for f in kind.fields)
    return test(kind)


def _fraction(kind: DataType) -> bool:
    return isinstance(kind, (DoubleType, FloatType))


def _unhashed(kind: DataType) -> bool:
    return isinstance(kind, (MapType, VariantType)) or (
        isinstance(kind, StringType) and kind.collation != "UTF8_BINARY")


def hashable(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns in a form in which values that are grouped together hash alike.

    Grouping takes 0.0 and -0.0 for one value and all NaN for one value, so fractions are brought
    to one form.  Maps and texts with an order of their own stay out of the hash; the comparison
    of whole rows decides on them.
    """
    out = []
    for name in columns:
        kind, c = df.schema[name].dataType, F.col(f"`{name}`")
        if _any(kind, _unhashed):
            continue
        if _fraction(kind):
            c = F.when(F.isnan(c), F.lit(float("nan")).cast(kind)).when(
                c == 0, F.lit(0.0).cast(kind)).otherwise(c)
        elif _any(kind, _fraction):
            # as text all NaN are one, and only the sign of zero is left to be dropped
            c = F.regexp_replace(F.to_json(F.struct(c)), r"-0\.0(?![0-9E])", "0.0")
        out.append(c)
    return out


def fingerprint(values: Sequence[Column]) -> list[Column]:
    """Two 64-bit hashes of the values; which of them are null is part of what is hashed.

    A hash alone passes over nulls, so that (null, 1) and (1, null) would meet.
    """
    marks = F.concat(*[F.when(v.isNull(), "0").otherwise("1") for v in values])
    return [F.xxhash64(marks, *values), F.xxhash64(*reversed(values), marks, F.lit(1))]


def repeated_rows(
    df: DataFrame, columns: Sequence[str] | None = None,
    hashes: Callable[[Sequence[Column]], Sequence[Column]] = fingerprint, field_words: int = FIELD_WORDS,
) -> DataFrame:
    """The distinct rows that occur twice or more, with their number ``n_copies``.

    1. Fingerprints are counted; partial counts of 24 bytes are all that is exchanged.
    2. Bits of the repeated ones form a field of at most ``field_words`` longs, which every task
       holds; rows without their bit leave in the scan.  A wrong bit only costs work.
    3. Rows that are left are grouped by all their columns, copies merged before the exchange.
    """
    names = list(columns or df.columns)
    keys = ["__f0", "__f1"]
    marked = df.select(*[F.col(f"`{c}`") for c in names], *[
        h.alias(k) for h, k in zip(hashes(hashable(df, names)), keys, strict=True)])
    again = marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    word = F.pmod("__f0", F.lit(field_words)).alias("__word")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("__f1", F.lit(64)).cast("int"))
    field = again.groupBy(word).agg(F.bit_or(bit).alias("__bits"))
    left = marked.withColumn("__word", word).join(F.broadcast(field), "__word").where(
        F.col("__bits").bitwiseAND(bit) != 0)
    return left.groupBy(*[F.col(f"`{c}`") for c in names]).agg(
        F.count(F.lit(1)).alias("n_copies")).where("n_copies > 1")


def duplicated_total(repeated: DataFrame) -> DataFrame:
    """``n_duplicated``: rows with an equal row, all members counted."""
    return repeated.agg(F.coalesce(F.sum("n_copies"), F.lit(0)).cast("bigint").alias("n_duplicated"))
