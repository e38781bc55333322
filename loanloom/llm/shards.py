"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by (hash of the text, id, row number), so equal texts are neighbours.  The
keys of wanted shard boundaries are searched for: each round counts the exact bytes and rows
below a few probes between the bounds known so far, in every partition at once, and only
these counts reach the driver.  A boundary is settled when the bytes below it are within the
tolerance or its bounds enclose a single row.  Then rows are dealt once, by the settled keys.
"""

from __future__ import annotations

import binascii
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanloom.llm.text import steps, table
from loanloom.session import stage

#: Bytes of a key, most significant first.
KEY = 24


def row_keys(docs: DataFrame) -> tuple[DataFrame, int]:
    """``doc_id``, ``size`` (UTF-8 bytes plus 8), ``text_crc32`` and the sort ``key`` of each row,
    and the number of bits that keys use: 64 of the text's hash, those of the span of ids, and
    those of a row number if some rows share an id."""
    n, some, distinct, least, most = docs.agg(
        F.count("*"), F.count("doc_id"), F.count_distinct("doc_id"),
        F.min(F.col("doc_id").cast("long")), F.max(F.col("doc_id").cast("long"))).first()
    least = least or 0
    id_bits = ((most or 0) - least + 1).bit_length()
    row_bits = 0 if n == some == distinct else 63

    def run(batches):
        for batch in batches:
            at = 0
            ids = batch.column("doc_id").to_pylist()
            numbers = batch.column("row").to_numpy()
            for part, some in steps(batch):
                keys, sums = [], []
                for i in range(part.num_rows):
                    text, number = some.bytes_of(i), ids[at + i]
                    place = 0 if number is None else number - least + 1
                    key = (xxhash.xxh64_intdigest(text) << id_bits) + place << row_bits
                    if row_bits:
                        key += int(numbers[at + i])
                    keys.append(key.to_bytes(KEY, "big"))
                    sums.append(binascii.crc32(text))
                at += part.num_rows
                yield table(doc_id=part.column("doc_id"), size=np.diff(some.offsets) + 8,
                            text_crc32=pa.array(sums, pa.int64()), key=pa.array(keys, pa.binary()))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(run, "doc_id long, size long, text_crc32 long, key binary"), \
        64 + id_bits + row_bits


def _counts(keys: DataFrame, probes: list[int]) -> list[tuple[int, int]]:
    """Exact bytes and rows below each of the sorted ``probes``."""
    edges = np.array([p.to_bytes(KEY, "big") for p in probes], dtype=f"S{KEY}")

    def run(batches):
        total = np.zeros((2, len(edges) + 1), dtype=np.int64)
        for batch in batches:
            # fixed-width strings: comparing them compares the numbers
            own = np.array(batch.column("key").to_pylist(), dtype=f"S{KEY}")
            slot = np.searchsorted(edges, own, "right")
            np.add.at(total[0], slot, batch.column("size").to_numpy())
            np.add.at(total[1], slot, 1)
        used = np.flatnonzero(total[1])
        yield table(slot=used, bytes=total[0][used], rows=total[1][used])

    below = np.zeros((2, len(edges) + 1), dtype=np.int64)
    for r in keys.select("key", "size").mapInArrow(run, "slot long, bytes long, rows long").groupBy(
            "slot").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).collect():
        below[:, r["slot"]] = r["bytes"], r["rows"]
    below = below.cumsum(axis=1)
    return list(zip(below[0, :-1].tolist(), below[1, :-1].tolist()))


def splitters(keys: DataFrame, parts: int, bits: int, tolerance: float = 0.0005,
              probes: int = 12) -> list[tuple[int, int, int]]:
    """For each boundary between ``parts`` shares of nearly equal bytes: key, bytes and rows below it.

    The result is as long as ``parts`` says, whatever the table's size; an empty table has none.
    """
    total, rows = keys.agg(F.sum("size"), F.count("*")).first()
    if not rows:
        return []
    # (key, bytes below, rows below) on both sides of each boundary
    low = [(0, 0, 0)] * (parts - 1)
    high = [(1 << bits, total, rows)] * (parts - 1)
    goal = [total * (i + 1) / parts for i in range(parts - 1)]
    found: list = [None] * (parts - 1)
    while None in found:
        asked: set[int] = set()
        for i in range(parts - 1):
            if found[i] is None:
                a, b = low[i][0], high[i][0]
                asked.update(a + (b - a) * j // (probes + 1) for j in range(1, probes + 1))
        points = sorted(asked)
        known = list(zip(points, *zip(*_counts(keys, points))))
        at = [k[1] for k in known]
        for i in range(parts - 1):
            if found[i] is not None:
                continue
            # the last count up to the goal and the first one beyond it
            j = bisect_right(at, goal[i])
            if j > 0:
                low[i] = max(low[i], known[j - 1])
            if j < len(known):
                high[i] = min(high[i], known[j])
            near = min(low[i], high[i], key=lambda k: abs(k[1] - goal[i]))
            if abs(near[1] - goal[i]) <= tolerance * total / parts or high[i][2] - low[i][2] <= 1 \
                    or high[i][0] - low[i][0] <= 1:
                found[i] = near
    return found


def shard(docs: DataFrame, shards: int = 24, range_rows: int = 2_000_000) -> DataFrame:
    """Every row with ``shard``, ``slot`` and what placed it: ``size``, ``text_crc32``, ``doc_id``.

    Shards follow the key order and differ in bytes by no more than the tolerance and one row.
    ``slot`` counts the rows of a shard in key order from 0.  Each shard is numbered in key
    ranges of about ``range_rows`` rows, four at least, whose row counts are known from the
    search, so no task holds a whole shard.  Null text
    has no bytes; null ids come first among equal texts; repeated rows are told apart by a
    row number.  An empty table gives an empty result.  Further columns are not carried.
    """
    keys, bits = row_keys(docs)
    keys = stage(keys, "shard-keys")
    ranges = max(4, -(-keys.count() // (shards * range_rows)))
    cuts = splitters(keys, shards * ranges, bits)
    edges = [k.to_bytes(KEY, "big") for k, _, _ in cuts]
    before = [0] + [r for _, _, r in cuts]
    # rows of the same shard in the ranges before this one
    offsets = [before[i] - before[i - i % ranges] for i in range(len(before))]

    def run(batches):
        sorted_edges = np.array(edges, dtype=f"S{KEY}")
        for batch in batches:
            own = np.array(batch.column("key").to_pylist(), dtype=f"S{KEY}")
            slot = np.searchsorted(sorted_edges, own, "right")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(slot), pa.array(starts[slot])],
                names=["doc_id", "size", "text_crc32", "key", "range", "before"])

    starts = np.array(offsets, dtype=np.int64)
    placed = keys.mapInArrow(
        run, "doc_id long, size long, text_crc32 long, key binary, range long, before long")
    order = Window.partitionBy("range").orderBy("key")
    return placed.withColumn("n", F.row_number().over(order)).select(
        "doc_id", "size", "text_crc32", F.floor(F.col("range") / ranges).cast("int").alias("shard"),
        (F.col("before") + F.col("n") - 1).alias("slot"))
