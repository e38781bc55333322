"""Arrays over many texts at once: words, hashes, and bounded slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one array step works on; a single longer text is a step of its own.
STEP_BYTES = 3 << 20


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for low, high in ranges:
        out[low:high + 1] = True
    return out


#: Bytes of words separated by blanks: all but 0x20 and 0x09-0x0D.
BLANK_WORD = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words of lower-cased letters, digits and everything beyond ASCII.
ALNUM_WORD = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray, turn: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (multiply and shift, thrice)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (turn + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class Rolling:
    """Hashes of any range of a sequence of 64-bit codes from one prefix sum."""

    BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)

    def __init__(self, codes: np.ndarray, which: int = 0):
        n, base = len(codes), self.BASES[which]
        powers = np.full(n + 1, base, dtype=np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(codes * powers[:n], out=self.sums[1:])
        powers.fill(_inverse(base))
        powers[0] = 1
        self.back = np.multiply.accumulate(powers, out=powers)

    def ranges(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.back[start])

    def grams(self, k: int) -> np.ndarray:
        """Hash of each ``k`` neighbouring codes."""
        if len(self.sums) <= k:
            return np.zeros(0, dtype=np.uint64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.back[:len(self.sums) - k])


class Texts:
    """Some texts laid end to end: ``data`` bytes, ``offsets`` of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self):
        return len(self.offsets) - 1

    def lowered(self) -> Texts:
        return Texts(_LOWER[self.data], self.offsets)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def words(self, inside: np.ndarray) -> Words:
        """Maximal runs of the bytes ``inside``; no run crosses from text to text."""
        member = np.zeros(len(self.data) + 2, dtype=np.int8)
        member[1:-1] = inside[self.data]
        change = np.diff(member)
        starts, stops = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        cuts = self.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(self.data))]
        cuts = np.unique(cuts[member[cuts].astype(bool) & member[cuts + 1].astype(bool)])
        if len(cuts):  # a word at the end of one text touches a word of the next one
            starts = np.sort(np.concatenate([starts, cuts]))
            stops = np.sort(np.concatenate([stops, cuts]))
        return Words(self, starts, stops, np.searchsorted(starts, self.offsets))


class Words:
    """Words of some texts: byte ``starts`` and ``stops``; text ``i`` has ``offsets[i:i+2]``."""

    def __init__(self, texts: Texts, starts, stops, offsets):
        self.texts, self.starts, self.stops, self.offsets = texts, starts, stops, offsets

    def hashes(self) -> np.ndarray:
        rolling = Rolling(mix(np.arange(256, dtype=np.uint64))[self.texts.data])
        return mix(rolling.ranges(self.starts, self.stops)
                   + (self.stops - self.starts).astype(np.uint64))

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def strings(column: pa.Array | pa.ChunkedArray) -> Texts:
    """Texts of an Arrow string column without copies; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[at[0]:at[-1]], at - at[0])


def steps(batch: pa.RecordBatch, column: str = "text",
          limit: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of a batch with at most ``limit`` bytes of text, or one text that has more."""
    texts, first, rows = strings(batch.column(column)), 0, batch.num_rows
    while first < rows:
        last = int(np.searchsorted(texts.offsets, texts.offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        at = texts.offsets[first:last + 1]
        yield batch.slice(first, last - first), Texts(texts.data[at[0]:at[-1]], at - at[0])
        first = last


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i]+1, ...`` with ``counts[i]`` numbers for each ``i``."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def covered(size: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in one of the ranges."""
    edges = np.zeros(size + 1, dtype=np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, stops, -1)
    return np.cumsum(edges[:-1]) > 0


def binaries(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value for each ``counts[i]`` neighbouring numbers of ``flat``."""
    at = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts * flat.itemsize, out=at[1:])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(counts),
        [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(flat))]).cast(pa.binary())


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def table(**columns) -> pa.RecordBatch:
    """A record batch; numpy arrays and lists become Arrow arrays."""
    arrays = [v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def keyed(docs: DataFrame, *more: Column) -> tuple[DataFrame, bool]:
    """``id`` and ``tk``, never null and together unique up to repeated rows, then ``doc_id``,
    ``text`` and ``more`` columns.

    ``id`` is ``doc_id``; where that is missing or shared by several rows (found by one
    count over the ids), ``tk`` is a hash of the text that tells them apart, else 0.
    Null sorts first.  Rows that share number and text are one document.  Also says whether
    every row has a number of its own, so that no row can be repeated.
    """
    n, some, distinct = docs.agg(
        F.count("*"), F.count("doc_id"), F.count_distinct("doc_id")).first()
    plain = n == some == distinct
    number = F.col("doc_id").cast("long")
    return docs.select(
        F.coalesce(number, F.lit(-(1 << 63))).alias("id"),
        (F.lit(0).cast("long") if plain else F.xxhash64("text", number.isNull())).alias("tk"),
        number.alias("doc_id"), F.col("text").cast("string").alias("text"), *more), plain


def matching(docs: DataFrame, keys: DataFrame, how: str, once: bool = False) -> DataFrame:
    """Rows of ``docs`` with all their columns whose key is (``left_semi``) or isn't (``left_anti``)
    among ``keys`` (``id``, ``tk``); with ``once`` one row a key."""
    rows, unique = keyed(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    found = rows.select("id", "tk", "whole").join(keys, ["id", "tk"], how)
    if once and not unique:
        found = found.dropDuplicates(["id", "tk"])
    return found.select("whole.*")
