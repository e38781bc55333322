"""Windows of L units (words or bytes) that occur more than once, found through few of them.

Every window is filed under one of its own k-grams, the one with the smallest hash, so equal
windows always meet under the same k-gram.  Neighbouring windows mostly share it: such a run
of windows, its *segment*, is one row with a hash of the whole stretch of text it covers.
Equal segments settle all their windows at once.  Where one k-gram leads to different
segments, at the ends of copied passages, each segment is cut into chunks of a few windows,
filed under the text that all windows of a chunk share; what is still open after that is
compared window by window.  One row for about every (L - k) / 2 units is exchanged; texts are
exchanged once and that exchange is reused.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanloom.llm.text import BLANK_WORD, Rolling, keyed, mix, ragged, signed, steps, table
from loanloom.session import stage

#: Position bits beside the order of k-grams in one number.
_LOW = np.uint64(0xFFFFFFFF)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of each ``w`` neighbours: running minima of blocks from both ends."""
    n = len(x) - w + 1
    blocks = np.full(-(-len(x) // w) * w, ~np.uint64(0))
    blocks[:len(x)] = x
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


class Segments:
    """Segments of some texts: text number, start of the first window, number of windows, place
    of the k-gram after the start, and two hashes, of the k-gram and of all the windows cover."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray, length: int, k: int):
        n = len(codes)
        if n < length:
            self.text = self.start = self.count = self.off = np.zeros(0, np.int64)
            self.gram = self.whole = np.zeros(0, np.uint64)
            return
        grams = Rolling(codes).grams(k)
        order = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_sliding_min(order, length - k + 1) & _LOW).astype(np.int64)
        begins, ends = offsets[:-1], offsets[1:] - length + 1  # windows that stay in their text
        fits = ends > begins
        edges = np.zeros(n + 1, dtype=np.int8)
        edges[begins[fits]] += 1
        edges[ends[fits]] -= 1
        valid = np.cumsum(edges[:len(anchor)], dtype=np.int8) > 0
        new = valid.copy()
        new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
        new[begins[fits]] = True
        first = np.flatnonzero(new)
        stops = np.flatnonzero(valid)
        stop = stops[np.searchsorted(stops, first[1:]) - 1] + 1 if len(first) > 1 else []
        stop = np.append(stop, stops[-1] + 1 if len(stops) else []).astype(np.int64)
        self.count = stop - first
        self.text = np.searchsorted(offsets, first, "right") - 1
        self.start = first - offsets[self.text]
        self.gram = grams[anchor[first]]
        self.off = anchor[first] - first
        self.whole = _whole(Rolling(codes, 1), first, self.count, self.off, length)


def _whole(rolling: Rolling, start, count, off, length: int) -> np.ndarray:
    """Hash of all that ``count`` windows cover, and of where they lie."""
    shape = mix(((off << 20) + count).astype(np.uint64))
    return mix(rolling.ranges(start, start + count - 1 + length) ^ shape, 1)


def byte_units(texts):
    return _BYTE_CODES[texts.data], texts.offsets


_BYTE_CODES = mix(np.arange(256, dtype=np.uint64), 2)


def word_units(texts):
    words = texts.words(BLANK_WORD)
    return words.hashes(), words.offsets


#: Bits of a place: start of the first window, then the k-gram's place after it, number of windows.
_OFF, _COUNT = 14, 12


def _place(start, off, count):
    return (((start << _OFF) + off) << _COUNT) + count


def _unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> (_OFF + _COUNT), (place >> _COUNT) & ((1 << _OFF) - 1), place & ((1 << _COUNT) - 1)


ROW = "pk long, whole long, id long, tk long, place long, n int"


def _rows(pk, whole, own, tie, place):
    """Rows of one slice, in the order of the text.  Rows with one ``pk`` and ``whole`` are
    merged: ``n`` is their number in the first one by document and place and 0 in the others,
    which get a key of their own.  So a passage that a third of all documents share sends one
    row a slice to its key."""
    order = np.lexsort((place, tie, own, whole, pk))
    new = np.ones(len(order), dtype=bool)
    a, b = pk[order], whole[order]
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    n = np.zeros(len(order), dtype=np.int32)
    n[order[new]] = np.diff(np.append(np.flatnonzero(new), len(order)))
    pk = np.where(n > 0, pk, mix(place.view(np.uint64) + mix(own.view(np.uint64))))
    return table(pk=signed(pk), whole=signed(whole), id=own, tk=tie, place=place, n=n)


def _ids(batch, at: int, text: np.ndarray):
    return (batch.column(c).to_numpy(zero_copy_only=False)[at + text] for c in ("id", "tk"))


def segments(texts: DataFrame, units, length: int, k: int) -> DataFrame:
    """One row a segment of every text."""

    def run(batches):
        for batch in batches:
            at = 0
            for part, some in steps(batch):
                s = Segments(*units(some), length, k)
                yield _rows(s.gram, s.whole, *_ids(batch, at, s.text), _place(s.start, s.off, s.count))
                at += part.num_rows

    return texts.select("id", "tk", "text").mapInArrow(run, ROW)


def _parts(texts: DataFrame, marks: DataFrame, unique: bool, units, length: int, chunk: int) -> DataFrame:
    """Rows of chunks of ``chunk`` windows, or single windows, of all places marked to look at."""

    def run(batches):
        for batch in batches:
            at, marked = 0, batch.column("marks")
            for part, some in steps(batch):
                codes, offsets = units(some)
                own = marked.slice(at, part.num_rows)
                text = np.repeat(np.arange(part.num_rows), np.array(own.value_lengths()))
                mark = own.flatten().to_numpy()
                text, mark = text[mark & 2 > 0], mark[mark & 2 > 0]
                start, off, count = _unpack(mark >> 2)
                start = start + offsets[text]
                first, second = Rolling(codes, 0), Rolling(codes, 1)
                if chunk == 1:
                    text = np.repeat(text, count)
                    low = ragged(start, count)
                    size = np.ones(len(low), dtype=np.int64)
                    pk = mix(first.ranges(low, low + length), 8)
                    whole = second.ranges(low, low + length)
                else:
                    # a grid from the k-gram on, so that equal windows lie in equal chunks
                    anchor = start + off
                    g = (start - anchor) // chunk
                    many = (start + count - 1 - anchor) // chunk - g + 1
                    g, anchor, text = ragged(g, many), np.repeat(anchor, many), np.repeat(text, many)
                    base = anchor + chunk * g
                    low = np.maximum(np.repeat(start, many), base)
                    size = np.minimum(np.repeat(start + count, many), base + chunk) - low
                    # what every window of the chunk contains, whether it is in the segment or not
                    pk = mix(first.ranges(base + chunk - 1, base + length), 9)
                    whole = _whole(second, low, size, low - base, length)
                yield _rows(pk, whole, *_ids(batch, at, text), _place(low - offsets[text], 0 * low, size))
                at += part.num_rows

    both = texts.join(marks.filter(F.exists("marks", lambda m: m.bitwiseAND(F.lit(2)) > 0)), ["id", "tk"])
    if not unique:
        both = both.dropDuplicates(["id", "tk"])
    return both.select("id", "tk", "text", "marks").mapInArrow(run, ROW)


def _settled(rows: DataFrame, earlier: bool) -> DataFrame:
    """Per document ``marks``: places times four, plus 1 if all windows there repeat, plus 2 if
    one must look at parts of the place.

    With ``earlier`` a window repeats if an equal one has a smaller (id, tk, start); without,
    if an equal one starts anywhere else.  Of equal places only the first one is looked at.
    """
    rows = rows.repartition("pk").withColumn("local", F.col("n") == 0)
    same = Window.partitionBy("pk", "local", "whole")
    rows = rows.withColumn("lead", ~F.col("local") & (F.row_number().over(
        same.orderBy("id", "tk", "place")) == 1))
    rows = rows.withColumn("wholes", F.sum(F.col("lead").cast("int")).over(Window.partitionBy("pk", "local")))
    done = ~F.col("lead") if earlier else F.col("local") | (F.sum("n").over(same) > 1)
    rows = rows.withColumn("done", done).withColumn("look", F.col("lead") & (F.col("wholes") > 1))
    mark = F.col("place") * 4 + F.col("done").cast("int") + 2 * F.col("look").cast("int")
    return rows.filter("done OR look").groupBy("id", "tk").agg(F.collect_list(mark).alias("marks"))


def merged(marks, length: int) -> list[tuple[int, int]]:
    """Unit ranges that the windows of places with the first mark cover, in order."""
    marks = np.array(marks or (), dtype=np.int64)
    start, _, count = _unpack(marks[marks & 1 > 0] >> 2)
    if not len(start):
        return []
    stop = start + count - 1 + length
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > stop[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)
    return list(zip(start[new].tolist(), stop[last].tolist()))


def with_marks(docs: DataFrame, units, length: int, k: int, earlier: bool, chunk: int = 1) -> DataFrame:
    """Every document (``doc_id``, ``text``) with the ``marks`` of its repeated windows.

    Segments come straight from the scan.  Texts are dealt once, by their key: looking at
    parts and the last join share that exchange.
    """
    if length - k + 1 >= 1 << _COUNT:
        raise ValueError("a window is too much longer than its k-gram")
    texts, unique = keyed(docs)
    once = texts.select("id", "tk", "text")
    if not unique:
        once = once.dropDuplicates(["id", "tk"])
    levels = [stage(_settled(segments(once, units, length, k), earlier), "segments")]
    for size in ([chunk] if chunk > 1 else []) + [1]:
        levels.append(_settled(_parts(texts, levels[-1], unique, units, length, size), earlier))
    none = F.array().cast("array<long>")
    for i, level in enumerate(levels):
        texts = texts.join(level.withColumnRenamed("marks", f"marks{i}"), ["id", "tk"], "left")
    return texts.select("doc_id", "text", F.concat(
        *[F.coalesce(f"marks{i}", none) for i in range(len(levels))]).alias("marks"))
