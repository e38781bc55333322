"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 64-bit numbers make all coordinates of a signature: the first
scatters the shingles, the second is applied to the scattered numbers shifted by 0, 1, 2, ...
places around the circle, and each shift's minimum is one coordinate.  Four coordinates make a
band; texts that agree in a band meet in its bucket.

Texts with one set of shingles are one class and only its first text goes on.  In a bucket
every class is compared with the bucket's first one, so a group of copies costs as many
comparisons as it has members; in large buckets some turns with other classes for the first one
follow.  Classes of one bucket that are still in different components
after that are compared too, unless counts of their shingles rule it out, so no link is
lost.  A band says nothing final: a pair counts only if the full sets of shingles agree.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.text import (
    BLANK_WORD, Rolling, Texts, keyed, matching, mix, ragged, signed, steps, strings, table,
)
from loanloom.session import stage

BANDS, ROWS = 24, 4
COORDINATES = BANDS * ROWS


def shingles(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, end to end, and their offsets.

    Words are lower-cased (A-Z); a text of fewer than ``size`` words is one shingle.
    """
    words = texts.lowered().words(BLANK_WORD)
    n = words.counts()
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    start = ragged(words.offsets[:-1], counts)
    text = np.repeat(np.arange(len(n)), counts)
    stop = np.minimum(start + size, words.offsets[text + 1])
    hashes = Rolling(words.hashes()).ranges(start, stop)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.searchsorted(text[new], np.arange(len(n) + 1))


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of coordinates for each set that isn't empty."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(starts), COORDINATES), dtype=np.uint64)
    scattered = mix(hashes, 3)
    for shift in range(COORDINATES):
        out[:, shift] = np.minimum.reduceat(mix(scattered - np.uint64(shift), 4), starts)
    return out


#: Parts of all shingles; a set is odd or even in each of them.
PARTS = 1024
#: Classes of a bucket that are all compared at once; turns with pivots that larger ones have before.
LARGE, TURNS = 32, 4

SETS = ("id long, tk long, doc_id long, n long, f1 long, f2 long, bands array<long>, s1 long, s2 long, "
        "odd array<long>")


def sets(texts: DataFrame, size: int) -> DataFrame:
    """Per text: size and fingerprint of its set, its bands, one bit of each coordinate, and
    whether it has an odd number of shingles in each of ``PARTS`` parts."""
    def run(batches):
        for batch in batches:
            for part, some in steps(batch, limit=1 << 19):
                hashes, offsets = shingles(some, size)
                n = np.diff(offsets)
                full = n > 0
                rows = signatures(hashes, offsets) if len(hashes) else np.zeros((0, COORDINATES), np.uint64)
                bands = np.zeros((len(n), BANDS), dtype=np.uint64)
                bits = np.zeros((len(n), 128), dtype=np.uint8)
                for b in range(BANDS):
                    key = np.full(len(rows), b, dtype=np.uint64)
                    for r in range(ROWS):
                        key = mix(key ^ rows[:, b * ROWS + r], r)
                    bands[full, b] = key
                bits[full, :COORDINATES] = (rows & np.uint64(1)).astype(np.uint8)
                packed = np.packbits(bits, axis=1).view(np.int64)
                part_of = (mix(hashes, 7) >> np.uint64(54)).astype(np.int64)
                part_of += np.repeat(np.arange(len(n)), n) * PARTS
                odd = np.bincount(part_of, minlength=len(n) * PARTS) & 1
                odd = np.packbits(odd.astype(np.uint8)).view(np.int64)
                prints = []
                for turn in (5, 6):
                    sums = np.append(np.uint64(0), np.cumsum(mix(hashes, turn)))
                    prints.append(signed(sums[offsets[1:]] - sums[offsets[:-1]]))
                yield table(
                    id=part.column("id"), tk=part.column("tk"), doc_id=part.column("doc_id"), n=n,
                    f1=prints[0], f2=prints[1],
                    bands=pa.ListArray.from_arrays(
                        np.arange(len(n) + 1, dtype=np.int32) * BANDS, signed(bands.ravel())),
                    s1=np.ascontiguousarray(packed[:, 0]), s2=np.ascontiguousarray(packed[:, 1]),
                    odd=pa.ListArray.from_arrays(
                        np.arange(len(n) + 1, dtype=np.int32) * (PARTS // 64), pa.array(odd)))

    return texts.select("id", "tk", "doc_id", "text").mapInArrow(run, SETS)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for nodes of ``edges`` (``a``, ``b``).

    Large and small stars in turn: every node hands its larger, then its smaller neighbours to
    the smallest one it knows.  Minima are aggregates and joins, so no node's neighbours are
    gathered anywhere; each round is written.
    """
    current = stage(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                    .filter("hi <> lo").distinct(), "stars")
    state = None
    while True:
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            current.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        current = stage(small.unionByName(low.select("hi", F.col("m").alias("lo"))).distinct(), "stars")
        now = tuple(current.agg(
            F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if now == state:
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        state = now


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those ``pairs`` (``a``, ``b``) whose whole sets of shingles reach the similarity."""

    def run(batches):
        for batch in batches:
            # the two texts of a pair are about equally long
            for part, some in steps(batch, "text_a", 1 << 19):
                left, right = shingles(some, size), shingles(strings(part.column("text_b")), size)
                n, m = np.diff(left[1]), np.diff(right[1])
                rows = np.arange(part.num_rows)
                keys = np.concatenate([left[0], right[0]])
                pair = np.concatenate([np.repeat(rows, n), np.repeat(rows, m)])
                order = np.lexsort((keys, pair))
                keys, pair = keys[order], pair[order]
                same = (keys[1:] == keys[:-1]) & (pair[1:] == pair[:-1])
                both = np.bincount(pair[1:][same], minlength=part.num_rows)
                good = np.flatnonzero(100 * both >= percent * (n + m - both))
                yield part.select(["a", "b"]).take(good)

    side = lambda c: texts.select(F.col("num").alias(c), F.col("text").alias(f"text_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(
        run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Every row's ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``, and its key (``text.keyed``).

    Texts are linked if ``100 * intersection >= percent * union`` of their sets of ``size``-word
    shingles; ``component_id`` is the smallest ``doc_id`` reachable, and one row of a component
    is kept, the one with that id.  Texts without words are linked with nothing and kept.
    Repeated rows are duplicates of each other; of rows with one id the text's hash decides.
    Missing ids come last; a component of such rows has no id.  Further columns are not carried.

    A pair just at the threshold shares none of the 24 bands with a chance below 4 in a
    million at 80 percent, and less above.
    """
    texts, unique = keyed(docs)
    rows = sets(texts, size)
    if unique:
        rows = stage(rows.withColumn("num", F.col("id")), "sets")
    else:
        # numbers in the order of ids: sorted ranges are numbered one after the other
        rows = stage(stage(rows, "sets").orderBy(F.col("doc_id").asc_nulls_last(), "tk").withColumn(
            "num", F.monotonically_increasing_id()), "numbered")
    first = F.min(F.struct("num", "id", "tk")).alias("first")
    classes = stage(rows.filter("n > 0").groupBy("f1", "f2").agg(
        first, F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("s1").alias("s1"),
        F.first("s2").alias("s2"), F.first("odd").alias("odd")).select(
        "first.*", "f1", "f2", "n", "bands", "s1", "s2", "odd"), "classes")
    linked = _links(texts, classes, size, percent)
    roots = classes.select("f1", "f2", "num").join(
        linked.withColumnRenamed("node", "num"), "num", "left").select(
        "f1", "f2", F.coalesce("root", "num").alias("root"))
    own = ["id", "tk", "doc_id", "n", "num"]
    out = rows.filter("n > 0").select(*own, "f1", "f2").join(roots, ["f1", "f2"]).select(
        *own, "root").unionByName(rows.filter("n = 0").select(*own, F.col("num").alias("root")))
    if unique:
        out = out.withColumn("component_id", F.col("root"))
    else:
        heads = rows.select(F.col("num").alias("root"), F.col("doc_id").alias("component_id"))
        out = out.join(heads, "root")
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      (F.col("num") == F.col("root")).alias("kept"), "id", "tk")


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` of each group of near-duplicates, with all its columns."""
    kept = near_duplicates(docs, size, percent).filter("kept").select("id", "tk")
    return matching(docs, kept, "left_semi", once=True)


def _links(texts: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """``node`` and ``root`` of classes that are linked with others."""
    members = classes.select(F.explode("bands").alias("bucket"), "num", "n", "s1", "s2")
    info = F.struct("num", "n", "s1", "s2")
    buckets = members.groupBy("bucket").agg(F.min(info).alias("c"), F.count("*").alias("m")).filter("m > 1")
    members = stage(members.join(buckets, "bucket"), "members")
    miss = (1 - percent / 100) / 2
    most = math.ceil(COORDINATES * miss + 6 * math.sqrt(COORDINATES * miss * (1 - miss)))

    def plausible(x, y):
        """Sizes that allow the similarity, and bits no further apart than six deviations."""
        bits = F.bit_count(F.col(f"{x}.s1").bitwiseXOR(F.col(f"{y}.s1"))) + F.bit_count(
            F.col(f"{x}.s2").bitwiseXOR(F.col(f"{y}.s2")))
        return (100 * F.least(f"{x}.n", f"{y}.n") >= percent * F.greatest(f"{x}.n", f"{y}.n")) & (bits <= most)

    pairs = stage(members.select(F.col("c"), info.alias("x")).filter(F.col("c.num") < F.col("x.num")).filter(
        plausible("c", "x")).select(F.col("c.num").alias("a"), F.col("x.num").alias("b")).distinct(), "pairs")
    # texts that any comparison can need
    needed = members.select("num").distinct().join(classes.select("num", "id", "tk"), "num")
    bodies = stage(texts.select("id", "tk", "text").join(needed, ["id", "tk"]).dropDuplicates(["num"]).select(
        "num", "text"), "bodies")
    good = stage(verified(pairs, bodies, size, percent), "links")
    roots = components(good)
    rows = _open_rows(members, classes, roots)
    tried = pairs
    for turn in range(TURNS):
        met = stage(_pivot_pairs(rows, roots, turn, plausible, percent).join(tried, ["a", "b"], "left_anti"), "pairs")
        links = stage(verified(met, bodies, size, percent), "links")
        if links.isEmpty():
            break
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links))
        tried = tried.unionByName(met)
    rest = stage(_open_pairs(rows, roots, plausible, percent).join(tried, ["a", "b"], "left_anti"), "pairs")
    more = stage(verified(rest, bodies, size, percent), "links")
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` of buckets (``bucket``, ``num``) with the ``root`` of their component."""
    return rows.join(roots.withColumnRenamed("node", "num"), "num", "left").withColumn(
        "root", F.coalesce("root", "num"))


def _mixed(rooted: DataFrame) -> DataFrame:
    """Rows of buckets that more than one component is in."""
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter(
        "r0 < r1").select("bucket")
    return rooted.join(mixed, "bucket")


def _open_rows(members: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """``bucket``, its number of classes ``m``, and ``num`` and ``x`` of those whose bucket is mixed."""
    labelled = stage(_rooted(members.select("bucket", "m", "num", "n", "s1", "s2"), roots), "labelled")
    return stage(_mixed(labelled).join(classes.select("num", "odd"), "num").select(
        "bucket", "m", "num", F.struct("num", "n", "s1", "s2", "odd").alias("x")), "open")


def _possible(x: str, y: str, percent: int):
    """Sets that can still be linked: two of them differ in at least as many shingles as there are
    parts in which one is odd and the other even; where that is too many, the pair falls
    without being looked at."""
    apart = sum((F.bit_count(F.col(f"{x}.odd")[i].bitwiseXOR(F.col(f"{y}.odd")[i])) for i in range(1, PARTS // 64)),
                F.bit_count(F.col(f"{x}.odd")[0].bitwiseXOR(F.col(f"{y}.odd")[0])))
    return (100 + percent) * apart <= (100 - percent) * (F.col(f"{x}.n") + F.col(f"{y}.n"))


def _pair():
    return F.least("x.num", "y.num").alias("a"), F.greatest("x.num", "y.num").alias("b")


def _pivot_pairs(rows: DataFrame, roots: DataFrame, turn: int, plausible, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) of every class in a large mixed bucket with one that its hash picks,
    if that is in another component.

    Copies with edits of their own may be linked with most others but not with the bucket's first
    one.  Every turn has other pivots, and a class lies in many buckets, so it meets
    members enough to join its group, with as many comparisons as a bucket has classes.
    """
    large = _mixed(_rooted(rows.filter(F.col("m") > LARGE), roots))
    picked = large.groupBy("bucket").agg(F.min_by("num", F.xxhash64("bucket", "num", F.lit(turn))).alias("num"))
    pivots = large.join(picked, ["bucket", "num"]).select("bucket", F.col("root").alias("other"), F.col("x").alias("y"))
    return large.join(pivots, "bucket").filter(
        (F.col("root") != F.col("other")) & plausible("x", "y") & _possible("x", "y", percent)).select(*_pair()).distinct()


def _open_pairs(rows: DataFrame, roots: DataFrame, plausible, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) of one bucket and two components that can still be linked.

    Classes of a bucket's most frequent component are not compared with each other, only the
    others with them and among themselves.
    """
    left = stage(_mixed(_rooted(rows.select("bucket", "num", "x"), roots)).select("bucket", "root", "x"), "mixed")
    most_of = left.groupBy("bucket", "root").agg(F.count("*").alias("k")).groupBy("bucket").agg(
        F.max_by("root", "k").alias("main"))
    others = left.join(most_of, "bucket").filter("root <> main")
    pairs = others.join(left.select("bucket", F.col("root").alias("other"), F.col("x").alias("y")), "bucket")
    new = (F.col("other") == F.col("main")) | (F.col("root") < F.col("other"))
    return pairs.filter(new & plausible("x", "y") & _possible("x", "y", percent)).select(*_pair()).distinct()
