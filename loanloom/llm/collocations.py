"""Phrases of two and three words that stand together more often than their parts would.

Stripes: a prefix of one or two words keys an associative counter of the words after it.  Each
task counts its own texts and sends one row for each prefix, the counter packed in two values;
rows of a prefix are merged element by element while they stream by in key order.  From a
merged stripe come the extensions, the prefix's own total (what has no next word, or one that
can't matter, counts under the empty word) and the largest extension, which may subsume the
prefix.

A phrase can't be frequent unless its parts are.  Frequent words, then frequent pairs, are
marked in a bit field of fixed size that every task gets; a wrong bit only lets a rare phrase be
counted, so counts are exact whatever the size.  The counters of the commonest prefixes are dealt
into several slices by next word; how many follows from the counts of the round before, and
fewer than ``COMMON`` prefixes can be so common.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanloom.llm.text import Rolling, Texts, byte_set, mix, steps, strings, table
from loanloom.session import stage

#: Bytes of text counted together in a task.
STEP = 3 << 20
#: Bits of the field of frequent words or pairs, as a power of two: 8 MB.
FIELD = 26
#: A prefix with more than this share of all words has a counter in slices.
COMMON = 8192

_WORD = ~(byte_set((0x20, 0x20), (0x09, 0x0D)) | byte_set(*[(ord(c), ord(c)) for c in ".,;:!?"]))
#: Bytes that end a piece; blanks and tabs only end a word.
_CUT = byte_set((0x0A, 0x0D)) | byte_set(*[(ord(c), ord(c)) for c in ".,;:!?"])

#: Scores are floor(SCALE * a * a / (l * r)).
SCALE = 1_000_000


def _tongue(lang: Column) -> Column:
    return F.coalesce(lang.cast("string"), F.lit("und"))


class Counted:
    """Words of one step of texts: ``code`` of each word among the ``distinct`` ones, ``lang`` of
    each among ``langs``, and whether the next word follows in the same piece (``linked``)."""

    def __init__(self, texts: Texts, lang: np.ndarray, langs: pa.Array):
        low = texts.lowered()
        words = low.words(_WORD)
        n = len(words.starts)
        at = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(words.stops - words.starts, out=at[1:])
        spelled = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), n, [None, pa.py_buffer(at), pa.py_buffer(low.data[_WORD[low.data]])])
        coded = spelled.dictionary_encode()
        self.distinct = coded.dictionary
        self.code = coded.indices.to_numpy().astype(np.int64)
        self.langs = langs
        self.lang = np.repeat(lang, words.counts())
        self.linked = np.zeros(n, dtype=bool)
        if n > 1:
            cuts = np.zeros(len(low.data) + 1, dtype=np.int32)
            np.cumsum(_CUT[low.data], out=cuts[1:])
            text = np.repeat(np.arange(len(low)), words.counts())
            self.linked[:-1] = (cuts[words.starts[1:]] == cuts[words.starts[:-1]]) & (text[1:] == text[:-1])

    def slots(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in the field of every word and of every linked pair that begins with it."""
        own, tongue = hashed(self.distinct)[self.code], hashed(self.langs)[self.lang]
        after = np.append(own[1:], np.zeros(min(len(own), 1), np.uint64))
        return slot(tongue, own), slot(tongue, own, after)


def hashed(values: pa.Array) -> np.ndarray:
    """64-bit hash of every string."""
    texts = strings(values)
    if not len(texts):
        return np.zeros(0, np.uint64)
    rolling = Rolling(mix(np.arange(256, dtype=np.uint64))[texts.data])
    return mix(rolling.ranges(texts.offsets[:-1], texts.offsets[1:]) + np.diff(texts.offsets).astype(np.uint64))


def slot(*parts: np.ndarray) -> np.ndarray:
    """Place in the field of a language with one or two words."""
    out = parts[0]
    for p in parts[1:]:
        out = mix(out * np.uint64(3) + p, 5)
    return (out >> np.uint64(64 - FIELD)).astype(np.int64)


def _counted(batches, langs: str = "lang"):
    for batch in batches:
        for part, some in steps(batch, limit=STEP):
            coded = pc.dictionary_encode(part.column(langs))
            yield Counted(some, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary)


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang``, ``word`` and its number ``n``: the counter of the empty prefix, spread over its words."""

    def run(batches):
        for c in _counted(batches):
            key, n = np.unique(c.lang * max(len(c.distinct), 1) + c.code, return_counts=True)
            yield table(lang=c.langs.take(pa.array(key // max(len(c.distinct), 1))),
                        word=c.distinct.take(pa.array(key % max(len(c.distinct), 1))).cast(pa.string()), n=n)

    return texts.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def field(frequent: DataFrame, *columns: str) -> np.ndarray:
    """Bits at the places of all rows; 2 ** FIELD of them, gathered as at most 2 ** (FIELD - 6) numbers."""

    def run(batches):
        for batch in batches:
            at = slot(*[hashed(batch.column(c)) for c in ("lang", *columns)])
            yield table(at=at >> 6, bit=(np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))

    parts = frequent.select("lang", *columns).mapInArrow(run, "at long, bit long").groupBy("at").agg(
        F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (FIELD - 6), dtype=np.int64)
    out[parts["at"].to_numpy()] = parts["bits"].to_numpy()
    return out


def _marked(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits.view(np.uint64)[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


STRIPE = "lang string, prefix string, slice int, words binary, counts binary"


def _stripes(lang: pa.Array, prefix: pa.Array, run: np.ndarray, part: np.ndarray, word: pa.Array,
             counts: np.ndarray) -> pa.RecordBatch:
    """Rows of STRIPE from entries in order of ``run``; ``lang``, ``prefix`` and ``part`` are of the first of each."""
    first = np.flatnonzero(np.append(True, run[1:] != run[:-1])) if len(run) else np.zeros(0, np.int64)
    at = pa.array(np.append(first, len(run)).astype(np.int64))
    words = pc.binary_join(pa.LargeListArray.from_arrays(at, word.cast(pa.large_binary())), pa.scalar(b" ", pa.large_binary()))
    data = np.ascontiguousarray(counts, dtype="<i8")
    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [
        None, pa.py_buffer(np.append(first, len(run)).astype(np.int64) * 8), pa.py_buffer(data)])
    some = pa.array(first)
    return table(lang=lang.take(some).cast(pa.string()), prefix=prefix.take(some).cast(pa.string()),
                 slice=pa.array(part[first].astype(np.int32)), words=words.cast(pa.binary()), counts=packed.cast(pa.binary()))


def _parts_of(names: list[tuple[str, str, int]], langs: pa.Array, prefix: pa.Array, lang: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of slices of every entry's prefix: 1 but for the common ones."""
    out = np.ones(len(at), dtype=np.int64)
    if not names or not len(at):
        return out
    place = {w: i for i, w in enumerate(dict.fromkeys(w for _, w, _ in names))}
    mine = pc.index_in(prefix.cast(pa.string()), pa.array(list(place))).to_numpy(zero_copy_only=False)
    mine = np.where(np.isnan(mine), -1, mine).astype(np.int64)
    tongues = {v: i for i, v in enumerate(langs.to_pylist())}
    grid = np.ones((len(tongues), len(place) + 1), dtype=np.int64)
    for tongue, w, n in names:
        if tongue in tongues:
            grid[tongues[tongue], place[w]] = n
    return grid[lang, mine[at]]


def stripes(texts: DataFrame, words: np.ndarray, pairs: np.ndarray | None, common: list[tuple[str, str, int]]) -> DataFrame:
    """Merged stripes of prefixes of one word, or of two where the field of ``pairs`` is given.

    Prefixes and next words without a bit in the fields are left out or count under the
    empty word.  ``common`` lists (language, prefix, number of slices).
    """
    context = texts.sparkSession.sparkContext
    fields = context.broadcast((words, pairs))

    def run(batches):
        frequent, paired = fields.value
        for c in _counted(batches):
            one, two = c.slots()
            good = _marked(frequent, one)
            next_good = np.append(good[1:], False) if len(good) else good
            link = c.linked & good & next_good
            size = len(c.distinct)
            if paired is None:
                key, after, start = c.code, np.where(link, np.append(c.code[1:], 0)[:len(link)], -1), good
            else:
                link &= _marked(paired, two)
                onward = link & np.append(link[1:], False)[:len(link)]
                third = np.append(c.code[2:], [0, 0])[:len(link)]
                key, after, start = c.code * size + np.append(c.code[1:], 0)[:len(link)], np.where(onward, third, -1), link
            places = np.flatnonzero(start)
            if not len(places):
                continue
            prefixes, at = np.unique(key[places], return_inverse=True)
            if paired is None:
                spelled = c.distinct.take(pa.array(prefixes))
            else:
                spelled = pc.binary_join_element_wise(c.distinct.take(pa.array(prefixes // size)), c.distinct.take(
                    pa.array(prefixes % size)), pa.scalar(b" ", pa.large_binary()))
            entry, n = np.unique((c.lang[places] * len(prefixes) + at) * (size + 1) + after[places] + 1, return_counts=True)
            owner, after = entry // (size + 1), entry % (size + 1) - 1
            lang, at = owner // len(prefixes), owner % len(prefixes)
            parts = _parts_of(common, c.langs, spelled, lang, at)
            part = np.where(after < 0, 0, hashed(c.distinct)[after] % parts.astype(np.uint64)).astype(np.int64)
            run_of = owner * (int(parts.max()) + 1) + part
            order = np.argsort(run_of, kind="stable")
            named = pa.concat_arrays([c.distinct, pa.array([b""], pa.large_binary())])
            yield _stripes(c.langs.take(pa.array(lang[order])), spelled.take(pa.array(at[order])), run_of[order],
                           part[order], named.take(pa.array(np.where(after < 0, size, after)[order])), n[order])

    return merged(texts.mapInArrow(run, STRIPE))


def _merge(rows: pa.Table) -> pa.RecordBatch:
    """One row for each run of rows with one key, counters added up word by word."""
    rows = rows.combine_chunks()
    keys = [rows.column(c).combine_chunks() for c in ("lang", "prefix", "slice")]
    new = np.ones(len(rows), dtype=bool)
    for k in keys:
        new[1:] &= pc.equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False)
    new[1:] = ~new[1:]
    run = np.cumsum(new) - 1
    words = pc.split_pattern(rows.column("words").combine_chunks().cast(pa.string()), " ")
    many = words.value_lengths().to_numpy()
    coded = words.flatten().dictionary_encode()
    counts = strings(rows.column("counts").combine_chunks()).data.view("<i8")
    size = max(len(coded.dictionary), 1)
    entry, place = np.unique(np.repeat(run, many) * size + coded.indices.to_numpy(), return_inverse=True)
    total = np.zeros(len(entry), dtype=np.int64)
    np.add.at(total, place, counts)
    owner, head = entry // size, np.flatnonzero(new)
    take = pa.array(head[owner])
    return _stripes(keys[0].take(take), keys[1].take(take), owner, keys[2].take(take).to_numpy(),
                    coded.dictionary.take(pa.array(entry % size)), total)


def merged(rows: DataFrame) -> DataFrame:
    """Rows of STRIPE with one row a key; a key's rows stream by and are one row all the time."""

    def run(batches):
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            both = [pa.Table.from_batches([b]) for b in (kept, batch) if b is not None]
            out = _merge(pa.concat_tables(both))
            if out.num_rows > 1:
                yield out.slice(0, out.num_rows - 1)
            kept = out.slice(out.num_rows - 1)
        if kept is not None:
            yield kept

    ordered = rows.repartition("lang", "prefix", "slice").sortWithinPartitions("lang", "prefix", "slice")
    return ordered.mapInArrow(run, STRIPE)


def extensions(stripe: DataFrame, least: int) -> DataFrame:
    """``lang``, ``prefix``, its ``total`` in a slice, and ``found``: next words with at least ``least``."""

    def run(batches):
        for batch in batches:
            words = pc.split_pattern(batch.column("words").cast(pa.string()), " ")
            many = words.value_lengths().to_numpy()
            counts = strings(batch.column("counts")).data.view("<i8")
            row = np.repeat(np.arange(batch.num_rows), many)
            total = np.zeros(batch.num_rows, dtype=np.int64)
            np.add.at(total, row, counts)
            flat = words.flatten()
            good = (counts >= least) & pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
            at = np.zeros(batch.num_rows + 1, dtype=np.int32)
            np.cumsum(np.bincount(row[good], minlength=batch.num_rows), out=at[1:])
            found = pa.StructArray.from_arrays([flat.filter(pa.array(good)), pa.array(counts[good])], names=["word", "n"])
            yield table(lang=batch.column("lang"), prefix=batch.column("prefix"), total=total,
                        found=pa.ListArray.from_arrays(pa.array(at), found))

    return stripe.mapInArrow(run, "lang string, prefix string, total long, found array<struct<word:string,n:long>>")


def _common(frequent: DataFrame, columns: list[str], total: int) -> list[tuple[str, str, int]]:
    """Prefixes with more than one in COMMON of all words, and the number of their slices."""
    rows = frequent.filter(F.col("n") * COMMON > total).select("lang", *columns, "n").collect()
    return [(r["lang"], " ".join(r[c] for c in columns), 1 + r["n"] * COMMON // max(total, 1)) for r in rows]


def _score(a: Column, left: Column, right: Column) -> Column:
    """Exact: products may have up to 38 digits, the quotient never passes SCALE."""
    big = lambda c: c.cast("decimal(19,0)")
    top = (big(a) * big(a)).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", top, (big(left) * big(right)).cast("decimal(38,0)")).cast("long")


def phrases(docs: DataFrame, least: int = 10, share: int = 50) -> DataFrame:
    """All phrases that stand at least ``least`` times and in no longer one too often.

    Returns ``lang``, ``phrase``, ``a`` (its number), ``l`` and ``r`` (numbers of the two parts of
    the lowest-scoring cut, the first one among equals), ``n`` (words of the language) and
    ``score``.  A pair goes if a triple around it has ``share`` % of its number or more, whether
    or not that triple is frequent by itself in the result.

    Words are runs between blanks, tabs and ends of pieces; pieces end at ``.,;:!?`` and line
    ends.  A-Z count as a-z.  A null ``lang`` is ``und``; null and empty texts have no words; every
    row counts, repeated ones too; texts may be of any length.  Further columns are ignored.
    An empty table gives no rows.
    """
    if least < 2:
        raise ValueError("phrases that stand once are all phrases")
    texts = docs.select(_tongue(F.col("lang")).alias("lang"), F.col("text").cast("string").alias("text"))
    # rare words collapse to their language's rest in the tasks that count them
    rest = F.when(F.col("n") >= least, F.col("word"))
    counted = stage(word_counts(texts).groupBy("lang", rest.alias("word")).agg(F.sum("n").alias("n")), "words")
    words = counted.filter("word IS NOT NULL")
    sums = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    marks = field(words, "word")
    two = stage(extensions(stripes(texts, marks, None, _common(words, ["word"], total)), least), "stripes")
    pairs = two.select("lang", F.col("prefix").alias("w1"), F.explode("found").alias("f")).select(
        "lang", "w1", F.col("f.word").alias("w2"), F.col("f.n").alias("n"))
    pairs = stage(pairs, "pairs")
    three = stage(extensions(stripes(texts, marks, field(pairs, "w1", "w2"), _common(pairs, ["w1", "w2"], total)), least), "stripes")
    parts = F.split("prefix", " ")
    triples = stage(three.select("lang", parts[0].alias("w1"), parts[1].alias("w2"), F.explode("found").alias("f")).select(
        "lang", "w1", "w2", F.col("f.word").alias("w3"), F.col("f.n").alias("a")), "triples")
    # prefix totals of the stripes are the left parts' numbers
    totals = lambda rows: rows.groupBy("lang", "prefix").agg(F.sum("total").alias("l"))
    own, last = totals(two).withColumnRenamed("prefix", "w1"), words.select("lang", F.col("word").alias("w2"), F.col("n").alias("r"))
    subsumed = three.filter(F.size("found") > 0).select("lang", "prefix", F.array_max(
        F.transform("found", lambda f: f["n"])).alias("n")).unionByName(
        triples.select("lang", F.concat_ws(" ", "w2", "w3").alias("prefix"), F.col("a").alias("n"))).groupBy(
        "lang", "prefix").agg(F.max("n").alias("longer")).withColumnRenamed("prefix", "phrase")
    both = pairs.withColumnRenamed("n", "a").join(own, ["lang", "w1"]).join(last, ["lang", "w2"]).select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r",
        _score(F.col("a"), F.col("l"), F.col("r")).alias("score")).join(subsumed, ["lang", "phrase"], "left").filter(
        F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True))).drop("longer")
    head = own.withColumnRenamed("l", "l1")
    tail = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("r1"))
    start = totals(three).select("lang", F.split("prefix", " ")[0].alias("w1"), F.split("prefix", " ")[1].alias("w2"),
                                 F.col("l").alias("l2"))
    end = last.select("lang", F.col("w2").alias("w3"), F.col("r").alias("r2"))
    cuts = triples.join(head, ["lang", "w1"]).join(tail, ["lang", "w2", "w3"]).join(start, ["lang", "w1", "w2"]).join(
        end, ["lang", "w3"]).withColumns({
            "s1": _score(F.col("a"), F.col("l1"), F.col("r1")), "s2": _score(F.col("a"), F.col("l2"), F.col("r2"))})
    later = F.col("s2") < F.col("s1")
    longer = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                         F.when(later, F.col("l2")).otherwise(F.col("l1")).alias("l"),
                         F.when(later, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.least("s1", "s2").alias("score"))
    return both.unionByName(longer).join(sums, "lang")


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, share: int = 50) -> DataFrame:
    """The ``top`` :func:`phrases` of every language with their ``rank`` from 1.

    Order: score, then number, both falling, then the phrase by its bytes.  A language's phrases are
    first ranked in 64 groups, so that one language does not meet in one task.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    group = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = phrases(docs, least, share).withColumn("rank", F.row_number().over(group)).filter(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return best.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
