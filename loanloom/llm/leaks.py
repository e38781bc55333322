"""Benchmark passages in training text through a distributed positional inverted index.

The index is stored: each row is a segment of some neighbouring documents with its sorted
distinct terms, and for each term the word positions (postings) where it stands.  A search
reads the segments one at a time.  For each phrase it starts with the postings of the term
that is rarest in the whole corpus, shifts every list by the term's offset in the phrase, and
intersects in order of rarity until nothing is left or all terms agree.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.text import ALNUM_WORD, covered, keyed, matching, steps, strings, table
from loanloom.session import stage, staged_files

INDEX = ("doc_ids array<long>, tks array<long>, word_counts array<int>, terms binary, term_counts binary, postings binary")


def words_of(texts):
    """Words of a-z (A-Z lowered), digits and everything beyond ASCII, as hashes."""
    words = texts.lowered().words(ALNUM_WORD)
    return words.hashes(), words.offsets


def build_index(docs: DataFrame) -> DataFrame:
    """Postings of every word of every text, one row a segment of at most a few MB of text.

    ``postings`` are word positions in the segment (unsigned 32 bits, ascending in each term),
    ``terms`` sorted word hashes with ``term_counts`` postings each; ``word_counts`` cuts the
    segment into its documents.  Null and empty texts have no words but are listed.
    """

    def run(batches):
        for batch in batches:
            for part, some in steps(batch):
                hashes, offsets = words_of(some)
                order = np.argsort(hashes, kind="stable")
                new = np.ones(len(order), dtype=bool)
                new[1:] = hashes[order][1:] != hashes[order][:-1]
                terms = hashes[order][new]
                counts = np.diff(np.append(np.flatnonzero(new), len(order)))
                yield table(
                    doc_ids=pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    tks=pa.array([part.column("tk").to_pylist()], pa.list_(pa.int64())),
                    word_counts=pa.array([np.diff(offsets)], pa.list_(pa.int32())),
                    terms=pa.array([terms.tobytes()], pa.binary()),
                    term_counts=pa.array([counts.astype(np.uint32).tobytes()], pa.binary()),
                    postings=pa.array([order.astype(np.uint32).tobytes()], pa.binary()))

    rows, _ = keyed(docs)
    return stage(rows.select("doc_id", "tk", "text").mapInArrow(run, INDEX), "postings")


class Phrases:
    """Phrases of one block of a benchmark: term numbers of each, and the items that have them."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        texts = strings(pa.array([t for _, t in items], pa.string()))
        hashes, offsets = words_of(texts)
        self.vocabulary, terms = np.unique(hashes, return_inverse=True)
        found: dict[tuple, set[int]] = {}
        for i in range(len(items)):
            own = terms[offsets[i]:offsets[i + 1]].tolist()
            size = min(window, len(own))
            for at in range(len(own) - size + 1 if size else 0):
                found.setdefault(tuple(own[at:at + size]), set()).add(i)
        self.names = [name for name, _ in items]
        self.phrases = list(found)
        self.items = [sorted(x) for x in found.values()]
        # term numbers of all phrases, short ones filled up with their first term
        self.grid = np.array([p + p[:1] * (window - len(p)) for p in self.phrases],
                             dtype=np.int64).reshape(-1, window)


class Segment:
    """One row of the index, cut down to a vocabulary."""

    def __init__(self, row: dict, vocabulary: np.ndarray):
        terms = np.frombuffer(row["terms"], np.uint64)
        counts = np.frombuffer(row["term_counts"], np.uint32).astype(np.int64)
        self.postings = np.frombuffer(row["postings"], np.uint32)
        self.doc_ids, self.tks = row["doc_ids"], row["tks"]
        self.words = np.array(row["word_counts"], dtype=np.int64)
        self.ends = np.cumsum(self.words)
        at = np.minimum(np.searchsorted(terms, vocabulary), max(len(terms) - 1, 0))
        there = terms[at] == vocabulary if len(terms) else np.zeros(len(vocabulary), dtype=bool)
        starts = np.cumsum(counts) - counts
        self.starts = np.where(there, starts[at] if len(terms) else 0, 0)
        self.counts = np.where(there, counts[at] if len(terms) else 0, 0)

    def list_of(self, term: int) -> np.ndarray:
        return self.postings[self.starts[term]:self.starts[term] + self.counts[term]]

    def phrase(self, phrase: tuple[int, ...], order: list[int]) -> np.ndarray:
        """Positions where the phrase starts; ``order`` lists its offsets, the rarest term first."""
        found = self.list_of(phrase[order[0]]).astype(np.int64) - order[0]
        for o in order[1:]:
            if not len(found):
                return found
            there = self.list_of(phrase[o])
            at = np.minimum(np.searchsorted(there, found + o), len(there) - 1)
            found = found[there[at] == found + o]
        return self.inside(found, len(phrase))

    def inside(self, found: np.ndarray, size: int) -> np.ndarray:
        """Those that begin and end in one document."""
        found = found[found >= 0]
        doc = np.searchsorted(self.ends, found, "right")
        return found[found + size <= np.append(self.ends, 0)[doc]]

    def near(self, phrase: tuple[int, ...], slack: int) -> np.ndarray:
        """Starts and stops of places where the terms follow in order with at most ``slack``
        other words between neighbours; of several stops of a start, the first one.

        Lists are matched from the last term back.  Postings that can't reach the end are left
        out before the term ahead looks for its nearest one; of those that can, a nearer one
        never ends later.
        """
        if not all(self.counts[t] for t in phrase):
            return np.zeros((0, 2), dtype=np.int64)
        good = self.list_of(phrase[-1]).astype(np.int64)
        stops = good + 1
        for term in phrase[-2::-1]:
            there = self.list_of(term).astype(np.int64)
            at = np.searchsorted(good, there, "right")
            ok = at < len(good)
            ok[ok] = good[at[ok]] - there[ok] <= slack + 1
            good, stops = there[ok], stops[at[ok]]
        out = np.stack([good, stops], axis=1)
        doc = np.searchsorted(self.ends, out[:, 0], "right")
        return out[out[:, 1] <= np.append(self.ends, 0)[doc]]


def rarity(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Postings of each term of a vocabulary in the whole index."""

    def run(batches):
        total = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for row in batch.select(["terms", "term_counts"]).to_pylist():
                terms = np.frombuffer(row["terms"], np.uint64)
                if len(terms):
                    at = np.minimum(np.searchsorted(terms, vocabulary), len(terms) - 1)
                    counts = np.frombuffer(row["term_counts"], np.uint32)
                    total += np.where(terms[at] == vocabulary, counts[at], 0)
        used = np.flatnonzero(total)
        yield table(term=used, n=total[used])

    out = np.zeros(len(vocabulary), dtype=np.int64)
    for r in index.select("terms", "term_counts").mapInArrow(run, "term long, n long").groupBy(
            "term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


MATCH = "segment long, ord int, doc_id long, tk long, n_words long, spans array<int>, items array<string>"


def matches(index: DataFrame, phrases: Phrases) -> DataFrame:
    """Each document with the word ranges that phrases of the block occupy and the items hit.

    ``spans`` holds start and stop of merged ranges in turn.  Phrases and term counts go to
    the tasks; both are as large as one block of the benchmark.
    """
    counts = rarity(index, phrases.vocabulary)
    orders = [sorted(range(len(p)), key=lambda o: (counts[p[o]], o)) for p in phrases.phrases]
    names = [str(n) if n is not None else None for n in phrases.names]

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                segment = Segment(row, phrases.vocabulary)
                starts, sizes, owners = [], [], []
                # a phrase can only occur where each of its terms has a posting
                for i in np.flatnonzero((segment.counts > 0)[phrases.grid].all(axis=1)).tolist():
                    at = segment.phrase(phrases.phrases[i], orders[i])
                    if len(at):
                        starts.append(at)
                        sizes.append(np.full(len(at), len(phrases.phrases[i])))
                        owners += [i] * len(at)
                yield _documents(segment, row["segment"], starts, sizes, owners, phrases.items, names)

    with_number = index.withColumn("segment", F.monotonically_increasing_id())
    return with_number.mapInArrow(run, MATCH)


def _documents(segment: Segment, number: int, starts, sizes, owners, items, names) -> pa.RecordBatch:
    n = len(segment.words)
    spans: list = [[] for _ in range(n)]
    hit: list = [set() for _ in range(n)]
    if starts:
        start = np.concatenate(starts)
        mask = covered(int(segment.ends[-1]), start, start + np.concatenate(sizes))
        doc = np.searchsorted(segment.ends, start, "right")
        for d, o in zip(doc.tolist(), owners):
            hit[d].update(items[o])
        for d in np.unique(doc).tolist():
            low, high = int(segment.ends[d] - segment.words[d]), int(segment.ends[d])
            own = np.zeros(high - low + 2, dtype=np.int8)
            own[1:-1] = mask[low:high]
            spans[d] = np.flatnonzero(np.diff(own)).tolist()
    return table(
        segment=pa.array([number] * n, pa.int64()), ord=pa.array(range(n), pa.int32()),
        doc_id=pa.array(segment.doc_ids, pa.int64()), tk=pa.array(segment.tks, pa.int64()), n_words=segment.words,
        spans=pa.array(spans, pa.list_(pa.int32())),
        items=pa.array([[names[i] for i in sorted(h) if names[i] is not None] for h in hit],
                       pa.list_(pa.string())))


def near_matches(index: DataFrame, phrases: list[tuple[object, str]], slack: int) -> DataFrame:
    """``doc_id``, ``phrase`` (its name), ``start`` and ``stop``: words of each given phrase in
    order in one document, with at most ``slack`` other words between neighbours."""
    longest = max((len(words_of(strings(pa.array([t])))[0]) for _, t in phrases), default=0)
    wanted = Phrases(phrases, max(longest, 1))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row, wanted.vocabulary)
                for i in np.flatnonzero((segment.counts > 0)[wanted.grid].all(axis=1)).tolist():
                    found, owners = segment.near(wanted.phrases[i], slack), wanted.items[i]
                    if len(found):
                        doc = np.searchsorted(segment.ends, found[:, 0], "right")
                        before = (segment.ends - segment.words)[doc]
                        for o in owners:
                            yield table(
                                doc_id=pa.array([segment.doc_ids[d] for d in doc.tolist()], pa.int64()),
                                phrase=[str(wanted.names[o])] * len(doc),
                                start=found[:, 0] - before, stop=found[:, 1] - before)

    return index.mapInArrow(run, "doc_id long, phrase string, start long, stop long")


def _blocks(benchmark: DataFrame, rows: int):
    """The benchmark's rows, ``rows`` at a time."""
    block: list = []
    for r in benchmark.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        block.append((r["item_id"], r["text"]))
        if len(block) == rows:
            yield block
            block = []
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 10,
               block_rows: int = 20_000) -> DataFrame:
    """Per document: ``n_words``, merged word ``spans`` of benchmark windows and the ``items`` hit.

    A window is ``window`` consecutive words of an item, or all words of a shorter item that
    has any.  The benchmark is the query set: it is searched in blocks of ``block_rows`` items
    against the whole index.  ``items`` are item ids as strings, sorted, each once; items
    without an id mark spans only.  Every row is a document of its own: repeated rows and rows
    without an id keep their own result.  Null and empty texts have no words; without
    benchmark rows nothing is hit.  Further columns are not carried.
    """
    index = build_index(docs)
    parts = [matches(index, Phrases(block, window)) for block in _blocks(benchmark, block_rows)]
    if not parts:
        parts = [matches(index, Phrases([], window))]
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    if len(parts) > 1:  # a document has one row a block
        found = found.groupBy("segment", "ord").agg(
            F.first("doc_id").alias("doc_id"), F.first("tk").alias("tk"), F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.flatten(F.collect_list("items")).alias("items"))
    return found.select("doc_id", "n_words", "spans", F.array_sort(F.array_distinct("items")).alias("items"), "tk")


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Rows of ``docs`` without any benchmark window, with all their columns.

    Null and empty texts stay; repeated rows stay or go together; without benchmark rows or
    documents all rows stay.  Columns may have any names.  The index is deleted once the
    documents that are hit are known.
    """
    with staged_files(docs.sparkSession):
        hit = stage(find_leaks(docs, benchmark, window).filter(F.size("spans") > 0).select(
            F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), "tk").distinct(), "leaks-hit", outlive=True)
    return matching(docs, hit, "left_anti")


def leak_report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per document ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``."""

    def run(batches):
        for batch in batches:
            hits, digests = [], []
            for spans in batch.column("spans").to_pylist():
                edges = np.array(spans, dtype=np.int64).reshape(-1, 2)
                hits.append(int(covered(int(edges.max()) + 1, edges[:, 0], edges[:, 1]).sum()) if len(edges) else 0)
            items = batch.column("items").to_pylist()
            for own in items:
                digests.append(hashlib.sha256(",".join(own).encode()).hexdigest())
            yield table(doc_id=batch.column("doc_id"), n_words=batch.column("n_words"),
                        n_hit=pa.array(hits, pa.int64()), n_items=pa.array([len(x) for x in items], pa.int64()),
                        items_sha256=digests, contaminated=[n > 0 for n in hits])

    return find_leaks(docs, benchmark, window).mapInArrow(
        run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
