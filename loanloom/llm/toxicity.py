"""Toxicity from the nearest labelled texts by exact TF-IDF cosine.

A bounded sample of labelled texts (a documented parameter) becomes a block-max inverted
index: examples lie in blocks of like ones, and each term keeps its largest weight in every
block.  A text bounds its cosine with every block from those maxima, visits blocks in order of
their bounds and stops once no bound can beat the k-th best, so its neighbours are exact.
They vote by similarity; leave-one-out votes of the examples calibrate the votes.

Terms are the words that tell the labels of the sample apart best; how rare they are is
counted over all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.leaks import words_of
from loanloom.llm.text import steps, table
from loanloom.session import stage

#: Examples of a block, and blocks that are looked into before bounds are compared.
BLOCK, FIRST = 32, 12


def learnable(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``y`` of rows that may be learned from: crc32 of the id, mod 3, is not 1."""
    return labels.filter(
        "doc_id IS NOT NULL AND toxic IS NOT NULL AND crc32(cast(doc_id AS string)) % 3 <> 1").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("y"))


def examples(docs: DataFrame, labels: DataFrame, most: int) -> tuple[DataFrame, list[float]]:
    """At most ``most`` labelled texts, half of each label, picked by a hash of the id; and how
    many labelled rows each one of either label stands for."""
    known = stage(learnable(labels), "labels")
    totals = dict.fromkeys((0, 1), 0) | {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    picks = [known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2)
             for y in (0, 1)]
    # bounded by ``most`` pairs of numbers
    picked = F.broadcast(picks[0].unionByName(picks[1]))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).join(picked, "doc_id")
    weights = [totals[y] / max(1, min(totals[y], most // 2)) for y in (0, 1)]
    return stage(rows, "examples"), weights


def telling_terms(sample: DataFrame, most: int, least_docs: int = 4, least_chi2: float = 25.0) -> np.ndarray:
    """Hashes of at most ``most`` terms whose presence goes with the label most, by chi-square."""

    def run(batches):
        for batch in batches:
            for part, some in steps(batch):
                hashes, offsets = words_of(some)
                text = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                pairs = np.unique(np.stack([hashes, text.astype(np.uint64)]), axis=1)
                y = part.column("y").to_numpy()[pairs[1].astype(np.int64)]
                terms, at = np.unique(pairs[0], return_inverse=True)
                yield table(term=terms.view(np.int64), n=np.bincount(at, minlength=len(terms)),
                            n1=np.bincount(at, y, minlength=len(terms)).astype(np.int64))

    total, ones = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not total or not ones or ones == total:
        return np.zeros(0, dtype=np.uint64)
    share = ones / total
    found = sample.select("text", "y").mapInArrow(run, "term long, n long, n1 long").groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("n1").alias("n1")).filter(F.col("n") >= least_docs)
    chi2 = F.pow(F.col("n1") - F.col("n") * share, 2) / (
        F.col("n") * share * (1 - share) * (1 - F.col("n") / total + 1e-9))
    top = found.withColumn("chi2", chi2).filter(F.col("chi2") >= least_chi2).orderBy(
        F.desc("chi2"), "term").limit(most).collect()
    return np.sort(np.array([r["term"] for r in top], dtype=np.int64).view(np.uint64))


def frequencies(texts, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term number and count of every term that occurs in some texts."""
    hashes, offsets = words_of(texts)
    at = np.minimum(np.searchsorted(terms, hashes), max(len(terms) - 1, 0))
    hit = np.flatnonzero(terms[at] == hashes) if len(terms) else np.zeros(0, np.int64)
    text = np.searchsorted(offsets, hit, "right") - 1
    keys, n = np.unique(text * max(len(terms), 1) + at[hit], return_counts=True)
    return keys // max(len(terms), 1), keys % max(len(terms), 1), n


def rarity(docs: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Inverse document frequency of each term over all documents."""

    def run(batches):
        n, seen = 0, np.zeros(len(terms), dtype=np.int64)
        for batch in batches:
            for part, some in steps(batch):
                n += part.num_rows
                seen += np.bincount(frequencies(some, terms)[1], minlength=len(terms))[:len(terms)]
        yield table(term=np.arange(-1, len(terms)), n=np.append(n, seen))

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r["term"]: r["n"] for r in rows}
    return np.log1p(counts.get(-1, 0) / (1.0 + np.array([counts.get(i, 0) for i in range(len(terms))])))


class Index:
    """Unit vectors of the examples in blocks, with the largest weight of each term in each block."""

    def __init__(self, terms, idf, ids, labels, vectors, weights, k: int):
        # examples with the same leading terms become neighbours, so that bounds are tight
        order = np.lexsort((ids, vectors.argmax(axis=1) if vectors.shape[1] else ids))
        order = order[np.abs(vectors[order]).sum(axis=1) > 0]
        self.terms, self.idf, self.k, self.weights = terms, idf, k, np.array(weights)
        self.ids, self.labels = ids[order], labels[order]
        self.members = set(self.ids.tolist())
        blocks = -(-len(order) // BLOCK)
        full = np.zeros((blocks * BLOCK, len(terms)), dtype=np.float32)
        full[:len(order)] = vectors[order]
        # postings of a term by block, and the largest of each block
        self.postings = np.ascontiguousarray(full.T).reshape(len(terms), blocks, BLOCK)
        self.highest = self.postings.max(axis=2)
        self.steps = np.array([0.0, 1.0])
        self.values = np.array([0.0, 1.0])
        self.prior = 0.0

    def unit(self, own: np.ndarray, n: np.ndarray) -> np.ndarray:
        weights = (1 + np.log(n)) * self.idf[own]
        return (weights / np.sqrt((weights ** 2).sum())).astype(np.float32)

    def nearest(self, own: np.ndarray, q: np.ndarray, skip) -> tuple[np.ndarray, np.ndarray]:
        """The k most similar examples, best first (ties by place), without example ``skip``."""
        bounds = q @ self.highest[own]
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        at, sims = self._inside(own, q, order[:FIRST], skip)
        if len(order) > FIRST:
            # the blocks that can still hold one of the k best
            least = np.partition(sims, len(sims) - self.k)[-self.k] if len(sims) >= self.k else 0.0
            rest = order[FIRST:]
            more, others = self._inside(own, q, rest[bounds[rest] >= least - 1e-6], skip)
            at, sims = np.concatenate([at, more]), np.concatenate([sims, others])
        if len(sims) > self.k:
            good = sims >= np.partition(sims, len(sims) - self.k)[-self.k]
            at, sims = at[good], sims[good]
        best = np.lexsort((at, -sims))[:self.k]
        return at[best], sims[best]

    def _inside(self, own, q, blocks, skip) -> tuple[np.ndarray, np.ndarray]:
        """Examples of some blocks with a common term, and their cosines."""
        sims = np.tensordot(q, self.postings[np.ix_(own, blocks)], axes=1)
        at = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        good = sims.ravel() > 0
        at, sims = at[good], sims.ravel()[good]
        if skip in self.members:
            other = self.ids[at] != skip
            at, sims = at[other], sims[other]
        return at, sims

    def vote(self, own, q, skip) -> tuple[float, np.ndarray, np.ndarray]:
        """Share of label 1 among the neighbours, by similarity, mixed with the share of all."""
        best, sims = self.nearest(own, q, skip)
        y = self.labels[best]
        w = sims.astype(np.float64) ** 2 * self.weights[y]
        calm = 0.5 * self.weights.min()
        return float(((w * y).sum() + calm * self.prior) / (w.sum() + calm)), best, sims

    def votes(self, texts, ids):
        """For each text its vote and neighbours; without known terms, the vote is -1."""
        text, own, n = frequencies(texts, self.terms)
        edges = np.searchsorted(text, np.arange(len(texts) + 1))
        same: dict[tuple[bytes, bytes], tuple] = {}  # texts of the same counts share neighbours
        for i in range(len(texts)):
            mine = slice(edges[i], edges[i + 1])
            if edges[i] == edges[i + 1]:
                yield -1.0, (), ()
                continue
            key = own[mine].tobytes(), n[mine].tobytes()
            if ids[i] in self.members:
                yield self.vote(own[mine], self.unit(own[mine], n[mine]), ids[i])
                continue
            if key not in same:
                same[key] = self.vote(own[mine], self.unit(own[mine], n[mine]), None)
            yield same[key]

    def calibrate(self, votes: np.ndarray, y: np.ndarray) -> None:
        """Rising steps from votes to shares of label 1: neighbours that fall are pooled."""
        order = np.argsort(votes, kind="stable")
        groups: list[list[float]] = []
        for v, label in zip(votes[order].tolist(), y[order].tolist()):
            w = float(self.weights[label])
            if groups and groups[-1][0] == v:
                groups[-1][1] += w
                groups[-1][2] += w * label
            else:
                groups.append([v, w, w * label])
        pooled: list[list[float]] = []
        for g in groups:
            pooled.append(list(g))
            while len(pooled) > 1 and pooled[-2][2] / pooled[-2][1] >= pooled[-1][2] / pooled[-1][1]:
                last = pooled.pop()
                pooled[-1][1] += last[1]
                pooled[-1][2] += last[2]
        if pooled:
            self.steps = np.array([g[0] for g in pooled])
            # one more example of either kind keeps small groups off 0 and 1
            self.values = np.array([(g[2] + self.prior) / (g[1] + 1.0) for g in pooled])
            self.values = np.maximum.accumulate(self.values)

    def calibrated(self, votes: np.ndarray) -> np.ndarray:
        return self.values[np.maximum(np.searchsorted(self.steps, votes, "right") - 1, 0)]


def fit(docs: DataFrame, labels: DataFrame, most: int = 6000, terms: int = 1024, k: int = 15) -> Index:
    """The index of at most ``most`` labelled examples and ``terms`` terms; both bound its size."""
    sample, weights = examples(docs, labels, most)
    chosen = telling_terms(sample, terms)
    idf = rarity(docs, chosen)

    def rows(batches):
        for batch in batches:
            for part, some in steps(batch):
                text, own, n = frequencies(some, chosen)
                edges = np.searchsorted(text, np.arange(part.num_rows + 1))
                cut = [slice(edges[i], edges[i + 1]) for i in range(part.num_rows)]
                yield table(doc_id=part.column("doc_id"), y=part.column("y"),
                            own=pa.array([own[c] for c in cut], pa.list_(pa.int64())),
                            n=pa.array([n[c] for c in cut], pa.list_(pa.int64())))

    found = sample.mapInArrow(rows, "doc_id long, y int, own array<long>, n array<long>").orderBy(
        "doc_id", "y").collect()
    vectors = np.zeros((len(found), len(chosen)), dtype=np.float32)
    ids, y = np.array([r["doc_id"] for r in found], dtype=np.int64), np.array([r["y"] for r in found], dtype=np.int64)
    index = Index(chosen, idf, ids[:0], y[:0], vectors[:0], weights, k)
    for i, r in enumerate(found):
        if r["own"]:
            own = np.array(r["own"])
            vectors[i, own] = index.unit(own, np.array(r["n"]))
    index = Index(chosen, idf, ids, y, vectors, weights, k)
    mass = index.weights[y] if len(y) else np.zeros(0)
    index.prior = float((mass * y).sum() / mass.sum()) if len(y) else 0.5
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def leave_one_out(batches):
        own = shared.value
        for batch in batches:
            for part, some in steps(batch):
                votes = [v[0] for v in own.votes(some, part.column("doc_id").to_pylist())]
                yield table(vote=votes, y=part.column("y"))

    checked = sample.mapInArrow(leave_one_out, "vote double, y int").orderBy("vote", "y").collect()
    if checked:
        index.calibrate(np.array([r["vote"] for r in checked]), np.array([r["y"] for r in checked]))
    else:
        index.values = np.array([index.prior, index.prior])
    return index


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **size) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted`` and the evidence,
    ids of the nearest labelled texts and their cosines.

    Only ``text`` enters a score; a text is never its own neighbour.  Null and empty texts and
    texts without a telling term get the share of label 1 among such texts.  Without labelled
    rows every score is 0.5.  Repeated rows are scored alike; a missing id is not held out.
    """
    index = fit(docs, labels, **size)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        own = shared.value
        for batch in batches:
            for part, some in steps(batch):
                found = list(own.votes(some, part.column("doc_id").to_pylist()))
                scores = own.calibrated(np.array([f[0] for f in found]))
                yield table(
                    doc_id=part.column("doc_id"), score=scores,
                    predicted=(scores >= threshold).astype(np.int32),
                    neighbours=pa.array([own.ids[np.array(f[1], dtype=np.int64)] for f in found], pa.list_(pa.int64())),
                    cosines=pa.array([np.array(f[2], dtype=np.float32) for f in found], pa.list_(pa.float32())))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return rows.mapInArrow(
        run, "doc_id long, score double, predicted int, neighbours array<long>, cosines array<float>").select(
        "doc_id", held.alias("held_out"), "score", "predicted", "neighbours", "cosines")
