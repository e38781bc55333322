"""Nearest labelled texts against all pairs, held-out quality, and odd inputs."""

import random
import zlib

import numpy as np
import pytest

from loanloom.llm import toxicity


def corpus(n=500, seed=3):
    """Texts of a random vocabulary; label 1 comes with one of three words, sometimes."""
    rng = random.Random(seed)
    words, bad = [f"w{i}" for i in range(60)], ["vile", "awful", "nasty"]
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.3)
        own = rng.choices(words, k=rng.randint(5, 60))
        if y or rng.random() < 0.02:
            own += rng.choices(bad, k=rng.randint(1, 3))
        rng.shuffle(own)
        rows.append((i, " ".join(own), y))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_held_out_labels_are_found_and_never_read(tables, spark):
    rows, docs, labels = tables
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sorted(i for i in got if got[i]["held_out"]) == held
    truth = {i: y for i, _, y in rows}
    hits = sum(got[i]["predicted"] == truth[i] for i in held)
    assert hits / len(held) > 0.93 and all(0 <= r["score"] <= 1 for r in got.values())
    # turning the held-out labels around changes nothing
    other = spark.createDataFrame(
        [(i, 1, 1 - y if i in held else y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    again = {r["doc_id"]: r["score"] for r in toxicity.score(docs, other).collect()}
    assert again == {i: r["score"] for i, r in got.items()}
    # evidence names other labelled texts, best first
    for i, r in got.items():
        assert i not in r["neighbours"] and not set(r["neighbours"]) & set(held)
        assert list(r["cosines"]) == sorted(r["cosines"], reverse=True)


def test_neighbours_are_the_nearest_of_all():

    rng = np.random.default_rng(5)
    n, terms = 300, 40
    vectors = (rng.random((n, terms)) * (rng.random((n, terms)) < 0.1)).astype(np.float32)
    vectors /= np.maximum(np.sqrt((vectors ** 2).sum(axis=1)), 1e-9)[:, None]
    index = toxicity.Index(np.arange(terms, dtype=np.uint64), np.ones(terms), np.arange(n),
                           rng.integers(0, 2, n), vectors, [1.0, 1.0], 7)
    flat = index.postings.reshape(terms, -1).T
    for _ in range(200):
        own = np.sort(rng.choice(terms, rng.integers(1, 6), replace=False))
        q = rng.random(len(own)).astype(np.float32)
        at, sims = index.nearest(own, q, None)
        every = flat[:, own] @ q
        want = np.sort(every[every > 0])[::-1][:7]
        assert np.allclose(sims, want, atol=1e-5) and np.allclose(every[at], sims, atol=1e-5)


def test_odd_inputs(tables, spark):
    _, docs, labels = tables
    odd = docs.unionByName(spark.createDataFrame(
        [(None, "vile"), (900, None), (901, ""), (902, "w1 vile awful"), (902, "w1 vile awful"),
         (903, "w2 " * 5000)], "doc_id long, text string")).selectExpr("*", "1 AS score", "'x' AS y", "2 AS n")
    got = [r for r in toxicity.score(odd, labels).collect() if r["doc_id"] is None or r["doc_id"] >= 900]
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 6 and not by[None]["held_out"]
    assert by[900]["score"] == by[901]["score"] < 0.5 < by[902]["score"]
    assert len({r["score"] for r in got if r["doc_id"] == 902}) == 1
    none = labels.limit(0)
    assert {r["score"] for r in toxicity.score(docs.limit(3), none).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), labels).count() == 0
    strange = labels.selectExpr("CAST(NULL AS long) doc_id", "quality", "toxic").unionByName(
        labels.selectExpr("doc_id", "quality", "CAST(NULL AS int) toxic"))
    assert {r["score"] for r in toxicity.score(docs.limit(3), strange).collect()} == {0.5}


def test_calibration_rises():
    index = toxicity.Index(np.zeros(1, np.uint64), np.ones(1), np.zeros(0, np.int64), np.zeros(0, np.int64),
                           np.zeros((0, 1), np.float32), [1.0, 1.0], 3)
    votes = np.array([0.1, 0.2, 0.2, 0.5, 0.6, 0.9])
    index.calibrate(votes, np.array([0, 1, 0, 0, 1, 1]))
    scores = index.calibrated(np.linspace(-1, 1, 50))
    assert (np.diff(scores) >= 0).all() and scores[0] < scores[-1]
