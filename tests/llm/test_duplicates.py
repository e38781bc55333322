"""Near-duplicates, repeated words and repeated bytes against plain Python."""

import random

import pytest

from loanloom.llm import minhash, substring, suffixes, windows
from loanloom.llm.queries import QUERIES
from tests.llm import brute


def rows_of(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def made(seed, n=60, words=80):
    """Texts that share passages, with edits, copies, and borders at any word."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ñandú", "!", "Ab"]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(15, 60))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, words)))]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(passages))
        text = rng.choice([" ", "\n", "  "]).join(parts)
        if out and rng.random() < 0.3:
            text = rng.choice(out)[1]
            if rng.random() < 0.7:
                own = text.split(" ")
                own[rng.randrange(len(own))] = "edited"
                text = " ".join(own)
        out.append((i, text))
    return out


EDGES = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "One"), (6, "two words"), (7, "two  words"),
         (8, "a " * 300), (9, "a " * 300), (10, "é" * 500), (11, "x" * 450)]


def test_queries_on_the_smallest_table(spark, sf_dir, sample):
    _, rows = sample
    got = rows_of(QUERIES["op1_circulant_minhash"](spark, sf_dir), "n_shingles", "component_id", "kept")
    assert got == {i: (n, c, i == c) for i, (n, c) in brute.components(rows, 3, 85).items()}
    got = rows_of(QUERIES["op2_lempel_ziv_dedup"](spark, sf_dir), "n_words", "n_removed", "kept_sha256")
    assert got == brute.earlier_words(rows, 20)
    got = rows_of(QUERIES["op7_radix_suffix_dedup"](spark, sf_dir), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute.repeated_bytes(rows, 200)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tables(documents, seed):
    rows = made(seed)
    df = documents(rows)
    assert rows_of(substring.kept_words(df), "n_words", "n_removed", "kept_sha256") == brute.earlier_words(rows, 20)
    assert rows_of(suffixes.kept_bytes(df), "n_bytes", "n_removed", "n_spans", "kept_sha256"
                   ) == brute.repeated_bytes(rows, 200)
    got = rows_of(minhash.near_duplicates(df), "n_shingles", "component_id")
    assert got == brute.components(rows, 5, 80)


def test_edges(documents):
    df = documents(EDGES)
    assert rows_of(substring.kept_words(df), "n_words", "n_removed", "kept_sha256") == brute.earlier_words(EDGES, 20)
    assert rows_of(suffixes.kept_bytes(df), "n_bytes", "n_removed", "n_spans", "kept_sha256"
                   ) == brute.repeated_bytes(EDGES, 200)
    assert rows_of(minhash.near_duplicates(df, 3, 85), "n_shingles", "component_id") == brute.components(EDGES, 3, 85)


def test_short_windows_reach_every_border(documents):
    """Window lengths close to the k-gram, and chunks larger than segments."""
    rows = made(7, n=25)
    df = documents(rows)
    for length in (7, 8, 11):
        assert rows_of(substring.kept_words(df, length), "n_words", "n_removed", "kept_sha256"
                       ) == brute.earlier_words(rows, length)
    for length in (64, 65, 90):
        assert rows_of(suffixes.kept_bytes(df, length), "n_bytes", "n_removed", "n_spans", "kept_sha256"
                       ) == brute.repeated_bytes(rows, length)


def test_repeated_rows_missing_ids_and_shared_ids(documents):
    long = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    df = documents([(1, long), (1, long), (1, other), (None, long), (None, None), (2, other)])
    words = sorted(((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring.kept_words(df).collect()), key=str)
    # null ids come first, so their text is the earliest; rows with one id and text are one document
    assert words == sorted([(None, 60, 0), (None, 0, 0), (1, 60, 60), (1, 60, 60), (1, 60, 0), (2, 60, 60)], key=str)
    gone = sorted(((r["doc_id"], r["n_removed"] == r["n_bytes"]) for r in suffixes.kept_bytes(df).collect()), key=str)
    assert gone == sorted([(None, True), (None, True), (1, True), (1, True), (1, True), (2, True)], key=str)
    lone = documents([(1, long), (1, long)])
    assert [r["n_removed"] for r in suffixes.kept_bytes(lone).collect()] == [0, 0]
    near = minhash.near_duplicates(df).collect()
    assert sum(r["kept"] for r in near) == 3  # two texts and the one without words
    assert {r["component_id"] for r in near} == {1, None}
    left = minhash.deduplicated(df).collect()
    assert len(left) == 3 and set(left[0].asDict()) == set(df.columns)


def test_empty_table_and_other_columns(documents):
    df = documents([])
    assert substring.kept_words(df).count() == suffixes.kept_bytes(df).count() == 0
    assert minhash.near_duplicates(df).count() == 0
    clash = documents([(1, "a b c d e f"), (2, "a b c d e f")]).selectExpr(
        "*", "1 AS id", "2 AS tk", "'x' AS marks", "3 AS num", "true AS kept")
    assert substring.kept_words(clash).count() == 2
    assert minhash.deduplicated(clash).columns == clash.columns
    assert minhash.deduplicated(clash).count() == 1


def test_chains_reach_the_smallest_id(spark, documents):
    """Neighbours are similar, ends are not."""
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(words[i * 3:i * 3 + 60])) for i in range(15)]
    got = rows_of(minhash.near_duplicates(documents(rows), 3, 85), "component_id")
    assert got == {i: (c,) for i, (_, c) in brute.components(rows, 3, 85).items()}
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r["node"]: r["root"] for r in minhash.components(edges).collect()} == {
        **{i: 0 for i in range(1, 41)}, 101: 100}


def test_copies_that_resemble_few_of_each_other_meet_in_turns(documents, monkeypatch):
    """Three edits each: one pair in six is linked, so many aren't linked with a bucket's first one."""
    rng = random.Random(5)
    base, rows = [f"w{i}" for i in range(250)], []
    for i in range(500):
        words = list(base)
        for k in rng.sample(range(5, 245), 3):
            words[k] = f"x{i}y{k}"
        rows.append((i, " ".join(words)))
    compared, verified = [], minhash.verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(minhash, "verified", counted)
    got = rows_of(minhash.near_duplicates(documents(rows)), "n_shingles", "component_id")
    assert got == brute.components(rows, 5, 80)
    assert sum(compared[1:]) < len(rows)


def test_signatures_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    other = np.concatenate([base[:800], rng.integers(0, 1 << 63, 200, dtype=np.uint64)])
    rows = minhash.signatures(np.concatenate([np.sort(base), np.sort(other)]), np.array([0, 1000, 2000]))
    assert abs((rows[0] == rows[1]).mean() - 800 / 1200) < 0.15


def test_sliding_minimum():
    import numpy as np

    x = np.random.default_rng(1).integers(0, 1 << 60, 500, dtype=np.uint64)
    for w in (1, 2, 7, 499, 500):
        assert (windows._sliding_min(x, w) == [x[i:i + w].min() for i in range(501 - w)]).all()
