"""Phrases against plain Python counters."""

import random
import re
from collections import Counter, defaultdict

import pytest

from loanloom.llm import collocations
from tests.llm import brute

DDL = "doc_id long, lang string, text string"


def expected(rows, top=2000, least=10, share=50):
    f, n, out = defaultdict(Counter), Counter(), []
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", brute.lowered(text)):
            words = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    for lang, count in f.items():
        good = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in good.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], a)
        found = []
        for p, a in good.items():
            if longer[p] and 100 * longer[p] >= share * a:
                continue
            cuts = [(1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, b" ".join(p), count[p[:k]], count[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def check(spark, rows, **how):
    got = sorted(map(tuple, collocations.collocations(spark.createDataFrame(rows, DDL), **how).collect()))
    want = expected(rows, **how)
    assert got == want
    return got


def random_rows(rng, n, words):
    marks = [" ", "  ", "\t", " ", " ", ", ", ". ", "\n", "!", "\u000b"]
    return [(i, rng.choice(["en", "fr", None]), "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 60))))
            for i in range(n)]


@pytest.mark.parametrize("common", [8192, 3])
def test_random_texts(spark, monkeypatch, common):
    """Once with whole counters, once with the counters of most prefixes in slices."""
    monkeypatch.setattr(collocations, "COMMON", common)
    rows = random_rows(random.Random(common), 150, ["a", "B", "b", "the", "of", "é", "É", "漢字", "new-york", "x1", "l'eau"])
    assert len(check(spark, rows)) > 50
    check(spark, rows, top=7, least=3, share=90)


def test_rare_words_and_many_tasks(spark):
    rng = random.Random(8)
    rows = random_rows(rng, 400, [f"w{i}" for i in range(60)] + ["of the", "in the end"] * 12)
    rows += [(1000 + i, "en", f"once upon a time lived u{i}") for i in range(30)]
    docs = spark.createDataFrame(rows, DDL).repartition(13)
    got = sorted(map(tuple, collocations.collocations(docs).collect()))
    assert got == expected(rows)
    assert ("en", "once upon a") in {(r[0], r[2]) for r in got} and "once upon" not in {r[2] for r in got}


def test_odd_tables(spark):
    hot = "hot pair " * 20_000
    rows = [(None, None, None), (1, "en", ""), (2, "en", hot), (3, "fr", "only nine " * 9), (4, "", "ten times. " * 10),
            (5, "und", "same phrase, " * 6), (5, None, "SAME Phrase; " * 6), (7, "xx", "x" * 300_000 + " y z"), (8, "en", ".,;:!?\n\t ")]
    check(spark, rows)
    clash = spark.createDataFrame(rows, DDL).selectExpr("*", "1 AS word", "2 AS n", "'a' AS prefix", "3 AS l", "4 AS score")
    assert sorted(map(tuple, collocations.collocations(clash).collect())) == expected(rows)
    assert collocations.collocations(spark.createDataFrame([], DDL)).count() == 0
    with pytest.raises(ValueError):
        collocations.phrases(spark.createDataFrame([], DDL), least=1)


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    for a, left, right in ((3 * 10**12, 10**13 + 7, 4 * 10**12), (999_999_999_999_999, 10**15 - 1, 10**15), (10, 10, 10)):
        row = spark.range(1).select(collocations._score(F.lit(a), F.lit(left), F.lit(right))).first()
        assert row[0] == 1_000_000 * a * a // (left * right)
