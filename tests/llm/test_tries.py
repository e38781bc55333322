"""The tree of conversations against plain Python, in one container and in many that burst."""

import binascii
import random

import pytest

from loanloom.llm import tries
from tests.llm import brute

DDL = "conv_id long, turn long, role string, text string"


def rebuilt(rows, group=20, spread=4):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c in turns:
        h = binascii.crc32(str(c).encode()) % spread
        lead = turns.get(int(c / group) * group, [])
        out[c] = tuple(lead[:h] + turns[c][h:])
    return out


def tree(sequences):
    nodes = {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    kids, leaves, saved = ({p: 0 for p in nodes} for _ in range(3))
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    for p, members in nodes.items():
        words = len(p[-1][1].encode().split()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(members) - 1) * words
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], brute.digest(
        ",".join(str(c) for c in sorted(m) if sequences[c] == p).encode())) for p, m in nodes.items())


def check(spark, rows, **how):
    got = sorted(map(tuple, tries.conversation_tree(spark.createDataFrame(rows, DDL), **how).collect()))
    assert got == tree(rebuilt(rows))
    return got


def random_rows(rng, conversations, texts, most):
    rows = []
    for c in conversations:
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for t in range(rng.randint(0, most))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [200_000, 40, 3])
def test_random_conversations(spark, limit):
    rng = random.Random(limit)
    rows = random_rows(rng, range(-45, 130), ["hi", "hi there", "", None, "what is it ?"], 6)
    check(spark, rows, limit=limit)


def test_common_beginnings_burst_at_once(spark):
    """300 conversations share 30 turns; their heads are one chain, not 30 rounds."""
    rows = [(20 * c, t, "user", f"turn {t} of all") for c in range(300) for t in range(30)]
    rows += [(20 * c, 30 + t, "user", f"turn {c % 7} {t}") for c in range(300) for t in range(c % 3)]
    rows += [(20 * c, 90, "user", "copies end alike") for c in range(150)]
    got = check(spark, rows, limit=100)
    assert len({r[1] for r in got if r[3] == 300}) == 31


def test_odd_tables(spark):
    long = "word " * 200_000
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "a", "z"),
            (1, 0, "user", ""), (2, 5, "us", "era"), (2, 6, "user", "a"), (20, 0, "user", long), (21, 0, "user", long),
            (22, 1, "x", long), (-7, 0, "r", "t"), (-20, 0, "r", "u"), (9_223_372_036_854_775_807, 0, "user", "far")]
    check(spark, rows)
    clash = spark.createDataFrame(rows, DDL).selectExpr("*", "1 AS head", "2 AS rest", "3 AS n", "4 AS t", "5 AS depth")
    assert sorted(map(tuple, tries.conversation_tree(clash).collect())) == tree(rebuilt(rows))
    assert tries.conversation_tree(spark.createDataFrame([], DDL)).count() == 0
    assert tries.conversation_tree(spark.createDataFrame([(None, 1, "a", "b")], DDL)).count() == 0


def test_many_copies_are_digested_in_packs(spark):
    rows = [(c, 0, "user", "the same question") for c in range(0, 60_000, 7)]
    check(spark, rows, limit=3)
