"""Lines that several documents share, against plain Python."""

import random
from collections import defaultdict

from loanloom.llm import lines
from tests.llm import brute

BLANKS = " \t\n\u000b\u000c\r"


def key_of(line):
    return brute.lowered(line.strip(BLANKS)).decode()


def expected(rows, least_chars=20, least_docs=3):
    """``{(id, text): (lines, dropped, kept text)}`` of distinct (id, text) pairs."""
    low = -(1 << 63)
    docs = {(low if i is None else i, t) for i, t in rows}
    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key_of(line)) >= least_chars:
                holders[key_of(line)].add((i, t))
    keeper = {k: max(i for i, _ in v) for k, v in holders.items() if len(v) >= least_docs}
    out = {}
    for i, t in rows:
        own = (t or "").split("\n")
        left = [x for x in own if keeper.get(key_of(x), i) == (low if i is None else i) or key_of(x) not in keeper]
        out[i, t] = (len(own), len(own) - len(left), "\n".join(left))
    return out


def check(docs, rows, **limits):
    want = expected(rows, **limits)
    got = sorted((r["doc_id"] is not None, r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"])
                 for r in lines.line_report(docs, **limits).collect())
    assert got == sorted((i is not None, i, *want[i, t][:2], brute.digest(want[i, t][2].encode())) for i, t in rows)
    texts = sorted(map(repr, ((r["doc_id"], r["text"]) for r in lines.without_common_lines(docs, **limits).collect())))
    assert texts == sorted(repr((i, want[i, t][2] if want[i, t][1] else t)) for i, t in rows)


def test_random_lines(documents):
    rng = random.Random(3)
    pool = ["Short", "", "  ", "a line of twenty chars", "A LINE of twenty chars \t", "É une ligne assez longue",
            "é une ligne assez longue", "漢字" * 10, "漢字" * 9 + "漢", "x" * 20, "x" * 19, "one more common line 😀\r"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 9)))) for i in range(80)]
    check(documents(rows), rows)
    check(documents(rows), rows, least_chars=0, least_docs=2)


def test_odd_tables(documents):
    line = "the very same line in many texts"
    rows = [(None, None), (None, f"{line}\nx"), (7, f"x\n{line}\n{line}"), (7, f"x\n{line}\n{line}"), (7, f"{line}\ny"),
            (3, line), (3, ""), (5, f"\n{line}\n\n"), (-9, line.upper())]
    check(documents(rows), rows)
    clash = documents(rows).selectExpr("*", "1 AS id", "2 AS tk", "3 AS lines", "4 AS places", "5 AS whole")
    out = lines.without_common_lines(clash)
    assert out.columns == clash.columns and out.count() == len(rows)
    assert lines.without_common_lines(documents([])).count() == lines.line_report(documents([])).count() == 0


def test_hot_line_and_long_text(documents):
    hot = "this line stands in every text of all"
    long = "\n".join(f"line number {i} of a long text" for i in range(60_000)) + "\n" + "x" * 400_000
    rows = [(i, f"{hot}\nown line of document {i} only") for i in range(3000)] + [(9000 + i, long) for i in range(3)]
    rows += [(9100 + i, f"rare but repeated line {i % 400}\n{hot}") for i in range(1200)]
    check(documents(rows), rows)


def test_main_path_has_no_python(documents):
    plan = lines.line_report(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
