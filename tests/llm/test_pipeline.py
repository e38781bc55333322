"""The pipeline's stages against plain Python, each on its own input."""

import numpy as np
import pytest

import corpus_pipeline
from loanloom.llm import bpe, pii
from loanloom.llm.queries import QUERIES, RANKS
from loanloom.llm.text import strings
from loanloom.session import stage
from tests.llm import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and output of every stage on the smallest tables."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        after = stage(function(spark, docs, sf_dir), "stage")
        out[name] = (docs, after)
        docs = after
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages)
    names = list(stages)
    assert all(stages[n][1].columns == COLUMNS for n in names[:-1])
    assert stages[names[-1]][1].columns == [*COLUMNS, "token_ids", "n_tokens"]


def test_quality_rules_take_effect(stages, spark, sf_dir):
    before, after = (texts(x) for x in stages["quality rules"])
    kept = {r["doc_id"] for r in QUERIES["op6_perplexity_rules"](spark, sf_dir).filter("kept").collect()}
    assert set(after) == kept and all(after[i] == before[i] for i in after)


def test_one_of_each_group_stays(stages):
    before, after = (texts(x) for x in stages["near dedup"])
    groups = brute.components(list(before.items()), 5, 80)
    assert set(after) == {i for i, (_, c) in groups.items() if i == c}


def test_no_benchmark_passage_is_left(stages, spark, sf_dir):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    before, after = (texts(x) for x in stages["decontamination"])
    found = brute.leaks(list(before.items()), items, 10)
    assert set(after) == {i for i, v in found.items() if not v[4]} and len(after) < len(before)


def test_personal_data_are_gone(stages):
    before, after = (texts(x) for x in stages["personal data"])
    found = {r["doc_id"]: r["spans"] for r in pii.report(stages["personal data"][0]).collect()}
    assert any("<email>" in t for t in after.values())
    assert set(before) == set(after)
    for i, text in after.items():
        assert not brute.base_spans(text)
        spans = sorted((int(a), int(b), kind) for kind, a, b in (x.split(":") for x in found[i].split(",") if x))
        assert text == brute.redacted(before[i], spans)
        if not brute.base_spans(before[i]) and "token = " not in before[i].lower():
            assert text == before[i]


def test_ids_decode_to_the_text(stages):
    before, after = stages["tokens"]
    own, want = bpe.coder(RANKS), texts(before)
    rows = after.collect()
    assert {r["doc_id"] for r in rows} == set(want)
    for r in rows:
        ids = np.frombuffer(r["token_ids"], "<u4")
        assert len(ids) == r["n_tokens"] and own.decode(ids).tobytes().decode() == want[r["doc_id"]]
    assert strings(after.select("text").toArrow()["text"]).data.size == sum(len(t.encode()) for t in want.values())


def test_run_is_the_chain(stages, spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, got)) == sorted(
        map(tuple, stages["tokens"][1].select("doc_id", "n_tokens").collect()))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_tables(spark, sf_dir, name):
    function = dict(corpus_pipeline.STAGES)[name]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, id int, kept boolean"
    long = " ".join(f"word{i}" for i in range(300))
    rows = [(1, None, "en", "s", None, 1, None), (None, "", None, None, 0, 2, True), (2, long, "en", "s", 1, 3, True),
            (2, long, "en", "s", 1, 3, True), (3, "x" * 50_000, "xx", None, 1, None, False), (3, long, None, "t", 2, 5, True)]
    out = function(spark, spark.createDataFrame(rows, ddl), sf_dir)
    assert out.columns[:7] == [c.split()[0] for c in ddl.split(", ")] and out.count() <= len(rows)
    assert function(spark, spark.createDataFrame([], ddl), sf_dir).count() == 0
