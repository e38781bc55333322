"""Encoding against the library, decoding, and token files."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken

from loanloom.llm import bpe, tokencounts
from loanloom.llm.queries import QUERIES, RANKS
from loanloom.llm.text import strings
from loanloom.session import shared_path

PIECES = [" ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "'ve", "'t", "'d", "r", "e", "s", "ab", "X", "1", "²", "é",
          "漢", "!", "?", " ", "　", "😀", "\x1c", "\r\n", "l", "v", "don't", "́"]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_like_the_library(library):
    rng = random.Random(5)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 15))) for _ in range(3000)]
    texts += ["", "a" * 2000 + " " * 60 + "!" * 500, "ab'" * 300, "'", " ", "x " * 5000]
    own = bpe.coder(RANKS)
    found = own.encode(strings(pa.array(texts)))
    assert [found.of(i).tolist() for i in range(len(texts))] == [library.encode_ordinary(t) for t in texts]
    assert own.decode(found.ids).tobytes() == "".join(texts).encode()


def test_a_full_memory_starts_anew(library):
    small = bpe.Coder(bpe.coder(RANKS).ranks, cache=10)
    for text in ("one two three four five six seven eight nine ten eleven", "twelve one two", ""):
        assert small.encode(strings(pa.array([text]))).of(0).tolist() == library.encode_ordinary(text)


def test_queries(spark, sf_dir, sample, library, narrow):
    _, rows = sample
    want = {i: library.encode_ordinary(t or "") for i, t in rows}
    got = {r["doc_id"]: r for r in QUERIES["op5_bpe_round_trip"](spark, sf_dir).collect()}
    for i, text in rows:
        ids = np.array(want[i], dtype="<u4").tobytes()
        assert tuple(got[i])[1:] == (len(want[i]), hashlib.sha256(ids).hexdigest(),
                                     hashlib.sha256((text or "").encode()).hexdigest())
    counts = QUERIES["op10_token_counts"](spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in counts) == sorted((i, len(x)) for i, x in want.items())


def test_edges(spark, documents):
    df = documents([(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b"), (-7, "é" * 3000)]).selectExpr(
        "*", "'x' AS n_tokens", "1 AS value")
    rows = bpe.decode(bpe.encode(df, RANKS), RANKS).collect()
    assert [bytes(r["decoded"]).decode() for r in rows] == [r["text"] or "" for r in rows]
    assert all(len(r["token_ids"]) == 4 * r["n_tokens"] for r in rows)
    counts = tokencounts.document_counts(df, RANKS, 50_256).collect()
    assert sorted(map(tuple, counts), key=str) == sorted(((r["doc_id"], r["n_tokens"]) for r in rows), key=str)
    none = documents([])
    assert bpe.encode(none, RANKS).count() == bpe.round_trip(none, RANKS).count() == 0
    assert tokencounts.document_counts(none, RANKS, 50_256).count() == 0


@pytest.mark.parametrize("block", [64, 100, 1 << 20])
def test_any_file_in_any_blocks(spark, tmp_path, block):
    """Files that this code didn't write, with separators at every kind of border."""
    rng = np.random.default_rng(block)
    separator = 0xC450
    files, want = {}, []
    for name, ended in (("a.bin", True), ("b.bin", False), ("c.bin", True)):
        ids = rng.choice(np.array([10, 0x0A0A, 0x50C4, 0xC450, 0x0A50, 0xC40A, 7, 1234], dtype="<u2"), 700)
        ids[0] = 5
        ids[-1] = separator if ended else 9
        (tmp_path / name).write_bytes(ids.tobytes())
        cuts = np.flatnonzero(ids == separator)
        starts = np.append(0, cuts + 1)
        stops = cuts if ended else np.append(cuts, len(ids))
        want += [(k, int(a), int(b - a), bool(b < len(ids))) for k, (a, b) in enumerate(zip(starts, stops))]
        files[name] = ids
    (tmp_path / "empty.bin").write_bytes(b"")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = tokencounts.count(spark, str(tmp_path), separator, head=2).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r["ordinal"], r["start"], r["n_tokens"], r["ended"]) for r in got) == sorted(want)
    assert len({r["file"] for r in got}) == 3
    texts = [x.tobytes() for x in files.values()]
    assert all(any(t[2 * r["start"]:2 * r["start"] + 4] == bytes(r["head"]) for t in texts) for r in got)


def test_files_that_are_no_ids(spark, tmp_path):
    (tmp_path / "odd.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="16-bit"):
        tokencounts.count(spark, str(tmp_path), 0xC450).collect()
    with pytest.raises(ValueError):
        tokencounts.write_files(spark.range(0).selectExpr("id AS doc_id", "'' AS text"), RANKS,
                                shared_path(spark, "no"), 11)


def test_numbers_survive():
    for n in (0, 1, -1, 32767, 32768, (1 << 63) - 1, -(1 << 63), None):
        assert tokencounts.number_of(tokencounts.head_ids(n).tobytes()) == n


def test_parts_are_decoded_from_their_pieces(spark, documents):
    rng = random.Random(9)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(1, 40))) for _ in range(60)]
    texts += ["", None, "one two three " * 20_000, "b" * 300, "same words", "same words"]
    df = bpe.encode(documents(list(enumerate(texts))), RANKS, offsets=True)
    whole = bpe.decode(df, RANKS)
    ranges = [(0, 1 << 30), (0, 0), (3, 9), (7, 8), (-5, 4), (9, 3), (1 << 40, 1 << 41), (None, 5), (250_000, 250_011)]
    asked = whole.crossJoin(spark.createDataFrame(ranges, "a long, z long"))
    rows = bpe.decode_part(asked, RANKS, "a", "z").collect()
    assert len(rows) == len(texts) * len(ranges)
    for r in rows:
        raw = (r["text"] or "").encode()
        assert bytes(r["decoded"]) == raw
        assert bytes(r["part"]) == (b"" if r["a"] is None else raw[max(r["a"], 0):max(r["z"], 0)])
        begins = np.frombuffer(r["piece_bytes"], "<u4")
        assert len(begins) == len(r["piece_ids"]) // 4 and (np.diff(begins) > 0).all()
    assert bpe.decode_part(asked.limit(0), RANKS, "a", "z").count() == 0


def test_a_part_decodes_few_ids(monkeypatch):
    own = bpe.coder(RANKS)
    text = "one two three four " * 5_000
    found = own.encode(strings(pa.array([text])))
    packed = [x.astype("<u4").tobytes() for x in (found.ids, found.pieces[:-1], found.begins)]
    seen, plain = [], own.decode
    monkeypatch.setattr(own, "decode", lambda ids: seen.append(len(ids)) or plain(ids))
    assert own.part(*packed, 50_000, 50_020) == text[50_000:50_020].encode()
    assert max(seen) < 12
