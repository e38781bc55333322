"""Passages of words that occur in earlier text, found through content-defined windows.

No Lempel-Ziv parse is run, though the query is named after one.  All text is cut into
content-defined segments (``windows``: up to ``length`` + 13 words) that are grouped by hash;
where segments agree only in part, their windows are compared singly, so that a passage ends
at exactly the word where the texts part.  Windows of ``length`` words that occur earlier are
marked and merged into duplicate spans.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from loanloom.llm.text import steps, table
from loanloom.llm.windows import merged, with_marks, word_units

#: Words of the k-gram under which a window is filed.
GRAM = 7


def duplicate_words(docs: DataFrame, length: int = 20) -> DataFrame:
    """``doc_id``, ``text``, and ``spans``: word ranges (start, stop, in order) of duplicate spans.

    A word is duplicate if a window of ``length`` words covers it whose words also start
    earlier: in a smaller ``doc_id``, or before it in the same text.  All windows are judged
    on the input.  Null ids sort first; rows with one id and different texts are ordered by a
    hash of the text; repeated rows are one document and get the same spans.  Null and empty
    texts have no words.  Further columns are not carried.
    """
    found = with_marks(docs, word_units, length, min(GRAM, length), earlier=True)

    def run(batches):
        for batch in batches:
            out = [merged(x, length) for x in batch.column("marks").to_pylist()]
            yield table(doc_id=batch.column("doc_id"), text=batch.column("text"),
                        spans=_spans_array(out))

    return found.select("doc_id", "text", "marks").mapInArrow(
        run, "doc_id long, text string, spans array<struct<start:int,stop:int>>")


def _spans_array(rows):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    return pa.array([[{"start": a, "stop": b} for a, b in r] for r in rows], kind)


def kept_words(docs: DataFrame, length: int = 20) -> DataFrame:
    """Per document ``n_words``, ``n_removed`` and ``kept_sha256``, the hash of the words that stay."""
    found = duplicate_words(docs, length)

    def run(batches):
        for batch in batches:
            ranges, at = batch.column("spans").to_pylist(), 0
            for part, some in steps(batch):
                rows = []
                for i in range(part.num_rows):
                    words, cut = some.bytes_of(i).split(), ranges[at + i]
                    total = len(words)
                    for r in reversed(cut):
                        del words[r["start"]:r["stop"]]
                    rows.append((total, total - len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
                at += part.num_rows
                n, gone, digest = zip(*rows)
                yield table(doc_id=part.column("doc_id"), n_words=list(n), n_removed=list(gone),
                            kept_sha256=list(digest))

    return found.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
