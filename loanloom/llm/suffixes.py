"""Byte strings that occur more than once, found through content-defined windows.

No radix sort of suffixes is run, though the query is named after one: nothing is ordered.
Windows of ``length`` bytes are filed under a k-gram of their own, neighbours with the same
one together (a segment, see ``windows``), and grouped by hashes: first of all the text a
segment covers, then of the text that ``CHUNK`` neighbouring windows share, then of each
window's own ``length`` bytes.  Settled groups leave after each pass; what shares a group in
the end is exactly the repeated windows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from loanloom.llm.text import steps, table
from loanloom.llm.windows import byte_units, merged, with_marks

#: Bytes of the first digit.
GRAM = 64
#: Suffixes of a part that a later pass deals together.
CHUNK = 8


def repeated_bytes(docs: DataFrame, length: int = 200) -> DataFrame:
    """``doc_id``, ``text``, and ``spans``: byte ranges (start, stop, in order) of the UTF-8 text.

    A byte is in a span if a string of ``length`` bytes covers it that also starts anywhere
    else, in the same text too; overlaps count and every string is judged on the input.  Rows
    that share id and text are one document, so repeated rows alone repeat nothing; equal
    texts under different ids do.  Null and empty texts have no bytes.  Further columns are
    not carried.
    """
    found = with_marks(docs, byte_units, length, min(GRAM, length), earlier=False,
                       chunk=CHUNK)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches):
        for batch in batches:
            rows = [[{"start": a, "stop": b} for a, b in merged(x, length)]
                    for x in batch.column("marks").to_pylist()]
            yield table(doc_id=batch.column("doc_id"), text=batch.column("text"),
                        spans=pa.array(rows, kind))

    return found.select("doc_id", "text", "marks").mapInArrow(
        run, "doc_id long, text string, spans array<struct<start:int,stop:int>>")


def kept_bytes(docs: DataFrame, length: int = 200) -> DataFrame:
    """Per document ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of the bytes that stay."""
    found = repeated_bytes(docs, length)

    def run(batches):
        for batch in batches:
            ranges, at = batch.column("spans").to_pylist(), 0
            for part, some in steps(batch):
                rows = []
                for i in range(part.num_rows):
                    text, cut = some.bytes_of(i), ranges[at + i]
                    edges = [0, *(x for r in cut for x in (r["start"], r["stop"])), len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    rows.append((len(text), len(text) - len(kept), len(cut), hashlib.sha256(kept).hexdigest()))
                at += part.num_rows
                n, gone, runs, digest = zip(*rows)
                yield table(doc_id=part.column("doc_id"), n_bytes=list(n), n_removed=list(gone),
                            n_spans=list(runs), kept_sha256=list(digest))

    return found.mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
