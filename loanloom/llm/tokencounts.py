"""Token counts of documents in flat token files, found by a separator scan.

A token file is nothing but unsigned 16-bit ids (little-endian), one document after the
other, each followed by the end-of-document id.  There is no index and no document boundary
that a file system knows, so files are read in blocks that begin and end anywhere, even inside
an id.  Each task searches its blocks for the two bytes of the separator at every place, as
arrays.  A prefix sum of block lengths then tells where each block begins in its file and
thereby which places hold whole ids; a second one carries the last separator into the next
block.

Spark's text source reads and writes the raw bytes: it splits files among tasks at any size
and reaches any store.  Written lines are documents with the separator as line end; read
lines end at byte 0x0A, which the scan puts back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanloom.llm import bpe
from loanloom.llm.text import steps, table
from loanloom.session import shared_path, stage

#: Ids of a document's number in front of its text, 15 bits each, lowest first; bit 64 says it is missing.
HEAD = 5


def head_ids(number: int | None) -> np.ndarray:
    value = 1 << 64 if number is None else number % (1 << 64)
    return np.array([value >> 15 * i & 0x7FFF for i in range(HEAD)], dtype="<u2")


def number_of(head: bytes) -> int | None:
    value = sum(int(x) << 15 * i for i, x in enumerate(np.frombuffer(head, "<u2").tolist()))
    if value >> 64:
        return None
    return value - (1 << 64) if value >> 63 else value


def write_files(docs: DataFrame, ranks: str, path: str, separator: int) -> None:
    """Token files of ``docs`` (``doc_id``, ``text``), one a task: number, text, separator.

    ``separator`` must be no rank of the vocabulary and above 0x7FFF, which the number's ids
    never reach.
    """
    own = bpe.coder(ranks)
    if separator < 0x8000 or separator < len(own.names) and own.names[separator] or len(own.names) > 1 << 16:
        raise ValueError("the separator is an id of text or numbers, or ids need more than 16 bits")

    def run(batches):
        coder = bpe.coder(ranks)
        for batch in batches:
            for part, some in steps(batch, "text", 1 << 20):
                tokens = coder.encode(some)
                numbers = part.column("doc_id").to_pylist()
                yield table(value=pa.array([
                    head_ids(numbers[i]).tobytes() + tokens.of(i).astype("<u2").tobytes()
                    for i in range(len(numbers))], pa.binary()))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, "value binary")
    # a line's text is written as the bytes it has; the separator is spelled one byte a character
    rows.select(F.col("value").cast("string")).write.option("encoding", "ISO-8859-1").option(
        "lineSep", separator.to_bytes(2, "little").decode("latin-1")).text(path)


BLOCK = ("file long, start long, size long, n long, at array<long>, after array<binary>, "
         "first binary, last binary")


def _block(key, parts: list[bytes], separator: bytes, head: int) -> pa.RecordBatch:
    raw = b"\n".join(parts) + b"\n"
    data = np.frombuffer(raw, np.uint8)
    at = np.flatnonzero((data[:-1] == separator[0]) & (data[1:] == separator[1])).tolist()
    return table(
        file=[key[0]], start=[key[1]], size=[key[2]], n=[len(raw)], at=pa.array([at], pa.list_(pa.int64())),
        after=pa.array([[raw[i + 2:i + 2 + 2 * head] for i in at]], pa.list_(pa.binary())),
        first=pa.array([raw[:2 * head + 1]], pa.binary()), last=pa.array([raw[-1:]], pa.binary()))


def _blocks(spark: SparkSession, path: str, separator: bytes, head: int) -> DataFrame:
    """One row a block: its file, place and bytes, where the separator's two bytes stand at any
    place, and the bytes after each; the first and last bytes of a block stitch what its edges cut."""

    def run(batches):
        key, parts = None, []
        for batch in batches:
            for *own, value in zip(*(c.to_pylist() for c in batch.columns)):
                if own != key:
                    if key:
                        yield _block(key, parts, separator, head)
                    key, parts = own, []
                parts.append(value)
        if key:
            yield _block(key, parts, separator, head)

    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value")).mapInArrow(
        run, BLOCK)


def _whole_ids(separator: bytes, head: int):
    """Of each block's separators those at whole ids, with places in the file, counted in ids."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                # the scan adds one byte to a file that doesn't end with a line end
                if row["total"] - row["size"] not in (0, 1) or row["size"] % 2:
                    raise ValueError(f"{row['size']} bytes are no 16-bit ids, or begin with a byte order mark")
                following = row["next"] or b""
                at = [row["offset"] + i for i in row["at"]]
                after = [(a + following)[:2 * head] for a in row["after"]]
                if row["last"] == separator[:1] and following[:1] == separator[1:]:
                    at.append(row["offset"] + row["n"] - 1)
                    after.append(following[1:2 * head + 1])
                whole = [(i // 2, a) for i, a in zip(at, after) if i % 2 == 0]
                yield table(
                    file=[row["file"]], start=[row["start"]], ids=[row["size"] // 2],
                    at=pa.array([[i for i, _ in whole]], pa.list_(pa.int64())),
                    after=pa.array([[a for _, a in whole]], pa.list_(pa.binary())),
                    first=pa.array([row["first"][:2 * head]], pa.binary()))

    return run


def count(spark: SparkSession, path: str, separator: int, head: int = 0) -> DataFrame:
    """Documents of the token files under ``path``: ``file`` (hash of its path), ``ordinal`` in
    it, ``start`` (in ids), ``n_tokens`` before the separator, ``ended``, and the bytes of its
    first ``head`` ids (of what follows in the file, if the document is shorter).

    Ids after the last separator of a file are a document that isn't ``ended``.  A separator
    right after another ends a document of 0 ids; an empty file has no documents.  Files of
    half an id, or that begin with the bytes of a byte order mark, fail.
    """
    mark = separator.to_bytes(2, "little")
    blocks = stage(_blocks(spark, path, mark, head), "token-blocks")
    # few rows: a block of many MB is one
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.select(
        "file", "start", "size", "n", "at", "after", "first", "last",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.lead("first").over(order).alias("next"), F.sum("n").over(Window.partitionBy("file")).alias("total"))
    found = placed.mapInArrow(
        _whole_ids(mark, head), "file long, start long, ids long, at array<long>, after array<binary>, first binary")
    # the last separator before a block, and what follows it
    seen = F.last(F.when(F.size("at") > 0, F.struct(
        F.element_at("at", -1).alias("at"), F.element_at("after", -1).alias("after"))), True).over(before)
    found = found.select(
        "*", seen.alias("seen"), F.coalesce(F.sum(F.size("at")).over(before), F.lit(0)).alias("earlier"),
        F.first("first").over(order).alias("top"), F.lead("start").over(order).isNull().alias("at_end"))
    # ids after the last separator of the file
    place = F.coalesce(F.element_at("at", -1), F.col("seen.at"), F.lit(-1).cast("long"))
    stops = F.when(F.col("at_end") & (place + 1 < F.col("ids")), F.concat("at", F.array("ids"))).otherwise(F.col("at"))
    starts = F.concat(F.array(F.coalesce("seen.at", F.lit(-1).cast("long"))), F.col("at"))
    heads = F.concat(F.array(F.coalesce("seen.after", "top")), F.col("after"))
    rows = found.select("file", "ids", "earlier", F.posexplode(F.filter(
        F.arrays_zip(stops.alias("stop"), starts.alias("start"), heads.alias("head")),
        lambda d: d["stop"].isNotNull())).alias("i", "d"))
    return rows.select(
        "file", (F.col("earlier") + F.col("i")).alias("ordinal"), (F.col("d.start") + 1).alias("start"),
        (F.col("d.stop") - F.col("d.start") - 1).alias("n_tokens"), (F.col("d.stop") < F.col("ids")).alias("ended"),
        F.col("d.head").alias("head"))


def document_counts(docs: DataFrame, ranks: str, separator: int) -> DataFrame:
    """Per row of ``docs`` ``doc_id`` and the ``n_tokens`` of its text, by way of token files.

    The files are written under the session's shared folder.  Null and empty texts have no
    tokens; repeated rows and missing ids are documents like others; an empty table gives none.
    """
    path = shared_path(docs.sparkSession, "token-files")
    write_files(docs, ranks, path, separator)

    def run(batches):
        for batch in batches:
            yield table(doc_id=pa.array([number_of(h) for h in batch.column("head").to_pylist()], pa.int64()),
                        n_tokens=batch.column("n_tokens"))

    found = count(docs.sparkSession, path, separator, HEAD)
    return found.select("head", (F.col("n_tokens") - HEAD).alias("n_tokens")).mapInArrow(
        run, "doc_id long, n_tokens long")
