"""Lines that several documents share: counted by hash, dropped but in one document.

Only DataFrame functions run here.  Lines are exploded with their place and a hash of their
normalised form; documents are counted for each hash after partial sums in every task, and
what repeats meets the lines again.  Lines that make up more than a set share of all repeats
are few by arithmetic and go to every task, so that no task gets all rows of a common line.
The places of dropped lines are gathered for each document, which is cut and joined once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.text import keyed
from loanloom.session import stage

#: Stripped at both ends of a line.
BLANKS = " \t\n\u000b\u000c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A line with more than one in so many of all repeated lines is handed to every task.
COMMON = 10_000


def split_lines(text: Column) -> Column:
    """Lines of a text, ends kept; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def hashed_lines(texts: DataFrame, least_chars: int) -> DataFrame:
    """A row for each line of ``id``, ``tk``, ``text`` whose key has ``least_chars`` code points:
    its place ``pos`` from 0, the key's hash (``h1``, ``h2``), and whether it is the ``first``
    of equal ones in its document."""
    keys = F.transform(split_lines(lowered(F.col("text"))), lambda line: F.btrim(line, F.lit(BLANKS)))
    hashed = F.transform(keys, lambda key, i: F.struct(
        F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), i.alias("pos"),
        F.char_length(key).alias("size")))
    lines = F.array_sort(F.filter(hashed, lambda x: x["size"] >= least_chars))

    def flag(x, i):
        before = F.get("lines", i - 1)
        first = (i == 0) | (before["h1"] != x["h1"]) | (before["h2"] != x["h2"])
        return F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["pos"].alias("pos"), first.alias("first"))

    return texts.select("id", "tk", lines.alias("lines")).select(
        "id", "tk", F.explode(F.transform("lines", flag)).alias("line")).select("id", "tk", "line.*")


def dropped_places(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """``id`` and ``tk`` of every document that loses lines (see :func:`loanloom.llm.text.keyed`)
    and the ``places`` of those lines, from 0."""
    texts, unique = keyed(docs)
    texts = texts.select("id", "tk", "text")
    if not unique:
        texts = texts.dropDuplicates(["id", "tk"])
    lines = stage(hashed_lines(texts, least_chars), "lines")
    repeated = stage(lines.filter("first").groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.max("id").alias("keeper")).filter(F.col("n") >= least_docs), "lines-repeated")
    total = repeated.agg(F.sum("n")).first()[0] or 0
    # fewer than COMMON lines can have more than this share of the total
    common = F.broadcast(repeated.filter(F.col("n") * COMMON > total).select("h1", "h2", "keeper"))
    rare = repeated.filter(F.col("n") * COMMON <= total).select("h1", "h2", "keeper")
    hit = lines.join(common, ["h1", "h2"]).unionByName(
        lines.join(common.select("h1", "h2"), ["h1", "h2"], "left_anti").join(rare, ["h1", "h2"]))
    return hit.filter("id <> keeper").groupBy("id", "tk").agg(F.collect_list("pos").alias("places"))


def _cut(docs: DataFrame, least_chars: int, least_docs: int, *more: Column) -> DataFrame:
    """``doc_id``, ``more``, ``lines`` and ``places`` (null: none) of every row."""
    places = dropped_places(docs, least_chars, least_docs)
    texts, _ = keyed(docs, *more)
    return texts.join(places, ["id", "tk"], "left").withColumn("lines", split_lines(F.col("text")))


def _kept(row_lines: str = "lines") -> Column:
    """Lines without those at ``places``, joined again; set difference keeps the order."""
    all_places = F.sequence(F.lit(0), F.size(row_lines) - 1)
    left = F.transform(F.array_except(all_places, "places"), lambda i: F.get(row_lines, i))
    return F.array_join(left, "\n")


def without_common_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """``docs`` with all columns; lines found in ``least_docs`` documents stay in one of them.

    Lines are equal if they are so without blanks at both ends and with A-Z in lower case;
    shorter ones than ``least_chars`` code points stay.  The largest ``doc_id`` that holds a line
    keeps it, everywhere in its text.  Null ``doc_id`` counts as smaller than all; rows that
    share number and text are one document and all get its result; rows that share a number
    only are documents of their own that keep a line together.  Texts without a dropped line,
    null ones too, come back as they are; a text may be of any length and is one row.  Tables
    without rows give none; columns may have any names.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    cut = _cut(docs, least_chars, least_docs, whole)
    text = F.when(F.col("places").isNull(), F.col("text")).otherwise(_kept())
    return cut.select(*[text.alias(c) if c == "text" else F.col("whole")[c].alias(c) for c in docs.columns])


def line_report(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """Per row ``doc_id``, ``n_lines``, ``n_dropped`` and ``kept_sha256``.

    Ties, nulls, repeated rows and empty tables are as in :func:`without_common_lines`; null
    and empty texts have one empty line.  Other columns are not carried.
    """
    text = F.when(F.col("places").isNull(), F.coalesce("text", F.lit(""))).otherwise(_kept())
    return _cut(docs, least_chars, least_docs).select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(text, 256).alias("kept_sha256"))
