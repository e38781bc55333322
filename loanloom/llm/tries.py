"""The tree of all beginnings of conversations, built with burst tries.

A conversation is the sequence of its turns' ids; equal sequences are one row that knows its
smallest conversation, their number and the digest of their numbers.  A container holds the
rests of all sequences below one head.  Containers with more turns than a limit burst: what
all their rests begin with is taken off at once, then the next turn's id names the child
container a rest goes to.  Containers that are small enough are sorted in their task and swept
into nodes.  The few heads get their totals from the containers below them, level by level.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.text import table
from loanloom.session import stage

#: Bytes of one turn in a sequence: a 128-bit digest of role and text, then its number of words.
TURN = 24
#: A container with more than this share of all turns bursts, so fewer than SHARE heads of one level can.
SHARE = 10_000
_EMPTY = hashlib.sha256(b"").hexdigest()
_ROOT = "00" * 16

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and its ``turns``: hexadecimal digests of role and text with their numbers of words.

    Turns are in order of ``turn`` (null first), then role, then text.  Null roles and texts are
    empty; rows without ``conv_id`` belong to no conversation.
    """
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # the length of the role keeps role and text apart
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))
    words = F.lpad(F.hex(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))), 16, "0")
    turn = F.struct(F.col("turn").isNotNull().alias("set"), "turn", "role", "text", F.concat(digest, words).alias("id"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t")).select(
        "conv_id", F.col("t.id").alias("turns"))


def rebuilt(sequences: DataFrame, group: int = 20, spread: int = 4) -> DataFrame:
    """The first turns of every conversation replaced by those of the first one of its ``group``.

    Conversation c takes the first h = crc32(c) % ``spread`` turns of conversation
    c - c % ``group`` (fewer or none if that has no more) and its own turns after its first h.
    """
    lead = sequences.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("of"), F.slice("turns", 1, spread - 1).alias("lead"))
    own = sequences.withColumn("of", F.col("conv_id") - F.col("conv_id") % group).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread).cast("int"))
    first = F.slice(F.coalesce("lead", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(lead, "of", "left").select("conv_id", F.concat(first, rest).alias("turns"))


def merged_sequences(sequences: DataFrame) -> DataFrame:
    """Every distinct sequence ``seq`` with its smallest ``conv_id``, their number ``n`` and ``ends_sha256``.

    Numbers of equal sequences are packed by neighbouring conversations first; the packs of one
    sequence stream in order through one digest, so copies of any number need no memory.
    """
    seq = F.unhex(F.array_join("turns", ""))
    packs = sequences.select(F.md5(seq).alias("key"), seq.alias("seq"), "conv_id").groupBy(
        "key", F.shiftright("conv_id", 10).alias("block")).agg(
        F.first("seq").alias("seq"), F.sort_array(F.collect_list("conv_id")).alias("ids")).select(
        "key", "block", "seq", F.col("ids")[0].alias("first"), F.size("ids").cast("long").alias("n"),
        F.array_join("ids", ",").alias("ids"))
    packs = packs.repartition("key").sortWithinPartitions("key", "block")

    def run(batches):
        now, seq, first, n, digest = None, None, None, 0, None
        for batch in batches:
            out = []
            for key, own, low, many, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "seq", "first", "n", "ids"))):
                if key == now:
                    digest.update(b",")
                    n += many
                else:
                    if now is not None:
                        out.append((seq, first, n, digest.hexdigest()))
                    now, seq, first, n, digest = key, own, low, many, hashlib.sha256()
                digest.update(ids.encode())
            yield _merged(out)
        if now is not None:
            yield _merged([(seq, first, n, digest.hexdigest())])

    return packs.select("key", "seq", "first", "n", "ids").mapInArrow(
        run, "seq binary, conv_id long, n long, ends_sha256 string")


def _merged(rows: list[tuple]) -> pa.RecordBatch:
    seq, first, n, ends = zip(*rows) if rows else ((), (), (), ())
    return table(seq=pa.array(seq, pa.binary()), conv_id=pa.array(first, pa.int64()), n=pa.array(n, pa.int64()),
                 ends_sha256=pa.array(ends, pa.string()))


def _common(low: Column, high: Column) -> Column:
    """Bytes of whole turns with which two sequences begin alike."""
    at = F.sequence(F.lit(0), F.least(F.octet_length(low), F.octet_length(high)).cast("int"), F.lit(TURN))
    same = F.filter(at, lambda i: F.substring(low, F.lit(1), i) == F.substring(high, F.lit(1), i))
    return F.array_max(same)


def _head(of: Column, turns: Column) -> Column:
    return F.md5(F.concat(of.cast("binary"), turns))


class _Sweep:
    """Nodes of one container from its sorted rests; one row of ``open`` for each node on the path."""

    def __init__(self, head: str, depth: int):
        self.head, self.depth = head, depth
        # parent's place, depth, smallest conversation, conversations, words, children, digest of ends
        self.rows: list[list] = [[-1, depth, None, 0, 0, 0, _EMPTY]]
        self.path, self.before = [0], b""

    def add(self, rest: bytes, first: int, n: int, ends: str) -> None:
        same, most = 0, min(len(rest), len(self.before))
        while same < most and rest[same:same + TURN] == self.before[same:same + TURN]:
            same += TURN
        del self.path[same // TURN + 1:]
        for at in range(same, len(rest), TURN):
            parent = self.path[-1]
            self.rows[parent][5] += 1
            words = int.from_bytes(rest[at + 16:at + TURN], "big")
            self.path.append(len(self.rows))
            self.rows.append([parent, self.depth + at // TURN + 1, None, 0, words, 0, _EMPTY])
        last, self.before = self.rows[self.path[-1]], rest
        last[2], last[3], last[6] = first, n, ends

    def nodes(self) -> list[tuple]:
        """Rows of NODE, each with the head in front; the first one is the container's top and has no parent."""
        rows, leaves, saved = self.rows, [0] * len(self.rows), [0] * len(self.rows)
        for i in range(len(rows) - 1, -1, -1):  # children come after their parents
            parent, _, first, n, words, children, _ = rows[i]
            leaves[i] += not children
            saved[i] += (n - 1) * words
            if parent >= 0:
                up = rows[parent]
                up[2] = first if up[2] is None else min(up[2], first)
                up[3] += n
                leaves[parent] += leaves[i]
                saved[parent] += saved[i]
        return [(self.head, r[2], r[1], rows[r[0]][2] if r[0] >= 0 else None, r[3], r[5], leaves[i], saved[i], r[6])
                for i, r in enumerate(rows)]


def sweep(containers: DataFrame) -> DataFrame:
    """Nodes of all containers (``head``, ``depth``, ``rest``, ``conv_id``, ``n``, ``ends_sha256``) with their
    ``head``; the top's own turn counts no words here."""
    ordered = containers.repartition("head").sortWithinPartitions("head", "rest")

    def run(batches):
        now, out = None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("head", "depth", "rest", "conv_id", "n", "ends_sha256"))
            for head, depth, rest, first, n, ends in zip(*columns):
                if now is None or head != now.head:
                    if now is not None:
                        out += now.nodes()
                    if len(out) > 20_000:
                        yield _nodes(out)
                        out = []
                    now = _Sweep(head, depth)
                now.add(rest, first, n, ends)
        if now is not None:
            out += now.nodes()
        if out:
            yield _nodes(out)

    return ordered.select("head", "depth", "rest", "conv_id", "n", "ends_sha256").mapInArrow(run, "head string, " + NODE)


_TYPES = [pa.string(), *[pa.int64()] * 7, pa.string()]
_NAMES = ["head", *[c.split()[0] for c in NODE.split(", ")]]


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)


def prefix_tree(sequences: DataFrame, limit: int = 200_000) -> DataFrame:
    """Nodes of the tree of ``sequences`` (``conv_id``, ``turns`` as in :func:`turn_sequences`).

    A node is a distinct sequence of first turns; its row has the smallest conversation that
    begins so, ``depth``, the parent's smallest conversation, and numbers of conversations,
    children and childless nodes below.  ``saved_tokens`` are words that copies of the turns in
    the node's subtree repeat; ``ends_sha256`` digests the conversations that end at the node.
    A container bursts if it has more than ``limit`` turns and more than one in ``SHARE`` of
    all; one sequence alone never does, however long it is.  A sequence is a row, as a text is.
    Without conversations there are no nodes, not even the root.
    """
    rows = stage(merged_sequences(sequences).select(
        F.lit(_ROOT).alias("head"), F.lit(0).cast("long").alias("depth"), F.col("seq").alias("rest"),
        "conv_id", "n", "ends_sha256", F.lit(None).cast("string").alias("up"), F.lit(0).cast("long").alias("words")), "trie")
    limit = max(limit, (rows.agg(F.sum(F.octet_length("rest"))).first()[0] or 0) // TURN // SHARE)
    small, bursts = [], []
    while True:
        heads = rows.groupBy("head").agg(
            F.count("*").alias("many"), F.sum(F.octet_length("rest")).alias("bytes"), F.min("rest").alias("low"),
            F.max("rest").alias("high"), F.first("depth").alias("depth"), F.first("up").alias("up"),
            F.first("words").alias("words"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"))
        big = stage(heads.filter((F.col("many") > 1) & (F.col("bytes") > limit * TURN)).withColumn(
            "common", _common(F.col("low"), F.col("high"))), "trie-heads")
        if big.isEmpty():
            small.append(rows)
            break
        # fewer than SHARE heads can be so large
        marked = rows.join(F.broadcast(big.select("head", "common")), "head", "left")
        small.append(rows.join(F.broadcast(big.select("head")), "head", "left_anti"))
        over = marked.filter("common IS NOT NULL").withColumn(
            "tail", F.expr("substring(rest, common + 1)"))
        ended = over.filter(F.octet_length("tail") == 0).select("head", "ends_sha256")
        bursts.append(stage(big.join(ended, "head", "left").withColumn("low", F.expr("substring(low, 1, common)")).select(
            "head", "up", "depth", "words", "conv_id", "n", "low", "common", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias(
                "ends_sha256")), "trie-bursts"))
        turn = F.expr(f"substring(tail, 1, {TURN})")
        rows = stage(over.filter(F.octet_length("tail") > 0).select(
            _head(F.col("head"), F.expr(f"substring(rest, 1, common + {TURN})")).alias("head"),
            (F.col("depth") + F.expr(f"common div {TURN}") + 1).alias("depth"),
            F.expr(f"substring(tail, {TURN + 1})").alias("rest"), "conv_id", "n", "ends_sha256",
            F.col("head").alias("up"), F.conv(F.hex(F.substring(turn, 17, 8)), 16, 10).cast("long").alias("words")), "trie")
    return _joined(small, bursts)


def _joined(small: list[DataFrame], bursts: list[DataFrame]) -> DataFrame:
    """Nodes of all containers and heads; parents and totals of tops go along the heads."""
    swept, tops = [], []
    for level, rows in enumerate(small):
        nodes = stage(sweep(rows), "trie-nodes") if bursts else sweep(rows)
        if not bursts:
            return nodes.drop("head")
        above = rows.groupBy("head").agg(F.first("up").alias("up"), F.first("words").alias("words"))
        top = nodes.filter("parent_conv_id IS NULL").join(above, "head").withColumn(
            "saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"))
        tops.append(top)
        swept.append(nodes.filter("parent_conv_id IS NOT NULL").select(*_NAMES[1:]))
    done: list[DataFrame] = []
    for level in range(len(bursts) - 1, -1, -1):
        below = tops[level + 1]  # containers and heads that hang on this level's heads
        sums = below.groupBy(F.col("up").alias("head")).agg(
            F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
        chains = stage(bursts[level].join(sums, "head"), "trie-chains")
        done.append(_parents(below, chains))
        at = F.expr(f"transform(sequence(0, common div {TURN}), i -> named_struct('i', i, 'w', "
                    f"if(i = 0, words, cast(conv(hex(substring(low, i * {TURN} - 7, 8)), 16, 10) as bigint))))")
        many = F.expr(f"common div {TURN}")
        each = chains.withColumn("at", at).select("*", F.posexplode("at").alias("i", "node"))
        down = F.expr("aggregate(slice(at, i + 1, size(at)), 0L, (s, x) -> s + x.w)")
        each = each.select(
            "head", "up", "conv_id", (F.col("depth") + F.col("i")).alias("depth"),
            F.when(F.col("i") > 0, F.col("conv_id")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
            F.when(F.col("i") < many, F.lit(1).cast("long")).otherwise(F.col("n_children")).alias("n_children"),
            "n_leaves", (F.col("saved") + (F.col("n") - 1) * down).alias("saved_tokens"),
            F.when(F.col("i") < many, F.lit(_EMPTY)).otherwise(F.col("ends_sha256")).alias("ends_sha256"), "i")
        done.append(each.filter("i > 0").select(*_NAMES[1:]))
        first = each.filter("i = 0")
        if level:
            tops[level] = tops[level].select("head", "up", *_NAMES[1:]).unionByName(
                first.select("head", "up", *_NAMES[1:]))
        else:
            done.append(first.select(*_NAMES[1:]))
    out = swept[0]
    for more in [*swept[1:], *done]:
        out = out.unionByName(more)
    return out


def _parents(tops: DataFrame, heads: DataFrame) -> DataFrame:
    """Nodes at the top of containers with the smallest conversation of the head above.

    Fewer than ``SHARE`` heads burst on one level, so they go to every task."""
    above = F.broadcast(heads.select(F.col("head").alias("up"), F.col("conv_id").alias("above")))
    return tops.join(above, "up").withColumn("parent_conv_id", F.col("above")).select(*_NAMES[1:])


def conversation_tree(conversations: DataFrame, group: int = 20, spread: int = 4, limit: int = 200_000) -> DataFrame:
    """:func:`prefix_tree` of the :func:`rebuilt` conversations of a table.

    Repeated rows are turns of their own.  Turns at the same place go by role, then text.  Null
    roles and texts are empty, a null turn comes first, rows without ``conv_id`` are left out.
    Texts may be of any length; they stand for their digests after one exchange.  Further columns
    are ignored, whatever their names.  A table without conversations has no nodes.
    """
    return prefix_tree(rebuilt(turn_sequences(conversations), group, spread), limit)
