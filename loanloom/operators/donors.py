"""Index of rows for exact nearest neighbours where either side may lack features.

Rows are put in k-d order once and cut into blocks; a block keeps its rows packed and, per
feature, the range of its values, how many rows have it and the smallest row numbers that do.
Blocks are summed up into nodes until few are left.  Any pattern of missing values is searched
on the same blocks: only the features that a searching row has count towards the bounds, and a
feature that a block has in some rows only counts towards neither its least nor its distance.
Cuts by a feature that searching rows lack would make them look into both sides, so its spread
weighs as much as the share of the rows with gaps that have it; this steers speed alone.
Bounds and distances use the same operations in the same order and rounding keeps their order,
so a block that is passed over cannot hold a neighbour, ties included.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.session import stage

#: Rows a block, children a node, and nodes that every search task may hold.
BLOCK_ROWS = 256
NODE_CHILDREN = 64
TOP_NODES = 512
#: Rows that are put in k-d order together, and rows that the coarse cuts are taken from; both
#: steer speed alone.
CHUNK_ROWS = 65_536
CUT_ROWS = 50_000
COARSE_LEAVES = 1_024

#: Searching rows handled together, and packs in one batch of output.
SLICE = 512
PACKS = 64
#: Nodes of each level that a first look follows, per searching row and feature.
FIRST_LOOK = 2
NO_NUMBER = np.iinfo(np.int64).max

SUMMARY = ("low array<double>, high array<double>, have array<bigint>, rows bigint, "
           "first array<bigint>")
PACK = "node bigint, ids binary, x binary, reach binary, upto binary"
FOUND = "id bigint, feature int, dist double, donor bigint, value double"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Arrays of equal length as rows of a matrix, null as NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _arrays(matrix: np.ndarray) -> pa.Array:
    """Rows of a matrix as arrays, NaN as null."""
    width = matrix.shape[1]
    flat = pa.array(matrix.ravel(), from_pandas=True)
    return pa.ListArray.from_arrays(np.arange(0, matrix.size + 1, width, dtype=np.int32), flat)


# ---- building -------------------------------------------------------------------------------


def _widest(x: np.ndarray, weight: np.ndarray | None = None) -> tuple[int, float] | None:
    """The feature with the widest weighted spread and its median; None where no value differs."""
    spread = np.full(x.shape[1], -1.0)
    some = ~np.isnan(x).all(axis=0)
    if some.any():
        spread[some] = np.nanmax(x[:, some], axis=0) - np.nanmin(x[:, some], axis=0)
    if weight is not None and (weight * spread > 0).any():
        spread = weight * spread
    axis = int(spread.argmax())
    if not spread[axis] > 0:
        return None
    cut = float(np.nanmedian(x[:, axis]))
    if cut >= np.nanmax(x[:, axis]):  # most rows hold the largest value
        cut = float(np.nanmax(x[:, axis][x[:, axis] < cut]))
    return axis, cut


def _coarse_cuts(sample: np.ndarray, leaves: int, weight: np.ndarray | None = None) -> list[tuple[int, float] | None]:
    """Cuts of a full binary tree, breadth first; None where a side can't be cut further."""
    cuts: list[tuple[int, float] | None] = []
    level = [sample]
    while 2 * len(level) <= leaves:
        following = []
        for part in level:
            cut = _widest(part, weight) if len(part) > 1 else None
            cuts.append(cut)
            right = part[:, cut[0]] > cut[1] if cut else np.zeros(len(part), bool)
            following += [part[~right], part[right]]
        level = following
    return cuts


def _leaf_of(x: np.ndarray, cuts: Sequence[tuple[int, float] | None]) -> np.ndarray:
    """Number of the leaf each row falls into; a missing value goes to the lower side."""
    place = np.zeros(len(x), dtype=np.int64)
    axes = np.array([c[0] if c else 0 for c in cuts], dtype=np.int64)
    values = np.array([c[1] if c else np.inf for c in cuts])
    for _ in range((len(cuts) + 1).bit_length() - 1):
        right = x[np.arange(len(x)), axes[place]] > values[place]
        place = 2 * place + 1 + right
    return place - len(cuts)


def _cut(x: np.ndarray, rows: np.ndarray, most: int, weight: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """``rows`` in k-d order, at most ``most`` at a time."""
    todo = [rows]
    while todo:
        part = todo.pop()
        if len(part) <= most:
            yield part
            continue
        cut = _widest(x[part], weight)
        if cut is None:
            yield from (part[i:i + most] for i in range(0, len(part), most))
            continue
        right = x[part, cut[0]] > cut[1]
        todo += [part[right], part[~right]]


def _blocks_of(x: np.ndarray, most: int, weight: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Rows of a chunk by block: rows with the same features together unless they are few."""
    gone = np.isnan(x)
    starts = [0, *(np.flatnonzero((gone[1:] != gone[:-1]).any(axis=1)) + 1), len(x)]
    few: list[np.ndarray] = []
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if 2 * (b - a) >= most:
            yield from _cut(x, np.arange(a, b), most, weight)
            continue
        if few and sum(map(len, few)) + b - a > most:
            yield np.concatenate(few)
            few = []
        few.append(np.arange(a, b))
    if few:
        yield np.concatenate(few)


def _smallest(numbers: np.ndarray, k: int) -> np.ndarray:
    out = np.full(k, NO_NUMBER)
    best = np.sort(numbers)[:k]
    out[:len(best)] = best
    return out


def _summary(x: np.ndarray, numbers: np.ndarray, k: int) -> tuple:
    there = ~np.isnan(x)
    low = np.where(there, x, np.inf).min(axis=0)
    high = np.where(there, x, -np.inf).max(axis=0)
    none = ~there.any(axis=0)
    first = np.concatenate([_smallest(numbers[there[:, i]], k) for i in range(x.shape[1])])
    return np.where(none, np.nan, low), np.where(none, np.nan, high), there.sum(axis=0), len(x), first


def _summary_columns(summaries: list[tuple]) -> list[pa.Array]:
    low, high, have, rows, first = zip(*summaries, strict=True)
    return [_arrays(np.array(low)), _arrays(np.array(high)), _arrays(np.array(have, dtype=np.int64)),
            pa.array(rows, pa.int64()), _arrays(np.array(first, dtype=np.int64))]


def _pack_blocks(n: int, k: int, most: int, chunk: int, weight: np.ndarray):
    def pack(batches):
        kept_x: list[np.ndarray] = []
        kept_numbers: list[np.ndarray] = []

        def flush():
            x, numbers = np.concatenate(kept_x), np.concatenate(kept_numbers)
            kept_x.clear()
            kept_numbers.clear()
            packed, sums = [], []
            for rows in _blocks_of(x, most, weight):
                rows = rows[np.argsort(numbers[rows], kind="stable")]
                packed.append((numbers[rows].tobytes(), np.ascontiguousarray(x[rows]).tobytes()))
                sums.append(_summary(x[rows], numbers[rows], k))
            for i in range(0, len(sums), PACKS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in packed[i:i + PACKS]], pa.binary()),
                     pa.array([p[1] for p in packed[i:i + PACKS]], pa.binary()),
                     *_summary_columns(sums[i:i + PACKS])],
                    ["numbers", "values", "low", "high", "have", "rows", "first"])

        for batch in batches:
            if not batch.num_rows:
                continue
            kept_x.append(_matrix(batch.column("x"), n))
            kept_numbers.append(batch.column("number").to_numpy())
            if sum(map(len, kept_x)) >= chunk:
                yield from flush()
        if kept_x:
            yield from flush()

    return pack


def _merge_nodes(n: int, k: int):
    """One row for the children of a node: their summaries packed, and their joint summary."""
    def merge(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("node")
        nodes = _Nodes.from_columns(table, n, k)
        first = nodes.first.reshape(len(nodes.rows), n, k)
        joint = (
            np.fmin.reduce(nodes.low, axis=0), np.fmax.reduce(nodes.high, axis=0),
            nodes.have.sum(axis=0), int(nodes.rows.sum()),
            np.concatenate([_smallest(first[:, i].ravel(), k) for i in range(n)]))
        packed = [pa.array([part.tobytes()], pa.binary()) for part in nodes.parts()]
        return pa.Table.from_arrays(
            [table.column("parent").combine_chunks()[:1].cast(pa.int64()), *packed, *_summary_columns([joint])],
            ["node", *_Nodes.NAMES, "low", "high", "have", "rows", "first"])

    return merge


@dataclass
class _Nodes:
    """Summaries of some nodes as matrices."""

    NAMES = ("c_node", "c_low", "c_high", "c_have", "c_rows", "c_first")

    node: np.ndarray
    low: np.ndarray
    high: np.ndarray
    have: np.ndarray
    rows: np.ndarray
    first: np.ndarray

    @classmethod
    def from_columns(cls, table: pa.Table, n: int, k: int) -> _Nodes:
        column = lambda name: table.column(name).combine_chunks()
        return cls(column("node").to_numpy(), _matrix(column("low"), n), _matrix(column("high"), n),
                   _matrix(column("have"), n), column("rows").to_numpy(), _matrix(column("first"), n * k))

    @classmethod
    def from_row(cls, row: dict, n: int, k: int) -> _Nodes:
        node, low, high, have, rows, first = (
            np.frombuffer(row[c], dtype=np.float64 if c in ("c_low", "c_high") else np.int64) for c in cls.NAMES)
        return cls(node, low.reshape(-1, n), high.reshape(-1, n), have.reshape(-1, n), rows,
                   first.reshape(-1, n * k))

    def parts(self) -> list[np.ndarray]:
        return [np.ascontiguousarray(a, dtype=t) for a, t in zip(
            [self.node, self.low, self.high, self.have, self.rows, self.first],
            [np.int64, np.float64, np.float64, np.int64, np.int64, np.int64], strict=True)]


# ---- searching ------------------------------------------------------------------------------


def _bounds(x: np.ndarray, nodes: _Nodes) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance of each row to the rows of each node that it can be compared
    with; both infinite where there are none, the greatest also where some row has nothing in
    common."""
    n = x.shape[1]
    shape = (len(x), len(nodes.rows))
    least, most, top = np.zeros(shape), np.zeros(shape), np.zeros(shape)
    sure, may = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
    for i in range(n):
        mine = ~np.isnan(x[:, i])[:, None]
        if not mine.any():
            continue
        value = x[:, i][:, None]
        some = mine & (nodes.have[:, i] > 0)
        always = mine & (nodes.have[:, i] == nodes.rows)
        below, above = nodes.low[:, i] - value, value - nodes.high[:, i]
        gap = np.maximum(np.maximum(below, above), 0.0)
        far = np.maximum(np.abs(below), np.abs(above))
        gap, far = gap * gap, far * far
        least += np.where(always, gap, 0.0)
        most += np.where(always, far, 0.0)
        np.maximum(top, np.where(some, far, 0.0), out=top)
        sure += always
        may += some
    with np.errstate(divide="ignore", invalid="ignore"):
        share = float(n) / may
        lower = np.where(may > 0, np.sqrt(share * least), np.inf)
        same = np.sqrt(share * most)
        # a mean of squares is at most the largest one; rounding is covered by the factor
        mixed = np.sqrt(float(n) * top) * (1 + 1e-9)
    upper = np.where(sure == 0, np.inf, np.where(sure == may, same, mixed))
    return lower, upper


def _wanted_nodes(x, reach, upto, nodes: _Nodes, k: int, probe: bool):
    """Which nodes each row has to look into, with its limits (distance, number) drawn closer.

    With ``probe`` only the nodes that promise the closest ``k`` rows, per feature.
    """
    lower, upper = _bounds(x, nodes)
    keep = np.zeros(lower.shape, bool)
    for f in range(x.shape[1]):
        rows = np.flatnonzero(reach[:, f] > -np.inf)
        if not len(rows):
            continue
        low, high = lower[rows], upper[rows]
        smallest, kth = nodes.first[:, f * k], nodes.first[:, f * k + k - 1]
        full = kth < NO_NUMBER
        if full.any():
            # k rows lie within the greatest distance, with numbers up to the k-th
            nearest = np.where(full, high, np.inf)
            best = nearest.min(axis=1)
            number = np.where(nearest == best[:, None], kth, NO_NUMBER).min(axis=1)
            closer = (best < reach[rows, f]) | ((best == reach[rows, f]) & (number < upto[rows, f]))
            reach[rows, f] = np.where(closer, best, reach[rows, f])
            upto[rows, f] = np.where(closer, number, upto[rows, f])
        limit, last = reach[rows, f][:, None], upto[rows, f][:, None]
        can = (nodes.have[:, f] > 0) & np.isfinite(low) & (
            (low < limit) | ((low == limit) & (smallest <= last)))
        if not probe:
            keep[rows] |= can
            continue
        promise = np.where(can, low + np.where(np.isinf(high), 1e300, high) + np.where(full, 0.0, 1e300), np.inf)
        best = np.argpartition(promise, min(FIRST_LOOK, promise.shape[1]) - 1, axis=1)[:, :FIRST_LOOK]
        where = rows[:, None]
        keep[where, best] |= np.take_along_axis(can, best, axis=1)
    return keep


def _packs(ids, x, reach, upto, nodes: _Nodes, k: int, probe: bool) -> Iterator[pa.RecordBatch]:
    # rows that lie close together want the same nodes
    for part in _cut(x, np.arange(len(ids)), SLICE):
        limits, numbers = reach[part].copy(), upto[part].copy()
        keep = _wanted_nodes(x[part], limits, numbers, nodes, k, probe)
        out = []
        for t in np.flatnonzero(keep.any(axis=0)):
            rows = keep[:, t]
            out.append((int(nodes.node[t]), ids[part][rows].tobytes(), x[part][rows].tobytes(),
                        limits[rows].tobytes(), numbers[rows].tobytes()))
            if len(out) == PACKS:
                yield _pack_batch(out)
                out = []
        if out:
            yield _pack_batch(out)


def _pack_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
        ["node", "ids", "x", "reach", "upto"])


def _unpacked(row: dict, n: int) -> tuple[np.ndarray, ...]:
    return (np.frombuffer(row["ids"], np.int64), np.frombuffer(row["x"]).reshape(-1, n),
            np.frombuffer(row["reach"]).reshape(-1, n), np.frombuffer(row["upto"], np.int64).reshape(-1, n))


def _start(nodes: _Nodes, n: int, k: int, probe: bool):
    def start(batches):
        for batch in batches:
            if batch.num_rows:
                yield from _packs(
                    batch.column("id").to_numpy(), _matrix(batch.column("x"), n),
                    _matrix(batch.column("reach"), n), _matrix(batch.column("upto"), n), nodes, k, probe)

    return start


def _descend(n: int, k: int, probe: bool):
    def descend(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield from _packs(*_unpacked(row, n), _Nodes.from_row(row, n, k), k, probe)

    return descend


def _nearest_in_block(row: dict, n: int, k: int) -> pa.RecordBatch | None:
    ids, x, reach, upto = _unpacked(row, n)
    numbers = np.frombuffer(row["numbers"], np.int64)
    donors = np.frombuffer(row["values"]).reshape(-1, n)
    there = ~np.isnan(donors)
    total = np.zeros((len(x), len(donors)))
    both = np.zeros(total.shape, np.int64)
    for i in range(n):
        step = x[:, i][:, None] - donors[:, i]
        known = ~np.isnan(step)
        total += np.where(known, step * step, 0.0)
        both += known
    with np.errstate(divide="ignore", invalid="ignore"):
        dist = np.where(both > 0, np.sqrt(float(n) / both * total), np.inf)
    out = []
    for f in range(n):
        rows = np.flatnonzero(reach[:, f] > -np.inf)
        have = np.flatnonzero(there[:, f])
        if not len(rows) or not len(have):
            continue
        d, number = dist[rows[:, None], have], numbers[have]
        limit, last = reach[rows, f][:, None], upto[rows, f][:, None]
        take = np.isfinite(d) & ((d < limit) | ((d == limit) & (number <= last)))
        many = np.flatnonzero(take.sum(axis=1) > k)
        if len(many):
            # rows lie by number, so a stable order settles ties
            order = np.argsort(np.where(take[many], d[many], np.inf), axis=1, kind="stable")
            take[many] = False
            take[many[:, None], order[:, :k]] = True
        q, p = np.nonzero(take)
        if len(q):
            out.append((ids[rows[q]], np.full(len(q), f, np.int32), d[q, p], number[p], donors[have[p], f]))
    if not out:
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
        ["id", "feature", "dist", "donor", "value"])


def _visit(n: int, k: int):
    def visit(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                found = _nearest_in_block(batch.slice(i, 1).to_pylist()[0], n, k)
                if found is not None:
                    yield found

    return visit


@dataclass
class DonorIndex:
    """Blocks of rows with all levels of nodes above them; built by :meth:`build`.

    ``blocks`` holds the rows, ``levels`` the nodes from the lowest to the highest level, and
    ``cuts`` the coarse order that searching rows are put into as well.
    """

    width: int
    k: int
    blocks: DataFrame
    levels: list[DataFrame]
    cuts: list

    @classmethod
    def build(cls, donors: DataFrame, width: int, k: int, block_rows: int = BLOCK_ROWS,
              children: int = NODE_CHILDREN, top: int = TOP_NODES, chunk: int = CHUNK_ROWS) -> DonorIndex:
        """Index of ``id, x, mask`` (``x`` an array of ``width`` doubles, null where missing).

        Ties go to the smaller id, so rows are numbered in the order of (id, x) first.
        """
        numbered = stage(
            donors.repartitionByRange("id", "x").sortWithinPartitions("id", "x")
            .select(F.monotonically_increasing_id().alias("number"), "x", "mask"), "numbered")
        gappy = F.instr("mask", "0") > 0
        total, gaps, *have = numbered.agg(F.count(F.lit(1)), F.count_if(gappy), *[
            F.count_if(gappy & (F.substring("mask", i + 1, 1) == "1")) for i in range(width)]).first()
        weight = np.array(have) / gaps if gaps else None
        cuts: list = []
        if total > chunk:
            share = min(1.0, CUT_ROWS / total)
            rows = numbered.where(F.pmod(F.xxhash64("number"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
            sample = _matrix(rows.select("x").toArrow().column("x").combine_chunks(), width)
            cuts = _coarse_cuts(sample, min(COARSE_LEAVES, max(2, total // chunk)), weight)
        laid = (
            with_leaf(numbered, width, cuts).repartitionByRange("mask", "leaf", "number")
            .sortWithinPartitions("mask", "leaf", "number").select("number", "x"))
        blocks = stage(
            laid.mapInArrow(_pack_blocks(width, k, block_rows, chunk, weight),
                            f"numbers binary, values binary, {SUMMARY}")
            .select(F.monotonically_increasing_id().alias("node"), "*"), "blocks")
        levels = []
        below = blocks.select("node", "low", "high", "have", "rows", "first")
        while True:
            size = below.agg(F.count(F.lit(1)), F.max(F.col("node").bitwiseAND((1 << 33) - 1))).first()
            # the last level is one row, whose packed children every search starts from
            last = size[0] <= top
            part, place = F.shiftright("node", 33), F.col("node").bitwiseAND((1 << 33) - 1)
            if last:
                parent = F.lit(0)
            elif size[1]:
                parent = F.shiftleft(part, 33) + F.floor(place / children)
            else:
                parent = F.shiftleft(F.floor(part / children), 33)
            schema = ("node bigint, c_node binary, c_low binary, c_high binary, c_have binary, "
                      f"c_rows binary, c_first binary, {SUMMARY}")
            level = stage(
                below.withColumn("parent", parent.cast("bigint")).groupBy("parent")
                .applyInArrow(_merge_nodes(width, k), schema), "nodes")
            levels.append(level)
            if last:
                return cls(width, k, blocks, levels, cuts)
            below = level.select("node", "low", "high", "have", "rows", "first")

    def nearest(self, rows: DataFrame, start: float | None = None) -> DataFrame:
        """``id, feature, value``: per open feature the mean of the ``k`` nearest rows that have it.

        ``rows`` has ``id`` (bigint, unique), ``x``, ``mask`` and ``open``, the positions asked
        for.  Features that no comparable row has are left out; fewer than ``k`` are averaged.
        A first look at a few blocks a feature gives each row its limits, which decide on the
        blocks that can matter.  With ``start`` rows look within that distance before.
        """
        spark = rows.sparkSession
        top = self.levels[-1].first()
        if top is None:
            return spark.createDataFrame([], "id bigint, feature int, value double")
        # a searching row is short and its search long: the number of tasks must not follow the bytes
        tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        laid = with_leaf(rows, self.width, self.cuts).repartitionByRange(tasks, "mask", "leaf", "id")
        rows = stage(laid.sortWithinPartitions("mask", "leaf", "id").select("id", "x", "open"), "searching")
        nodes = _Nodes.from_row(top.asDict(), self.width, self.k)
        done = None
        if start is not None:
            done = stage(self._best(self._limited(rows, None, start), nodes, False)
                         .where(F.col("n") == self.k).select("id", "feature", "value"), "near")
            closed = done.groupBy("id").agg(F.collect_set("feature").alias("closed"))
            rows = stage(rows.join(closed, "id", "left").select("id", "x", F.when(
                F.col("closed").isNull(), F.col("open")).otherwise(F.array_except("open", "closed")).alias("open"))
                .where(F.size("open") > 0), "searching")
        first = self._best(self._limited(rows, None, None), nodes, True)
        limits = stage(
            first.where(F.col("n") == self.k).groupBy("id").agg(F.map_from_entries(F.collect_list(
                F.struct("feature", F.struct("dist", "donor").alias("limit")))).alias("limits")), "limits")
        found = self._best(self._limited(rows, limits, None), nodes, False).select("id", "feature", "value")
        return found if done is None else done.unionByName(found)

    def _limited(self, rows: DataFrame, limits: DataFrame | None, start: float | None) -> DataFrame:
        """Rows with a limit a feature: minus infinity where it isn't asked for."""
        open_end = F.lit(float("inf") if start is None else start)
        if limits is None:
            limit = lambda f, part: F.lit(None)
        else:
            rows = rows.join(limits, "id", "left")
            limit = lambda f, part: F.col("limits")[f][part]
        reach = [F.when(F.array_contains("open", f), F.coalesce(limit(f, "dist"), open_end))
                 .otherwise(F.lit(float("-inf"))) for f in range(self.width)]
        upto = [F.coalesce(limit(f, "donor"), F.lit(int(NO_NUMBER))).cast("bigint") for f in range(self.width)]
        return rows.select("id", "x", F.array(*reach).alias("reach"), F.array(*upto).alias("upto"))

    def _best(self, limited: DataFrame, top: _Nodes, probe: bool) -> DataFrame:
        """``id, feature, value, n`` and the last neighbour's ``dist, donor``."""
        packs = limited.mapInArrow(_start(top, self.width, self.k, probe), PACK)
        for level in reversed(self.levels[:-1]):
            packs = packs.join(level.select("node", *_Nodes.NAMES), "node").mapInArrow(
                _descend(self.width, self.k, probe), PACK)
        found = packs.join(self.blocks.select("node", "numbers", "values"), "node").mapInArrow(
            _visit(self.width, self.k), FOUND)
        order = Window.partitionBy("id", "feature").orderBy("dist", "donor")
        near = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= self.k)
        held = F.array_sort(F.collect_list(F.struct("dist", "donor", "value")))
        # summed in order, so that every partitioning gives the same mean
        mean = F.aggregate("held", F.lit(0.0), lambda s, h: s + h["value"]) / F.size("held")
        return near.groupBy("id", "feature").agg(held.alias("held")).select(
            "id", "feature", mean.alias("value"), F.size("held").alias("n"),
            F.element_at("held", -1)["dist"].alias("dist"), F.element_at("held", -1)["donor"].alias("donor"))


def with_leaf(df: DataFrame, width: int, cuts: list) -> DataFrame:
    """Adds ``leaf``, the place of ``x`` in the coarse order."""
    if not cuts:
        return df.withColumn("leaf", F.lit(0).cast("bigint"))

    def add(batches):
        for batch in batches:
            leaf = _leaf_of(_matrix(batch.column("x"), width), cuts)
            yield batch.append_column("leaf", pa.array(leaf, pa.int64()))

    return df.mapInArrow(add, df.withColumn("leaf", F.lit(0).cast("bigint")).schema)
