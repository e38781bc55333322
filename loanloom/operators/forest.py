"""Importances of trees that grow until nothing is left to split, none of which is ever held whole.

Values are cut into bins.  Nodes with many rows are split from counts that all tasks add up; once a
node has few enough rows, they meet in a task, which grows the rest below it and returns the gains
alone.  The driver knows the upper nodes: a few per ``few`` drawn rows.  Draws depend on the seed,
the tree, the row's number and the node's place, so ``few`` does not change the trees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.session import stage

#: Drawn rows of a node that one task finishes; rows of a pack; rows that are dealt out together.
FEW = 262_144
PACK_ROWS = 8_192
DEALT_ROWS = 200_000
#: Share of a node's rows that a gain must exceed, above rounding.
LEAST_GAIN = 1e-10

_DRAWS = np.cumsum(np.exp(-1.0) / np.cumprod(np.r_[1.0, np.arange(1.0, 20.0)]))
#: Draws by the first twelve bits of a unit number, 255 where these don't settle it.
_FIRST = np.arange(4097) / 4096
_TABLE = np.searchsorted(_DRAWS, _FIRST[:-1], side="right").astype(np.uint8)
_TABLE[np.searchsorted(_DRAWS, _FIRST[1:], side="left") != _TABLE] = 255
_PACK = "numbers binary, bins binary, classes binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64 bits of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int, tree, number) -> np.ndarray:
    first = np.atleast_1d(tree).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed % 2**63)
    return _mixed(_mixed(first) + np.asarray(number).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


def drawn(seed: int, tree: int, numbers: np.ndarray) -> np.ndarray:
    """How often a tree's bootstrap sample has each row: Poisson numbers with mean 1."""
    keys = _keys(seed, tree, numbers)
    out = _TABLE[keys >> np.uint64(52)]
    open_ = np.flatnonzero(out == 255)
    out[open_] = np.searchsorted(_DRAWS, (keys[open_] >> np.uint64(11)) * 2.0**-53, side="right")
    return out


def _tried(seed: int, tree, place: np.ndarray, width: int, tries: int) -> np.ndarray:
    """The features that each node may be split by, in an order that settles equal gains."""
    if tries == width:
        return np.broadcast_to(np.arange(width), (len(place), width))
    keys = _mixed(_keys(seed + 1, tree, place)[:, None] + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.argsort(keys, axis=1)[:, :tries]


def _best_cut(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gini gain (times rows) and last bin on the left of each node's best cut; ``counts`` by class, node and bin."""
    left = np.cumsum(counts, axis=2)
    total = left[:, :, -1:]
    n = total.sum(axis=0)
    a = left[:, :, :-1].sum(axis=0)
    b = n - a
    score, other = np.zeros_like(a), np.zeros_like(a)
    for own, whole in zip(left[:, :, :-1], total, strict=True):
        score += own * own
        own = whole - own
        other += own * own
    # an empty side adds nothing and leaves the other one the whole node, which is no gain
    score /= np.maximum(a, 1.0, out=a)
    other /= np.maximum(b, 1.0, out=b)
    score += other
    score -= (total**2).sum(axis=0) / np.maximum(n, 1.0)
    best = score.argmax(axis=1)
    gain = score[np.arange(len(best)), best]
    return np.where(gain > LEAST_GAIN * n[:, 0], gain, 0.0), best


@dataclass
class Upper:
    """Upper nodes of all trees, node ``t`` being the root of tree ``t``; ``feature`` is -1 where
    a node is not split.  ``gain`` is that of a node's split; ``says`` is the class that all leaves below
    predict, -1 if they differ."""

    tree: np.ndarray
    place: np.ndarray
    depth: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    says: np.ndarray
    gain: np.ndarray

    @classmethod
    def roots(cls, trees: int) -> Upper:
        none = [np.full(trees, -1) for _ in range(4)]
        return cls(np.arange(trees), np.ones(trees, np.int64), np.zeros(trees, np.int64), *none, np.zeros(trees))

    def add(self, parent: int, feature: int, cut: int, gain: float, says: list[int]) -> int:
        """Split a node; the number of its left child, one below the right one's."""
        first = len(self.tree)
        self.feature[parent], self.cut[parent], self.left[parent], self.gain[parent] = feature, cut, first, gain
        for name, two in [("tree", [self.tree[parent]] * 2), ("depth", [self.depth[parent] + 1] * 2),
                          ("place", [2 * self.place[parent], 2 * self.place[parent] + 1]),
                          ("says", says), ("gain", [0.0, 0.0]), *[(c, [-1, -1]) for c in ("feature", "cut", "left")]]:
            setattr(self, name, np.append(getattr(self, name), two))
        return first

    def prune(self) -> None:
        """Take back splits below which all leaves predict the same class."""
        for node in np.flatnonzero(self.feature >= 0)[::-1]:
            one, other = self.says[self.left[node]:self.left[node] + 2]
            self.says[node] = one if one == other else -1
            if self.says[node] >= 0:
                self.gain[node] = 0.0

    def gains(self, trees: int, width: int) -> np.ndarray:
        split = np.flatnonzero(self.feature >= 0)
        out = np.zeros((trees, width))
        np.add.at(out, (self.tree[split], self.feature[split]), self.gain[split])
        return out

    def way(self, wanted: list[int]) -> Way:
        goal, on = np.zeros(len(self.tree), bool), np.zeros(len(self.tree), bool)
        goal[wanted] = on[wanted] = True
        # children have higher numbers
        for node in np.flatnonzero(self.feature >= 0)[::-1]:
            on[node] |= on[self.left[node]:self.left[node] + 2].any()
        return Way(*(v.tolist() for v in (self.feature, self.cut, self.left, goal, on)), sorted({int(t) for t in self.tree[wanted]}))


@dataclass
class Way:
    """How rows get to some nodes of the upper trees."""

    feature: list[int]
    cut: list[int]
    left: list[int]
    goal: list[bool]
    on: list[bool]
    trees: list[int]

    def rows(self, tree: int, codes: np.ndarray, classes: int, own: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The nodes that are wanted and which of the rows ``own`` are there; see :func:`_codes`."""
        todo = [(tree, own)] if self.on[tree] else []
        while todo:
            node, own = todo.pop()
            if not len(own):
                continue
            if self.goal[node]:
                yield node, own
                continue
            right, first = codes[self.feature[node]][own] >= (self.cut[node] + 1) * classes, self.left[node]
            if self.on[first]:
                todo.append((first, own[~right]))
            if self.on[first + 1]:
                todo.append((first + 1, own[right]))


def _codes(bins: np.ndarray, cls: np.ndarray, classes: int) -> np.ndarray:
    """Bin and class of each row in one number, by feature."""
    return np.ascontiguousarray(bins.T).astype(np.uint16) * np.uint16(classes) + cls


def _packs_of(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for numbers, bins, classes in zip(*(batch.column(c).to_pylist() for c in ("numbers", "bins", "classes")), strict=True):
        yield (np.frombuffer(numbers, np.int64), np.frombuffer(bins, np.uint8).reshape(-1, width),
               np.frombuffer(classes, np.uint8))


def _held(batches, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Packs put together."""
    held, rows = [], 0
    for batch in batches:
        for pack in _packs_of(batch, width):
            held.append(pack)
            rows += len(pack[0])
            if rows >= DEALT_ROWS:
                yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
                held, rows = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


@dataclass
class DeepForest:
    """Trees as deep as ``depth``, split by Gini gain over at most ``bins`` values a feature.

    ``bagged`` trees draw rows with replacement and try ``sqrt(features)`` of the features at
    every node, others take all rows and features.  Gains of all splits count, unless the trees are
    ``pruned``: then those don't below which all leaves predict the same class, as in Spark's trees.
    """

    trees: int
    depth: int = 30
    seed: int = 42
    bagged: bool = True
    bins: int = 32
    few: int = FEW
    pruned: bool = False

    def importances(self, df: DataFrame, vector: str, label: str) -> list[float]:
        """Share of each slot of ``vector`` in the gains, averaged over the trees."""
        rows = stage(df.select(F.monotonically_increasing_id().alias("number"), vector_to_array(vector).alias("x"),
                               F.col(label).cast("int").alias("class")), "forest-rows")
        known = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width"), F.max("class").alias("last")).first()
        if not known["n"]:
            raise ValueError("no rows to grow trees from")
        width, classes = known["width"], known["last"] + 1
        if classes > 256:
            raise ValueError("more than 256 classes")
        tries = int(np.ceil(np.sqrt(width))) if self.bagged else width
        packs = self._binned(rows, width)
        upper, rest = self._upper(packs, known["n"], width, classes, tries)
        lower = self._lower(packs, upper, rest, width, classes, tries)
        if self.pruned:
            for r in lower:
                if r["feature"] < 0:
                    upper.says[r["node"]] = r["says"]
            upper.prune()
        gains = upper.gains(self.trees, width)
        for r in lower:
            if r["feature"] >= 0:
                gains[r["tree"], r["feature"]] += r["gain"]
        sums = gains.sum(axis=1, keepdims=True)
        mean = np.where(sums > 0, gains / np.where(sums > 0, sums, 1.0), 0.0).sum(axis=0)
        return [float(v) for v in mean / (mean.sum() or 1.0)]

    def _cuts(self, rows: DataFrame, width: int) -> list[np.ndarray]:
        """Per feature the values that end a bin: all but the last, or quantiles if there are many."""
        most = self.bins

        def values(batches):
            seen = [np.array([])] * width
            for batch in batches:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                seen = [np.unique(np.r_[s, x[:, i]])[:most + 1] for i, s in enumerate(seen)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(width), [len(s) for s in seen]), pa.int32()), pa.array(np.concatenate(seen))],
                ["feature", "value"])

        few = rows.select("x").mapInArrow(values, "feature int, value double").distinct()
        own = {r["feature"]: sorted(r["v"]) for r in few.groupBy("feature").agg(
            F.slice(F.sort_array(F.collect_list("value")), 1, most + 1).alias("v")).collect()}
        many = [i for i in range(width) if len(own[i]) > most]
        shares = [i / most for i in range(1, most)]
        found = rows.agg(F.lit(0), *[F.percentile_approx(F.col("x")[i], shares, 10_000).alias(f"q{i}") for i in many]).first()
        return [np.unique(found[f"q{i}"]) if i in many else np.array(own[i][:-1]) for i in range(width)]

    def _binned(self, rows: DataFrame, width: int) -> DataFrame:
        cuts = self._cuts(rows, width)

        def pack(batches):
            for batch in batches:
                for a in range(0, batch.num_rows, PACK_ROWS):
                    part = batch.slice(a, PACK_ROWS)
                    x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                    bins = np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)], axis=1).astype(np.uint8)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part.column("number").to_numpy().tobytes()], pa.binary()), pa.array([bins.tobytes()], pa.binary()),
                         pa.array([part.column("class").to_numpy().astype(np.uint8).tobytes()], pa.binary())],
                        ["numbers", "bins", "classes"])

        # all trees work on every row, so few packs are enough for a task
        tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
        return stage(rows.mapInArrow(pack, _PACK).repartition(tasks), "forest-bins")

    def _weights(self, tree: int, numbers: np.ndarray) -> np.ndarray:
        return drawn(self.seed, tree, numbers) if self.bagged else np.ones(len(numbers), np.uint8)

    def _upper(self, packs: DataFrame, total: int, width: int, classes: int, tries: int) -> tuple[Upper, list[int]]:
        """Nodes with more than ``few`` rows, split level by level, and the nodes below that go on."""
        upper = Upper.roots(self.trees)
        level, rest = list(range(self.trees)), []
        if total <= self.few // 2:
            return upper, level
        schema = "node bigint, feature int, cut int, gain double, sides array<array<double>>"
        while level:
            found = packs.mapInArrow(self._counter(upper, level, width, classes, tries), "node bigint, counts binary").groupBy(
                "node").applyInPandas(self._chooser(upper, width, classes, tries), schema).where("gain > 0").collect()
            level = []
            for r in sorted(found, key=lambda r: r["node"]):
                first = upper.add(r["node"], r["feature"], r["cut"], r["gain"], [int(np.argmax(side)) for side in r["sides"]])
                for child, side in enumerate(r["sides"], first):
                    if sum(n > 0 for n in side) > 1 and upper.depth[child] < self.depth:
                        (level if sum(side) > self.few else rest).append(child)
        return upper, rest

    def _counter(self, upper: Upper, level: list[int], width: int, classes: int, tries: int):
        """Counts of classes by tried feature and bin, of all rows of a task together."""
        tried = {n: _tried(self.seed, upper.tree[n], upper.place[n:n + 1], width, tries)[0].tolist() for n in level}
        cells, way, slot = self.bins * classes, upper.way(level), {n: i for i, n in enumerate(level)}

        def count(batches):
            counts = np.zeros((len(level), tries, cells))
            for numbers, bins, cls in _held(batches, width):
                codes = _codes(bins, cls, classes)
                for tree in way.trees:
                    weight = self._weights(tree, numbers)
                    for node, own in way.rows(tree, codes, classes, np.flatnonzero(weight)):
                        several = weight[own].astype(np.float64)
                        for j, feature in enumerate(tried[node]):
                            counts[slot[node], j] += np.bincount(codes[feature][own], several, cells)
            some = np.flatnonzero(counts.any(axis=(1, 2)))
            for a in range(0, len(some), 256):
                part = some[a:a + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([level[i] for i in part], pa.int64()), pa.array([counts[i].tobytes() for i in part], pa.binary())],
                    ["node", "counts"])

        return count

    def _chooser(self, upper: Upper, width: int, classes: int, tries: int):
        def choose(pdf: pd.DataFrame) -> pd.DataFrame:
            node = int(pdf["node"].iloc[0])
            counts = sum(np.frombuffer(c).reshape(tries, self.bins, classes) for c in pdf["counts"])
            tried = _tried(self.seed, upper.tree[node], upper.place[node:node + 1], width, tries)[0]
            gain, cut = _best_cut(np.ascontiguousarray(counts.transpose(2, 0, 1)))
            j = int(gain.argmax())
            left = counts[j, :cut[j] + 1].sum(axis=0)
            sides = [left.tolist(), (counts[j].sum(axis=0) - left).tolist()]
            return pd.DataFrame({"node": [node], "feature": [int(tried[j])], "cut": [int(cut[j])], "gain": [float(gain[j])],
                                 "sides": [sides]})

        return choose

    def _lower(self, packs: DataFrame, upper: Upper, rest: list[int], width: int, classes: int, tries: int) -> list:
        """``tree, feature, gain``: what the nodes below the upper ones gain.

        For ``pruned`` trees by ``node``, with a row of feature -1 that ``says`` what all leaves predict.
        """
        if not rest:
            return []
        way, pruned = upper.way(rest), self.pruned

        def deal(batches):
            for numbers, bins, cls in _held(batches, width):
                codes = _codes(bins, cls, classes)
                for tree in way.trees:
                    weight = self._weights(tree, numbers)
                    parts = list(way.rows(tree, codes, classes, np.flatnonzero(weight)))
                    if parts:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([node for node, _ in parts], pa.int64()),
                             *[pa.array([v[p].tobytes() for _, p in parts], pa.binary()) for v in (bins, cls, weight)]],
                            ["node", "bins", "classes", "weights"])

        def grow(table: pa.Table) -> pa.Table:
            node = table.column("node")[0].as_py()
            bins, cls, weight = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint8) for c in ("bins", "classes", "weights"))
            gains, says = self._grown(bins.reshape(-1, width), cls, weight, int(upper.tree[node]), int(upper.place[node]),
                                      int(upper.depth[node]), classes, tries)
            some = np.flatnonzero(gains)
            found = [{"node": node, "tree": int(upper.tree[node]), "feature": int(f), "gain": float(gains[f]), "says": None} for f in some]
            if pruned:
                found.append({"node": node, "tree": int(upper.tree[node]), "feature": -1, "gain": 0.0, "says": says})
            return pa.Table.from_pylist(found, pa.schema([
                ("node", pa.int64()), ("tree", pa.int32()), ("feature", pa.int32()), ("gain", pa.float64()), ("says", pa.int32())]))

        grown = packs.mapInArrow(deal, "node bigint, bins binary, classes binary, weights binary").groupBy("node").applyInArrow(
            grow, "node bigint, tree int, feature int, gain double, says int")
        return grown.collect() if pruned else grown.groupBy("tree", "feature").agg(F.sum("gain").alias("gain")).collect()

    def _grown(self, bins: np.ndarray, cls: np.ndarray, weight: np.ndarray, tree: int, place: int, depth: int,
               classes: int, tries: int) -> tuple[np.ndarray, int]:
        """Gains by feature of all splits below a node, from its rows; for ``pruned`` trees also what all its
        leaves predict, -1 if they differ."""
        gains, places, at = np.zeros(bins.shape[1]), np.array([place]), np.zeros(len(bins), np.int64)
        flat, width = np.ascontiguousarray(bins).ravel(), bins.shape[1]
        row, cls, weight = np.arange(len(bins)) * width, cls.astype(np.int64), weight.astype(np.float64)
        levels, own = [], int(np.bincount(cls, weight, classes).argmax())
        while len(row) and depth < self.depth:
            k = len(places)
            tried = _tried(self.seed, tree, places, width, tries)
            best, feature, cut = np.zeros(k), np.zeros(k, np.int64), np.zeros(k, np.int64)
            base = (cls * k + at) * self.bins
            for j in range(tries):
                cell = base + flat[row + tried[:, j][at]]
                gain, last = _best_cut(np.bincount(cell, weight, k * self.bins * classes).reshape(classes, k, self.bins))
                better = gain > best
                best, cut, feature = np.where(better, gain, best), np.where(better, last, cut), np.where(better, tried[:, j], feature)
            going = np.flatnonzero(best[at] > 0)
            at, row, cls, weight = at[going], row[going], cls[going], weight[going]
            child = 2 * at + (flat[row + feature[at]] > cut[at])
            # a node of one class is done
            by_class = np.bincount(child * classes + cls, weight, 2 * k * classes).reshape(-1, classes)
            mixed = (by_class > 0).sum(axis=1) > 1
            if self.pruned:
                levels.append((best, feature, by_class.argmax(axis=1), mixed))
            else:
                gains += np.bincount(feature, best, width)
            still = mixed[child]
            at = (np.cumsum(mixed) - 1)[child[still]]
            row, cls, weight, depth = row[still], cls[still], weight[still], depth + 1
            places = np.stack([2 * places, 2 * places + 1], axis=1).ravel()[mixed]
        below = None
        for best, feature, leaf, mixed in reversed(levels):
            says = leaf.copy()
            if below is not None:
                split, said = below
                says[np.flatnonzero(mixed)[split]] = said[split]
            one, other = says[0::2], says[1::2]
            same = (one == other) & (one >= 0)
            gains += np.bincount(feature, np.where(same, 0.0, best), width)
            below = best > 0, np.where(same, one, -1)
        return gains, int(below[1][0]) if below is not None and below[0][0] else own
