import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from loanloom.operators import donors, impute, stages
from tests.test_impute_encode import brute

NAMES = ["a", "b", "c", "d"]
SCHEMA = "id bigint, a double, b double, c double, d double"
#: Blocks, nodes and chunks so small that a few hundred rows make several levels.
SMALL = {"block_rows": 8, "children": 3, "top": 4, "chunk": 60}


def filled(spark, rows, queries, k=3, start=None, **sizes):
    columns = lambda some: [(r["id"], *[r[f] for f in NAMES]) for r in some]
    train = spark.createDataFrame(columns(rows), SCHEMA)
    model = impute.NeighbourImputer(NAMES, "id", k=k, start_radius=start).fit(train.limit(0) if not rows else train)
    model.index = donors.DonorIndex.build(
        impute._vectors(train, NAMES, "id").where(F.instr("mask", "1") > 0), len(NAMES), k, **sizes)
    got = model.transform(spark.createDataFrame(columns(queries), SCHEMA)).collect()
    return {r["id"]: r for r in got}, model


def gappy(kind, count=300):
    rng = random.Random(kind)
    rows = []
    for i in range(count):
        values = {f: rng.gauss(0, 10 ** j) for j, f in enumerate(NAMES)}
        if kind == "copies" and i % 3:
            # two in three rows are equal, and many more are told apart by one feature only
            values = {"a": 1.0, "b": 2.0, "c": 3.0, "d": float(i % 3)}
        if kind == "whole":
            values = {f: float(rng.randrange(4)) for f in NAMES}
        gap = 0.6 if kind == "sparse" else 0.25
        rows.append({"id": i, **{f: None if rng.random() < gap else v for f, v in values.items()}})
    return rows


@pytest.mark.parametrize("kind", ["spread", "copies", "sparse", "whole"])
def test_levels_equal_all_pairs(spark, kind):
    rows = gappy(kind)
    got, model = filled(spark, rows, rows, **SMALL)
    assert len(model.index.levels) > 1 and model.index.cuts
    for (i, f), value in brute(rows, rows, NAMES, 3).items():
        assert got[i][f] == pytest.approx(value), (i, f)


def test_empty_and_strange_rows(spark):
    rows = gappy("spread", 40)
    odd = [
        {"id": None, "a": 1.0, "b": None, "c": None, "d": None},
        {"id": 7, "a": None, "b": None, "c": None, "d": None},
        {"id": 8, "a": float("nan"), "b": 0.0, "c": float("inf"), "d": None},
    ]
    got, model = filled(spark, rows, odd, **SMALL)
    plain = [{"id": 8, "a": None, "b": 0.0, "c": None, "d": None}, {**odd[0], "id": 9}]
    want = brute(rows, plain, NAMES, 3)
    assert got[7]["a"] == pytest.approx(model.means[0])
    assert got[8]["a"] == pytest.approx(want[8, "a"]) and got[8]["c"] == float("inf")
    assert got[None]["b"] == pytest.approx(want[9, "b"])
    none, _ = filled(spark, [], odd[:1], **SMALL)
    assert tuple(none[None]) == (None, 1.0, None, None, None)


def test_infinite_donors_are_left_out(spark):
    rows = gappy("spread", 40)
    with_inf = [*rows, {"id": 99, "a": 0.0, "b": float("inf"), "c": 0.0, "d": None}]
    without = [*rows, {"id": 99, "a": 0.0, "b": None, "c": 0.0, "d": None}]
    query = [{"id": 1, "a": 0.0, "b": None, "c": 0.0, "d": None}]
    assert filled(spark, with_inf, query)[0] == filled(spark, without, query)[0]


def test_bounds_hold_for_every_row():
    rng = np.random.default_rng(5)
    n, k = 5, 2
    for trial in range(30):
        block = rng.integers(-3, 4, (12, n)).astype(float)
        block[rng.random(block.shape) < 0.1 * (trial % 5)] = np.nan
        x = rng.integers(-5, 6, (20, n)).astype(float) / 3
        x[rng.random(x.shape) < 0.4] = np.nan
        low, high, have, rows, first = donors._summary(block, np.arange(12), k)
        node = donors._Nodes(np.array([0]), low[None], high[None], have[None], np.array([rows]), first[None])
        lower, upper = donors._bounds(x, node)
        for q in range(len(x)):
            for d in block:
                total, both = 0.0, 0
                for i in range(n):
                    step = (x[q, i] - d[i]) ** 2
                    if not np.isnan(step):
                        total, both = total + step, both + 1
                if both:
                    dist = np.sqrt(float(n) / both * total)
                    assert lower[q, 0] <= dist <= upper[q, 0]
                else:
                    assert upper[q, 0] == np.inf


def test_order_cuts_every_row_once():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 3))
    x[rng.random(x.shape) < 0.2] = np.nan
    x = x[np.lexsort(np.isnan(x).T)]
    blocks = list(donors._blocks_of(x, 16))
    assert sorted(np.concatenate(blocks)) == list(range(500)) and max(map(len, blocks)) <= 16
    cuts = donors._coarse_cuts(x, 8)
    leaf = donors._leaf_of(x, cuts)
    assert len(cuts) == 7 and set(leaf) == set(range(8))
    assert not donors._leaf_of(np.ones((4, 3)), donors._coarse_cuts(np.ones((9, 3)), 4)).any()


def test_blocks_are_cut_by_what_searching_rows_have(spark):
    rng = random.Random(9)
    rows = [{"id": i, "a": rng.uniform(0, 1), "b": 0.0, "c": 1.0, "d": rng.uniform(0, 1000)} for i in range(400)]
    gaps = [{**r, "id": 400 + r["id"], "d": None} for r in rows[:40]]
    got, model = filled(spark, [*rows, *gaps], gaps, **SMALL)
    assert all(got[i]["d"] == pytest.approx(v) for (i, f), v in brute([*rows, *gaps], gaps, NAMES, 3).items())
    # d is wider, but no row with a gap has it
    whole = model.index.blocks.where(F.col("have")[3] == F.col("rows"))
    assert whole.agg(F.max(F.col("high")[0] - F.col("low")[0])).first()[0] < 0.2


def test_stored_index_finds_the_same(spark, tmp_path):
    rows = gappy("spread")
    got, model = filled(spark, rows, rows, **SMALL)
    PipelineModel([stages.NeighbourFill(model)]).write().save(f"{tmp_path}/fill")
    again = PipelineModel.load(f"{tmp_path}/fill").stages[0].model
    assert len(again.index.levels) == len(model.index.levels)
    table = spark.createDataFrame([(r["id"], *[r[f] for f in NAMES]) for r in rows], SCHEMA)
    assert {r["id"]: r for r in again.transform(table).collect()} == got
