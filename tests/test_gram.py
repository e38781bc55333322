"""Pairwise moments against pandas and plain sums."""

import math

import numpy as np
import pandas as pd
import pytest

from loanloom.operators import gram, quality, summary


def matrix(df, names):
    return {(r.x, r.y): r.r for r in summary.correlation_matrix(df, names).collect()}


def table(rng, rows, columns):
    values = rng.normal(size=(rows, columns)) @ rng.normal(size=(columns, columns))
    values[rng.random(values.shape) < 0.2] = np.nan
    return pd.DataFrame(values, columns=[f"c{i}" for i in range(columns)])


@pytest.mark.parametrize("partitions", [1, 3, 70])
def test_pairwise_complete(spark, partitions):
    rng = np.random.default_rng(3)
    wide = table(rng, 400, 12)
    wide["c0"] += 1e9
    wide["c1"] = wide["c1"] * 1e-6 + 1e5
    wide["same"] = 0.1
    wide["gone"] = np.nan
    wide["rare"] = np.where(np.arange(400) == 7, 1.0, np.nan)
    names = list(wide.columns)
    # near values subtract without rounding, so this leaves the correlations as they are
    want = (wide - wide.iloc[0].fillna(wide.median())).corr(min_periods=2)
    got = matrix(spark.createDataFrame(wide).repartition(partitions), names)
    assert len(got) == len(names) ** 2
    for x in names:
        for y in names:
            if {x, y} & {"same", "gone", "rare"}:
                assert got[x, y] is None, (x, y)
            else:
                assert got[x, y] == pytest.approx(want.loc[x, y], abs=1e-9)
            assert got[x, y] == pytest.approx(got[y, x], abs=1e-12) if got[x, y] is not None else got[y, x] is None


def test_constant_where_the_other_side_is_there(spark):
    # x varies, but is the same wherever y is there
    rows = [(0.1 + 0.2, float(i)) for i in range(9)] + [(1e7 * i, None) for i in range(1, 5)]
    got = matrix(spark.createDataFrame(rows, "x double, y double").repartition(3), ["x", "y"])
    assert got["x", "y"] is None and got["y", "x"] is None and got["x", "x"] == pytest.approx(1.0)


def test_infinite_nulls_and_empty(spark):
    rows = [(1.0, 2.0, None), (math.inf, 3.0, 4.0), (2.0, 5.0, 1.0), (3.0, None, 2.0)]
    df = spark.createDataFrame(rows, "x double, y double, `odd name` double")
    got = {(r.x, r.y): (r.n, r.r) for r in gram.pair_correlations(df, ["x", "odd name"], ["y"]).collect()}
    assert got["x", "y"][0] == 3 and math.isnan(got["x", "y"][1])
    assert got["odd name", "y"] == (2, pytest.approx(-1.0))
    assert summary.correlation_matrix(df.limit(0), ["x", "y"]).count() == 0
    assert quality.target_correlations(df.limit(0), ["x"], "y") == {"x": 0.0}
    assert quality.target_correlations(df, [], "y") == {}
    assert gram.pair_correlations(df, [], ["y"]).count() == 0


def test_merge_is_the_whole():
    rng = np.random.default_rng(5)
    values = table(rng, 90, 4).to_numpy() + 1e6
    whole = gram.batch_moments(values, values)
    parts = [gram.batch_moments(v, v) for v in (values[:1], values[1:40], values[40:])]
    total = parts[0]
    for part in parts[1:]:
        total = gram.merged(total, part)
    for found in (total, whole):
        found[4:6] += found[2:4]
    assert np.allclose(total[[0, 1, 4, 5, 6, 7, 8]], whole[[0, 1, 4, 5, 6, 7, 8]], rtol=1e-9, atol=1e-9)


def test_one_scan(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(20).selectExpr(*[f"cast(id * {i} % 7 as double) c{i}" for i in range(40)]).write.parquet(path)
    df = spark.read.parquet(path)
    plan = summary.correlation_matrix(df, df.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1
