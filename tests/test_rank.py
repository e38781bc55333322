import math
import random
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanloom.operators import rank, sampling
from loanloom.operators.quantiles import bin_numeric_into_quantiles, exact_quantiles, fit_quantile_bins


def test_narrowing_equals_sorting(spark):
    rng = random.Random(7)
    # a third of the rows share one value
    rows = [(5.0 if i % 3 == 0 else rng.gauss(0, 100), float(i) if i % 5 else None) for i in range(6000)]
    df = spark.createDataFrame(rows, "a double, b double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, ["a", "b"], probs, direct_rows=50, grid=8)
    for name, values in zip("ab", zip(*rows, strict=True), strict=True):
        clean = [v for v in values if v is not None]
        assert got[name] == pytest.approx(list(np.quantile(clean, probs)))
    assert got == exact_quantiles(df, ["a", "b"], probs)


def test_infinite_quantiles_on_both_paths(frame):
    rows = [(float(v),) for v in range(40)] + [(math.inf,)] * 9 + [(-math.inf,)] * 5 + [(3.0,)] * 30
    df = frame(rows, "x double")
    probs = [0.0, 0.02, 0.05, 0.06, 0.3, 0.5, 0.88, 0.895, 0.9, 1.0]
    narrowed = exact_quantiles(df, ["x"], probs, direct_rows=10, grid=4)["x"]
    assert narrowed == exact_quantiles(df, ["x"], probs)["x"]
    assert narrowed[0] == -math.inf and narrowed[-1] == math.inf and math.isfinite(narrowed[4])


def test_largest_doubles_stay_finite(frame):
    most = sys.float_info.max
    df = frame([(float(v),) for v in range(45)] + [(most,)] * 9 + [(math.inf,)] * 4 + [(-most,)] * 6 + [(-math.inf,)], "x double")
    probs = [i / 64 for i in range(65)]
    narrowed = exact_quantiles(df, ["x"], probs, direct_rows=5, grid=4)["x"]
    assert narrowed == sorted(df.toPandas()["x"])


def test_ranges_inside_ranges(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(3.0 if i % 3 == 0 else math.exp(rng.gauss(0, 4)), rng.choice([None, math.inf, -math.inf, 0.0, -0.0, math.nan, 1.5]),
             7.0, i % 2, rng.choice([0.1, 0.5, rng.random()])) for i in range(6000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int, p double")
    names = ["a", "b", "c"]
    ranks, parts = rank.average_ranks(df, names), rank.roc_points(df, ["p"], "y").collect()
    monkeypatch.setattr(rank, "COARSE_RANGES", 5)
    for wanted in (6, 40, 100):
        hist = rank.value_histogram(df, names, {"n": F.lit(1)}, wanted)
        assert sorted(map(str, rank.average_ranks(df, names, wanted).collect())) == sorted(map(str, ranks.collect()))
        spans = hist.groupBy("feature", "part").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n"))
        for name in names:
            cut = [(r.lo, r.hi) for r in spans.where(F.col("feature") == name).orderBy("part").collect()]
            assert all(a[1] < b[0] for a, b in zip(cut, cut[1:], strict=False))
        most = spans.where("feature = 'a'").agg(F.max("n")).first()[0]
        assert most <= 3 * 4001 / wanted + 5
    monkeypatch.setattr(rank, "ranges_for", lambda _: 60)
    assert sorted(map(str, rank.roc_points(df, ["p"], "y").collect())) == sorted(map(str, parts))


def test_quantiles_of_nothing(frame):
    df = frame([(None, math.nan)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [None]}


@pytest.mark.parametrize("values,bins,expected", [
    ([50000, 60000, 70000, 80000, 90000], 3, ["Q1", "Q1", "Q2", "Q3", "Q3"]),
    (list(range(1, 11)), 5, ["Q1", "Q1", "Q2", "Q2", "Q3", "Q3", "Q4", "Q4", "Q5", "Q5"]),
    ([4, 4, None], 5, ["Q1", "Q1", "Q1"]),
])
def test_quantile_bins(frame, values, bins, expected):
    df = frame([(i, v) for i, v in enumerate(values)], "i int, x int")
    got = df.select("i", bin_numeric_into_quantiles(df, "x", bins).alias("q")).orderBy("i").collect()
    assert [r.q for r in got] == expected


def test_repeated_edges(frame):
    df = frame([(v,) for v in [1] * 8 + [2, 3]], "x int")
    with pytest.raises(ValueError):
        fit_quantile_bins(df, ["x"], 5)
    assert fit_quantile_bins(df, ["x"], 5, duplicates="merge")["x"].edges[0] == 1


def test_average_ranks(frame):
    values = [3.0, 1.0, 2.0, 2.0, None, math.nan, 5.0, 2.0]
    df = frame([(v,) for v in values], "x double")
    got = {r.value: r.avg_rank for r in rank.average_ranks(df, ["x"], ranges=3).collect()}
    clean = pd.Series([v for v in values if v is not None and not math.isnan(v)])
    assert got == dict(zip(clean, clean.rank(), strict=True))


def test_curves_with_hot_score(spark):
    rng = random.Random(1)
    rows = [(0.5 if i % 3 else rng.random(), rng.randint(0, 1)) for i in range(900)]
    df = spark.createDataFrame(rows, "p double, y int")
    area = rank.auc(df, ["p"], "y", ranges=5).first()["auc"]
    pos = [p for p, y in rows if y]
    neg = [p for p, y in rows if not y]
    brute = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert area == pytest.approx(brute)
    points = sorted((r.fpr, r.tpr) for r in rank.roc_points(df, ["p"], "y", 5).collect())
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    trapezoid = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:], strict=False))
    assert trapezoid == pytest.approx(brute)
    closing = rank.pr_points(df, ["p"], "y", 5).where("threshold is null").first()
    assert (closing.precision, closing.recall) == (1.0, 0.0)


def test_adjusted_p(frame):
    df = frame([("a", 0.01), ("b", 0.04), ("c", 0.03), ("d", 0.005), ("e", None)], "feature string, p_value double")
    got = {r.feature: r.corrected_p_value for r in rank.adjust_p_values(df).collect()}
    assert got == pytest.approx({"a": 0.02, "b": 0.04, "c": 0.04, "d": 0.02})


def _ids(spark, n):
    return spark.range(n).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"))


def test_sample_sizes_and_narrow_cuts(spark):
    df = _ids(spark, 1000)
    direct = sampling.create_stratified_sample(df, "y", 100, "id")
    narrow = sampling.create_stratified_sample(df, "y", 100, "id", cut_rows=1)
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, narrow.collect()))
    assert {r["y"]: r["count"] for r in direct.groupBy("y").count().collect()} == {0: 67, 1: 33}
    shuffled = sampling.create_stratified_sample(df.repartition(7), "y", 100, "id")
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, shuffled.collect()))


def test_sample_errors(spark):
    df = _ids(spark, 10)
    with pytest.raises(ValueError):
        sampling.create_stratified_sample(df, "nothing", 5, "id")
    with pytest.raises(ValueError):
        sampling.create_stratified_sample(df, "y", 11, "id")


def test_half_even(spark):
    halves = spark.createDataFrame([(2.5,), (0.5,), (3.5,)], "x double")
    assert [r[0] for r in halves.select(sampling.half_even(F.col("x"))).collect()] == [2, 0, 4]


def test_split_shares(spark):
    df = sampling.stratified_split(_ids(spark, 1000), "y", "id")
    got = {(r.split, r.y): r["count"] for r in df.groupBy("split", "y").count().collect()}
    assert got == {("test", 0): 133, ("test", 1): 67, ("validation", 0): 133,
                   ("validation", 1): 67, ("train", 0): 400, ("train", 1): 200}
