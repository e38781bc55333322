import random

import pytest
from pyspark.sql import functions as F

from loanloom.functions import tails
from loanloom.operators import resampling, stats
from loanloom.operators.rank import class_histogram


def groups(frame, zero, one):
    return frame([(float(v), 0) for v in zero] + [(float(v), 1) for v in one], "x double, y int")


@pytest.mark.parametrize("zero,one,delta", [
    ([3, 4, 5], [1, 2], 1.0), ([1, 2], [3, 4, 5], -1.0), ([1, 2, 3], [1, 2, 3], 0.0),
    ([1, 3, 5], [2, 4, 6], -1 / 3), ([], [1.0], None)])
def test_delta(frame, zero, one, delta):
    got = stats.calculate_cliff_delta(groups(frame, zero, one), "x", "y")
    assert got is None if delta is None else got == pytest.approx(delta)


def test_rank_statistics_against_all_pairs(spark):
    rng = random.Random(3)
    rows = [(float(rng.choice([1, 1, 1, rng.randint(0, 50)])), rng.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "x double, y int")
    got = stats.rank_statistics(df, ["x"], "y", ranges=4).first()
    a = [v for v, y in rows if y == 0]
    b = [v for v, y in rows if y == 1]
    assert got["u"] == sum((p > q) + 0.5 * (p == q) for p in a for q in b)
    counts = {v: [x for x, _ in rows].count(v) for v, _ in rows}
    assert got["tie_term"] == sum(c**3 - c for c in counts.values())


@pytest.fixture()
def mixed(frame):
    rows = list(zip(range(1, 11), "ABCABCABCA", [0, 1] * 5, strict=True))
    return frame(rows, "numeric_feature int, categorical_feature string, target int")


def test_small_analysis(mixed):
    got = {r.feature: r for r in stats.run_statistical_analysis(
        mixed, ["numeric_feature", "categorical_feature"], "target", replicates=50).collect()}
    number, text = got["numeric_feature"], got["categorical_feature"]
    assert number.p_value == pytest.approx(0.6904761904761905)
    assert number.ci_low <= number.effect_size <= number.ci_high
    assert (text.p_value, text.effect_size, text.test) == (1.0, 0.0, "chi2")
    again = {r.feature: r for r in stats.run_statistical_analysis(
        mixed.repartition(3), ["numeric_feature", "categorical_feature"], "target", replicates=50).collect()}
    assert again["numeric_feature"].ci_low == number.ci_low


def test_table_without_pooling(mixed):
    cells = stats.category_counts(mixed, ["categorical_feature"], "target")
    r = stats.table_statistics(cells).first()
    assert r["n"] == 10 and r["chi2"] == pytest.approx(r["chi2_plain"])


def test_two_by_two_is_corrected(frame):
    rows = [("a", 0)] * 10 + [("a", 1)] * 20 + [("b", 0)] * 30 + [("b", 1)] * 40
    df = frame(rows, "x string, y int")
    r = stats.chi_square(df, "x", "y").first()
    assert r["chi2"] == pytest.approx(0.4464285714)
    assert r["cramers_v"] == pytest.approx(0.0668153105)
    one = stats.table_statistics(stats.category_counts(df, ["x"], "y")).first()
    assert one["chi2"] == pytest.approx(0.4464285714) and one["chi2_plain"] == pytest.approx(0.7936507937)


def test_perfect_association(frame):
    df = frame([("a", "x"), ("a", "x"), ("b", "y"), ("b", "y"), ("c", "z")], "x string, y string")
    assert stats.calculate_cramers_v(df, "x", "y") == pytest.approx(1.0)


def test_pooling_many_categories(frame):
    rows = [(f"c{i:02d}", j % 2) for i in range(12) for j in range(i + 1)] + [(None, 0)]
    cells = {r.category: r.n0 + r.n1 for r in stats.pool_rare(
        stats.category_counts(frame(rows, "x string, y int"), ["x"], "y")).collect()}
    assert len(cells) == 10 and cells["Other"] == 1 + 2 + 3 + 1 and cells["c11"] == 12


def test_pooling_rare(frame):
    rows = [("big", i % 2) for i in range(20)] + [("rare", 1)] * 4 + [(None, 1)]
    cells = {r.category: r.n0 + r.n1 for r in stats.pool_rare(
        stats.category_counts(frame(rows, "x string, y int"), ["x"], "y")).collect()}
    assert cells == {"big": 20, "Other": 4}


@pytest.mark.parametrize("cells,test", [
    ([("a", 10, 0), ("b", 9, 7)], "chi2_simulated"), ([("a", 2, 3), ("b", 4, 9)], "fisher"),
    ([("a", 30, 40), ("b", 50, 60)], "chi2"), ([("a", 1, 1), ("b", 1, 9000), ("c", 9, 90)], "chi2_simulated")])
def test_choice_of_test(frame, cells, test):
    df = frame([("f", *c) for c in cells], "feature string, category string, n0 bigint, n1 bigint")
    assert stats.table_statistics(df).first()["test"] == test


def test_target_rules(frame):
    df = frame([("2", 1.0), ("7", 2.0), ("7", 3.0)], "t string, x double")
    codes = [r[0] for r in df.select(stats.binary_target(df, "t")).collect()]
    assert codes == [0, 1, 1]
    for bad in ([("a", 1.0), ("b", 2.0)], [("1", 1.0)], [("1", 1.0), ("2", 1.0), ("3", 1.0)],
                [("0", 1.0), (None, 2.0)]):
        with pytest.raises(ValueError):
            stats.binary_target(frame(bad, "t string, x double"), "t")
    with pytest.raises(KeyError):
        stats.run_statistical_analysis(df, ["nothing"], "t")


def test_bootstrap_matches_direct_resampling(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    a, b = rng.normal(0, 1, 150).round(1), rng.normal(0.5, 1, 120).round(1)
    df = spark.createDataFrame([(float(v), 0) for v in a] + [(float(v), 1) for v in b], "x double, y int")
    got = resampling.bootstrap_replicates(class_histogram(df, ["x"], "y", ranges=6), 400, 1).toPandas()

    def delta(p, q):
        return (np.sign(p[:, None] - q[None, :])).mean()

    direct = [delta(rng.choice(a, len(a)), rng.choice(b, len(b))) for _ in range(400)]
    assert got["delta"].mean() == pytest.approx(delta(a, b), abs=0.02)
    assert got["delta"].std() == pytest.approx(np.std(direct), rel=0.2)


def test_simulated_tables(spark):
    strong, none = [[90, 10], [10, 90]], [[50, 50], [50, 50]]
    got = {r.feature: r for r in resampling.resample_tables(
        spark, {"s": strong, "n": none}, 500, 3, "independence").collect()}
    assert got["s"].p_value == 0.0 and got["n"].p_value == 1.0
    same = {r.feature: r for r in resampling.resample_tables(
        spark, {"n": none, "s": strong}, 500, 3, "independence").collect()}
    assert same["s"].ci_low == got["s"].ci_low
    with pytest.raises(ValueError):
        resampling.resample_tables(spark, {"z": [[0, 0], [0, 0]]}, 10)


def test_bootstrap_does_not_follow_the_ranges(spark):
    df = spark.range(400).select((F.col("id") * 37 % 101 / 10).alias("x"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    results = []
    for ranges, partitions in ((1, 1), (5, 7), (40, 64)):
        hist = class_histogram(df.repartition(partitions), ["x"], "y", ranges=ranges)
        results.append(sorted(map(tuple, resampling.bootstrap_replicates(hist, 50, 9).collect())))
    assert results[0] == results[1] == results[2]


def test_bootstrap_draws_whole_classes(spark, monkeypatch):
    """Class sizes in every replicate, also down a tree of many levels, and the draws' mean and variance."""
    import numpy as np

    monkeypatch.setattr(resampling, "LEAF", 3)
    monkeypatch.setattr(resampling, "FAN", 2)
    df = spark.range(500).select(
        F.when(F.col("id") % 11 > 0, F.col("id") * 37 % 101 / 10).alias("x"), F.lit(1.5).alias("same"),
        (F.col("id") % 3 == 0).cast("int").alias("y"))
    results = []
    for ranges in (1, 9):
        hist = class_histogram(df, ["x", "same"], "y", ranges=ranges)
        results.append(sorted(map(tuple, resampling.bootstrap_replicates(hist, 200, 5).collect())))
    assert results[0] == results[1] and len(results[0]) == 400
    sizes = {tuple(r) for r in df.where("x is not null").groupBy("y").count().collect()}
    assert {(0, r[2]) for r in results[0] if r[0] == "x"} | {(1, r[3]) for r in results[0] if r[0] == "x"} == sizes
    assert all(r[2:] == (333, 167, 0.0) for r in results[0] if r[0] == "same")
    values = df.where("x is not null").toPandas()
    a, b = (np.sort(values[values.y == c].x.to_numpy()) for c in (0, 1))
    rng = np.random.default_rng(1)
    direct = [np.sign(rng.choice(a, len(a))[:, None] - rng.choice(b, len(b))[None]).mean() for _ in range(400)]
    got = [r[4] for r in results[0] if r[0] == "x"]
    assert np.mean(got) == pytest.approx(np.mean(direct), abs=0.02) and np.std(got) == pytest.approx(np.std(direct), rel=0.25)


def test_bootstrap_counts_the_table_once(spark, monkeypatch):
    monkeypatch.setattr(resampling, "LEAF", 3)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(v):
        seen.add(1)
        return v

    df = spark.range(300).select(
        counted(F.col("id") % 101 / 10.0).alias("x"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    hist = class_histogram(df, ["x"], "y", ranges=6)
    start = seen.value
    hist.collect()
    once = seen.value - start
    assert resampling.bootstrap_replicates(hist, 20, 5).count() == 20
    assert once >= 300 and seen.value - start == 2 * once


def test_exact_tail_for_small_and_large_groups():
    from collections import Counter
    from itertools import combinations

    for n1, n2 in ((1, 6), (2, 7), (3, 6), (5, 4)):
        counts = Counter(sum(c) - n1 * (n1 - 1) // 2 for c in combinations(range(n1 + n2), n1))
        for u in range(n1 * n2 + 1):
            tail = sum(v for k, v in counts.items() if k >= max(u, n1 * n2 - u))
            assert tails.mann_whitney_exact(u, n1, n2) == pytest.approx(min(1, 2 * tail / counts.total()))
    # two values, three steps from the end: 6 of all pairs on either side
    for n in (900, 999, 10**6):
        assert tails.mann_whitney_p(3, 2, n, 0) == pytest.approx(12 / ((n + 2) * (n + 1) / 2))


def test_chi_square_beyond_a_thousand_levels(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 1200, 6000), rng.integers(0, 1300, 6000)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), strict=True)), "x int, y int")
    table = np.zeros((1200, 1300))
    np.add.at(table, (x, y), 1)
    table = table[table.sum(1) > 0][:, table.sum(0) > 0]
    expected = table.sum(1)[:, None] * table.sum(0) / 6000
    got = stats.chi_square(df, "x", "y").first()
    assert got["chi2"] == pytest.approx(((table - expected) ** 2 / expected).sum())
    assert (got["n_rows"], got["n_columns"], got["n"]) == (*table.shape, 6000)
