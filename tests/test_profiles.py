"""Stored profiles: parts against their union, replaced files, odd columns."""

import math
import random

import pytest
from pyspark.sql import functions as F

from loanloom.operators import profiles


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    rng = random.Random(8)
    folder = str(tmp_path_factory.mktemp("days") / "rows")
    rows = [(day, rng.choice([None, math.nan, rng.gauss(1e8 * (day + 1), 3.0)]), rng.randrange(5000), rng.choice(["a", "b", None]),
             None) for day in range(3) for _ in range(4000)]
    df = spark.createDataFrame(rows, "day int, x double, k int, word string, gone double")
    df.repartition(1, "day").write.partitionBy("day").parquet(folder)
    return df, spark.read.parquet(folder)


COLUMNS = ["x", "k", "word", "gone"]


def test_union_of_parts(parts):
    df, stored = parts
    merged = profiles.merge_profiles(profiles.file_profiles(stored, COLUMNS, F.col("day").cast("string")))
    whole = profiles.file_profiles(df, COLUMNS, F.lit("all"))
    got = {r.feature: r for r in profiles.described(merged).collect()}
    want = {r.feature: r for r in profiles.described(whole).collect()}
    assert set(got) == set(COLUMNS)
    for name in COLUMNS:
        a, b = got[name], want[name]
        assert (a.n, a.n_missing, a.min, a.max) == (b.n, b.n_missing, b.min, b.max)
        assert a.mean == (None if b.mean is None else pytest.approx(b.mean, rel=1e-14))
        assert a.std == (None if b.std is None else pytest.approx(b.std, rel=1e-9))
    assert got["gone"].n == 0 and got["gone"].q50_estimate is None
    assert got["word"].n_distinct_estimate == 2
    for name in ("x", "k"):
        exact = df.where(~F.isnan(F.coalesce(name, F.lit(math.nan)))).select(F.col(name).cast("double").alias("v"))
        total = exact.count()
        for p in (25, 50, 75):
            value = got[name][f"q{p}_estimate"]
            below = exact.where(F.col("v") < value).count()
            upto = exact.where(F.col("v") <= value).count()
            assert below - 0.0066 * total <= p / 100 * total <= upto + 0.0066 * total
        distinct = exact.distinct().count()
        assert got[name].n_distinct_estimate == pytest.approx(distinct, rel=0.025)


def test_merged_again(parts):
    rows = profiles.file_profiles(parts[1], COLUMNS, F.col("day").cast("string"))
    days = rows.withColumn("early", F.col("file") < "2")
    again = profiles.merge_profiles(profiles.merge_profiles(days, "early"))
    once = {r.feature: r for r in profiles.described(profiles.merge_profiles(rows)).collect()}
    for r in profiles.described(again).collect():
        assert (r.n, r.n_missing, r.min, r.max) == tuple(once[r.feature][c] for c in ("n", "n_missing", "min", "max"))
        assert r["std"] == (None if once[r.feature]["std"] is None else pytest.approx(once[r.feature]["std"], rel=1e-9))


def test_store(parts, spark, tmp_path):
    path = str(tmp_path / "profiles")
    stored = parts[1]
    profiles.add_profiles(stored.where("day < 2"), path, COLUMNS)
    profiles.add_profiles(stored.where("day > 0"), path, COLUMNS)
    kept = profiles.read_profiles(spark, path)
    assert kept.count() == 3 * len(COLUMNS)
    files = sorted(r.file for r in kept.select("file").distinct().collect())
    two = profiles.merge_profiles(profiles.read_profiles(spark, path, files[:2]))
    assert two.where("feature = 'k'").first().n == 8000
    assert profiles.merge_profiles(profiles.read_profiles(spark, path, [])).count() == 0


def test_infinite_empty_and_null_keys(frame):
    df = frame([(None, math.inf), (None, 1.0), ("b", -0.0), ("b", 0.0)], "file string, x double")
    rows = profiles.file_profiles(df.withColumn("p", F.col("file")), ["x"], F.col("p"))
    got = {r.file: r for r in profiles.described(profiles.merge_profiles(rows, "file")).collect()}
    assert got[None].max == math.inf and got[None].mean == 1.0 and got[None]["std"] is None
    assert got["b"].n_distinct_estimate == 1 and got["b"]["std"] == 0.0
    assert profiles.file_profiles(df.limit(0), ["x"], F.col("file")).count() == 0
