"""Repeated rows by fingerprints against grouping by whole rows."""

import math
import random

from pyspark.sql import functions as F

from loanloom.operators import duplicates, quality


def by_rows(df):
    return sorted(map(str, df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n_copies")).where("n_copies > 1").collect()))


def test_like_grouping(frame):
    rng = random.Random(4)
    cells = [None, 1, 2]
    rows = [(rng.choice(cells), rng.choice([None, "a", ""]), rng.choice([0.0, -0.0, math.nan, None]),
             rng.choice([[0.0], [-0.0], None, [1.0, None]]), rng.choice([None, 1, 2])) for _ in range(300)]
    df = frame(rows, "a int, `b c` string, c double, d array<double>, e int")
    assert sorted(map(str, duplicates.repeated_rows(df).collect())) == by_rows(df)


def test_nulls_in_other_places_differ(frame):
    df = frame([(None, 1), (1, None)], "a int, b int")
    assert quality.count_duplicated_rows(df).first()[0] == 0
    assert df.select(*[h.alias(f"h{i}") for i, h in enumerate(
        duplicates.fingerprint(duplicates.hashable(df, df.columns)))]).distinct().count() == 2


def test_forced_collisions_are_told_apart(frame):
    df = frame([(i % 7, "x" * (i % 3)) for i in range(30)] + [(99, "alone")], "a int, b string")
    same = lambda values: [F.lit(1).cast("bigint"), F.lit(2).cast("bigint")]
    assert sorted(map(str, duplicates.repeated_rows(df, hashes=same).collect())) == by_rows(df)
    assert sorted(map(str, duplicates.repeated_rows(df, field_words=1).collect())) == by_rows(df)


def test_hot_row_maps_and_empty(frame):
    df = frame([(1, {"k": 1})] * 20 + [(2, {"k": 2}), (2, {"k": 3})], "a int, m map<string,int>")
    assert quality.count_duplicated_rows(df).first()[0] == 20
    assert quality.count_duplicated_rows(df, ["a"]).first()[0] == 22
    assert quality.count_duplicated_rows(df.limit(0)).first()[0] == 0


def test_wide_rows_stay_where_they_are(spark, tmp_path):
    """Fewer than 40 bytes a row are exchanged for a table of 60 long texts."""
    path = str(tmp_path / "wide")
    rows = 20_000
    spark.range(0, rows, 1, 4).select(
        *[F.sha2(F.concat(F.expr(f"id % {rows - 1}"), F.lit(f"-{i}")), 256).alias(f"c{i}") for i in range(60)]).write.parquet(path)
    df = spark.read.parquet(path)
    found = duplicates.repeated_rows(df)
    assert [r.n_copies for r in found.collect()] == [2]
    plan = found._jdf.queryExecution().executedPlan()
    sizes, todo = [], [plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
        if name == "ShuffleExchangeExec":
            sizes.append(node.metrics().apply("dataSize").value())
        kids = node.children()
        todo.extend(kids.apply(i) for i in range(kids.size()))
    assert sizes and sum(sizes) < 40 * rows
