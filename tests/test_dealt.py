"""Tables that fits pass over many times come in equal parts, one a core."""

import datetime
from collections import Counter

from pyspark.sql import functions as F

from loanloom import session
from loanloom.plans import model_queries


def order_tables(spark, folder, orders, customers):
    """Orders of few customers with two lines each, on one task."""
    day = F.lit(datetime.datetime(1995, 1, 1))
    ids = spark.range(orders, numPartitions=1)
    ids.select(
        F.col("id").alias("o_orderkey"), (F.col("id") % customers).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        (1000.0 + F.col("id") % 700).alias("o_totalprice"), day.alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(f"{folder}/orders.parquet")
    ids.select(F.col("id").alias("l_orderkey"), F.explode(F.array(F.lit(500.0), 1.0 * (F.col("id") % 900))).alias("l_extendedprice"),
               F.lit(0.05).alias("l_discount"), F.lit(10.0).alias("l_quantity")).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(customers).select(
        F.col("id").alias("c_custkey"), (F.col("id") * 1.5).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"),
        F.lit(0).alias("c_nationkey")).write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(0, "PERU", 1)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")


def test_splits_come_in_equal_parts(spark, tmp_path, monkeypatch):
    order_tables(spark, tmp_path, 4000, 3)
    cores = spark.sparkContext.defaultParallelism

    def parts():
        train = model_queries.splits(spark, str(tmp_path))[0].select("sk_id_curr", F.input_file_name().alias("file")).collect()
        return sorted(r["sk_id_curr"] for r in train), [*Counter(r["file"] for r in train).values()]

    small, _ = parts()
    monkeypatch.setattr(session, "FEW_ROWS", 1000, raising=False)
    large, sizes = parts()
    assert large == small and len(large) == 2400
    assert len(sizes) == cores and min(sizes) > 0.5 * max(sizes)


def test_few_rows_stay_and_many_get_more_parts(spark, monkeypatch):
    cores, few = spark.sparkContext.defaultParallelism, spark.range(10, numPartitions=1)
    assert session.dealt(few, session.FEW_ROWS - 1) is few
    assert session.dealt(few, session.FEW_ROWS).rdd.getNumPartitions() == cores
    assert session.dealt(few, cores * session.MOST_ROWS + 1).rdd.getNumPartitions() == 2 * cores
