"""The loan-application table derived from the order tables.

One row per order.  Every rule is deterministic, so another engine can repeat it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.scalars import calculate_monthly_payment
from loanloom.sources.tables import read_table

NUMERIC = [
    "amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price", "ext_source_2",
    "ext_source_3", "days_birth", "days_id_publish",
]
CATEGORICAL = [
    "name_income_type", "name_education_type", "organization_type", "region_rating_client",
    "code_gender", "flag_own_car", "name_type_suite", "weekday_appr_process_start",
]


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are aggregated per order first, so both big tables meet on the order key."""
    lines = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("amt_goods_price"),
        F.round(F.avg("l_discount") * 10, 4).alias("ext_source_2"),
        F.round(F.avg("l_quantity") / 50, 4).alias("ext_source_3"),
    )
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey"
    )
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    term = 1 + key % 30
    suite = key % 10
    return (
        orders.join(lines, F.col("l_orderkey") == key, "left")
        .join(customer, F.col("c_custkey") == cust)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("sk_id_curr"),
            F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("target"),
            F.when((F.col("o_totalprice") > F.col("amt_goods_price")) & (key % 4 != 0), 1)
            .otherwise(0).alias("target_signal"),
            F.greatest("c_acctbal", F.lit(0.0)).alias("amt_income_total"),
            F.col("o_totalprice").alias("amt_credit"),
            F.col("amt_goods_price"),
            term.cast("int").alias("loan_term_years"),
            F.round(calculate_monthly_payment("o_totalprice", term), 2).alias("amt_annuity"),
            (-((18 + cust % 60) * 365 + cust % 365)).cast("int").alias("days_birth"),
            (-F.date_diff(F.lit("2001-12-31").cast("date"), F.col("o_orderdate").cast("date")))
            .cast("int").alias("days_id_publish"),
            F.col("ext_source_2"), F.col("ext_source_3"),
            F.col("c_mktsegment").alias("name_income_type"),
            F.col("o_orderpriority").alias("name_education_type"),
            F.col("n_name").alias("organization_type"),
            (1 + F.col("n_regionkey") % 3).cast("string").alias("region_rating_client"),
            F.when(cust % 2 == 0, "M").otherwise("F").alias("code_gender"),
            F.when(cust % 3 == 0, "Y").otherwise("N").alias("flag_own_car"),
            F.when(suite == 0, F.lit(None).cast("string")).when(suite == 1, "xna")
            .when(suite <= 5, "Unaccompanied").when(suite <= 8, "Family").otherwise("Children")
            .alias("name_type_suite"),
            F.upper(F.date_format("o_orderdate", "EEEE")).alias("weekday_appr_process_start"),
            F.col("o_orderdate").alias("application_time"),
            (key % 7 * 50).cast("double").alias("existing_mortgage_payment"),
            (key % 5 * 25).cast("double").alias("existing_loan_payments"),
            F.when(key % 5 == 0, "test").otherwise("train").alias("dataset"),
            F.round((key % 1000) / 1000.0, 3).alias("p_default"),
            F.round((cust % 100) / 100.0, 2).alias("p_other"),
        )
    )


def orders(spark: SparkSession, sf_dir: str) -> int:
    """Number of orders, about that of applications."""
    return read_table(spark, sf_dir, "orders").count()


def split_tables(apps: DataFrame) -> tuple[DataFrame, DataFrame]:
    train = apps.where("dataset = 'train'").drop("dataset")
    return train, apps.where("dataset = 'test'").drop("dataset")
