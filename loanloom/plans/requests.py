"""Application records derived from the order tables, some of them invalid on purpose."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.operators.validate import (
    EDUCATION_TYPES,
    FAMILY_STATUSES,
    HOUSING_TYPES,
    INCOME_TYPES,
)
from loanloom.sources.tables import read_table


def _pick(words, index):
    return F.element_at(F.array(*[F.lit(w) for w in words]), (index + 1).cast("int"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("goods"))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return (
        read_table(spark, sf_dir, "orders").join(lines, F.col("l_orderkey") == key, "left")
        .join(customer, F.col("c_custkey") == cust)
        .select(
            key.alias("sk_id_curr"),
            F.when(key % 50 == 0, 0.0).otherwise(F.col("c_acctbal")).alias("amt_income_total"),
            F.col("o_totalprice").alias("amt_credit"),
            F.coalesce("goods", F.lit(0.0)).alias("amt_goods_price"),
            _pick([*INCOME_TYPES, "Astronaut"], cust % 9).alias("name_income_type"),
            _pick(HOUSING_TYPES, key % 6).alias("name_housing_type"),
            _pick(FAMILY_STATUSES, cust % 6).alias("name_family_status"),
            _pick(EDUCATION_TYPES, F.substring("o_orderpriority", 1, 1).cast("int") - 1)
            .alias("name_education_type"),
            F.when(key % 97 == 0, "X").when(cust % 2 == 0, "M").otherwise("F").alias("code_gender"),
            F.when(cust % 3 == 0, "Y").otherwise("N").alias("flag_own_car"),
            F.when(cust % 5 < 3, "Y").otherwise("N").alias("flag_own_realty"),
            F.when((key % 3 != 0) & (key % 31 != 1),
                   -((18 + cust % 60) * 365 + cust % 365)).cast("int").alias("days_birth"),
            F.when(key % 101 == 0, 105).when(key % 3 == 0, 18 + cust % 60).cast("int").alias("age"),
            (key % 2 == 0).alias("buy_goods"),
            (1 + key % 32).cast("int").alias("loan_term_years"),
            (key % 7 * 50).cast("double").alias("existing_mortgage_payment"),
            (key % 5 * 25).cast("double").alias("existing_loan_payments"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("application_time"),
        )
    )


REQUEST_SQL = """
goods AS (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS goods FROM lineitem GROUP BY 1),
request AS (SELECT o_orderkey AS sk_id_curr,
  CASE WHEN o_orderkey % 50 = 0 THEN 0.0::DOUBLE ELSE c_acctbal END AS amt_income_total,
  o_totalprice AS amt_credit, coalesce(goods, 0.0::DOUBLE) AS amt_goods_price,
  CASE o_custkey % 9 WHEN 0 THEN 'Working' WHEN 1 THEN 'State servant'
    WHEN 2 THEN 'Commercial associate' WHEN 3 THEN 'Pensioner' WHEN 4 THEN 'Unemployed'
    WHEN 5 THEN 'Student' WHEN 6 THEN 'Businessman' WHEN 7 THEN 'Maternity leave'
    ELSE 'Astronaut' END AS name_income_type,
  CAST(o_orderkey % 6 AS INTEGER) AS housing, CAST(o_custkey % 6 AS INTEGER) AS family,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS education,
  CASE WHEN o_orderkey % 97 = 0 THEN 'X' WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS code_gender,
  CASE WHEN o_custkey % 3 = 0 THEN 'Y' ELSE 'N' END AS flag_own_car,
  CASE WHEN o_custkey % 5 < 3 THEN 'Y' ELSE 'N' END AS flag_own_realty,
  CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 31 <> 1
    THEN CAST(-((18 + o_custkey % 60) * 365 + o_custkey % 365) AS INTEGER) END AS days_birth,
  CASE WHEN o_orderkey % 101 = 0 THEN 105 WHEN o_orderkey % 3 = 0
    THEN CAST(18 + o_custkey % 60 AS INTEGER) END AS age,
  CAST(1 + o_orderkey % 32 AS INTEGER) AS loan_term_years,
  CAST(o_orderkey % 7 * 50 AS DOUBLE) AS existing_mortgage_payment,
  CAST(o_orderkey % 5 * 25 AS DOUBLE) AS existing_loan_payments, o_orderdate AS application_time,
  round((o_orderkey % 1000) / 1000.0::DOUBLE, 3) AS p
  FROM orders LEFT JOIN goods ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey),
checked AS (SELECT *, concat_ws('; ',
  CASE WHEN NOT amt_income_total >= 0 THEN 'amt_income_total must be at least 0' END,
  CASE WHEN NOT amt_credit > 0 THEN 'amt_credit must be above 0' END,
  CASE WHEN name_income_type = 'Astronaut' THEN 'name_income_type is not a known value' END,
  CASE WHEN code_gender = 'X' THEN 'code_gender must be M or F' END,
  CASE WHEN age NOT BETWEEN 18 AND 100 THEN 'age must be 18 to 100' END,
  CASE WHEN loan_term_years NOT BETWEEN 1 AND 30 THEN 'loan_term_years must be 1 to 30' END,
  CASE WHEN age IS NULL AND days_birth IS NULL THEN 'age or days_birth is required' END) AS errors
  FROM request),
valid AS (SELECT *, amt_credit * (0.05::DOUBLE / 12) * pow(1 + 0.05::DOUBLE / 12, 12 * loan_term_years)
  / (pow(1 + 0.05::DOUBLE / 12, 12 * loan_term_years) - 1) AS payment FROM checked WHERE errors = '')"""
