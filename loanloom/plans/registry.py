"""Registry of queries and their check SQL, and the table the SQL starts from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

APPLICATION_SQL = """
lines AS (
  SELECT l_orderkey, round(sum(l_extendedprice), 2) AS amt_goods_price,
         round(avg(l_discount) * 10, 4) AS ext_source_2,
         round(avg(l_quantity) / 50, 4) AS ext_source_3
  FROM lineitem GROUP BY l_orderkey),
application AS (
  SELECT o_orderkey AS sk_id_curr,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target,
    CASE WHEN o_totalprice > amt_goods_price AND o_orderkey % 4 <> 0 THEN 1 ELSE 0 END
      AS target_signal,
    greatest(c_acctbal, 0.0::DOUBLE) AS amt_income_total, o_totalprice AS amt_credit,
    amt_goods_price, CAST(1 + o_orderkey % 30 AS INTEGER) AS loan_term_years,
    round(o_totalprice * (0.05::DOUBLE / 12) * pow(1 + 0.05::DOUBLE / 12, 12 * (1 + o_orderkey % 30))
      / (pow(1 + 0.05::DOUBLE / 12, 12 * (1 + o_orderkey % 30)) - 1), 2) AS amt_annuity,
    CAST(-((18 + o_custkey % 60) * 365 + o_custkey % 365) AS INTEGER) AS days_birth,
    CAST(-date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS INTEGER)
      AS days_id_publish,
    ext_source_2, ext_source_3, c_mktsegment AS name_income_type,
    o_orderpriority AS name_education_type, n_name AS organization_type,
    CAST(1 + n_regionkey % 3 AS VARCHAR) AS region_rating_client,
    CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS code_gender,
    CASE WHEN o_custkey % 3 = 0 THEN 'Y' ELSE 'N' END AS flag_own_car,
    CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN 'xna'
         WHEN o_orderkey % 10 <= 5 THEN 'Unaccompanied' WHEN o_orderkey % 10 <= 8 THEN 'Family'
         ELSE 'Children' END AS name_type_suite,
    upper(dayname(o_orderdate)) AS weekday_appr_process_start, o_orderdate AS application_time,
    CAST(o_orderkey % 7 * 50 AS DOUBLE) AS existing_mortgage_payment,
    CAST(o_orderkey % 5 * 25 AS DOUBLE) AS existing_loan_payments,
    CASE WHEN o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS dataset,
    round((o_orderkey % 1000) / 1000.0::DOUBLE, 3) AS p_default,
    round((o_custkey % 100) / 100.0::DOUBLE, 2) AS p_other
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey
  JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""


def query(name: str, sql: str | None = None, with_applications: bool = True):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its check SQL.

    The SQL may use the ``application`` table; a leading ``,`` continues its ``WITH`` list.
    """

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            text = sql.strip()
            if with_applications:
                text = f"WITH {APPLICATION_SQL.strip()}{'' if text.startswith(',') else ' '}{text}"
            ORACLES[name] = text
        return fn

    return add
