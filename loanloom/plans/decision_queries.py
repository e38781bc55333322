"""Registered queries: decisions by a published bundle on records it was not trained on."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom.plans.decisions import decide, split_records, start_bundle_scoring, train_bundle
from loanloom.plans.requests import requests
from loanloom.plans.scoring_queries import _DECISION_SQL, _flat, query
from loanloom.session import shared_path
from loanloom.sources import bundles, tables

LABEL = "defaulted"

# What the decision says beside the model's probability, and who is decided on: the split is an md5 rule.
_NEW_SQL = _DECISION_SQL + """, known AS (SELECT sk_id_curr, CASE WHEN amt_credit > 30 * amt_income_total
    AND sk_id_curr % 10 < 8 THEN 1 ELSE 0 END AS y FROM valid),
place AS (SELECT sk_id_curr, row_number() OVER (PARTITION BY y ORDER BY md5('42:' || sk_id_curr), sk_id_curr) AS rn,
  round_even(0.2::DOUBLE * count(*) OVER (PARTITION BY y), 0) AS t FROM known)
SELECT sk_id_curr, monthly_payment, loan_approval, reason, anomalies_detected, n_anomalies,
  CAST(1 AS INTEGER) AS bundle_version, true AS in_range FROM decision JOIN place USING (sk_id_curr) WHERE rn <= t"""


def outcomes(spark, sf_dir):
    """Records whose outcome is known: a rule over amounts, with exceptions by number."""
    rule = F.col("amt_credit") > 30 * F.col("amt_income_total")
    return requests(spark, sf_dir).withColumn(LABEL, (rule & (F.col("sk_id_curr") % 10 < 8)).cast("int"))


def published(spark, sf_dir):
    """The parts of the known records and the folder with a bundle trained on one of them."""
    parts = split_records(outcomes(spark, sf_dir), LABEL)
    folder = shared_path(spark, "bundles")
    bundles.publish(spark, train_bundle(parts, LABEL), folder)
    return parts, folder


def _shown(decisions):
    """The probability itself has no SQL; a test applies the exported parameters in SQL."""
    return _flat(decisions).select(
        "sk_id_curr", "monthly_payment", "loan_approval", "reason", "anomalies_detected", "n_anomalies",
        "bundle_version", F.col("probability_of_default").between(0, 1).alias("in_range"))


@query("bundle_decisions", _NEW_SQL)
def bundle_decisions(spark, sf_dir):
    parts, folder = published(spark, sf_dir)
    new = parts.where("split = 'test'").drop("split", LABEL)
    return _shown(decide(new, bundles.load(spark, folder))[0])


@query("stream_bundle_decisions", _NEW_SQL)
def stream_bundle_decisions(spark, sf_dir):
    parts, folder = published(spark, sf_dir)
    path, decisions, refused, log = (shared_path(spark, n) for n in ("records", "scored", "refused", "log"))
    parts.where("split = 'test'").drop("split", LABEL).write.json(path)
    records = tables.read_applications(spark, path, stream=True)
    start_bundle_scoring(records, folder, decisions, refused, log).awaitTermination()
    return _shown(spark.read.parquet(decisions).drop("batch"))
