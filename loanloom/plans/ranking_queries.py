"""Registered queries: samples, splits, curves, ranks and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom.operators import metrics, rank, sampling, summary
from loanloom.plans.applications import applications
from loanloom.plans.quality_queries import rounded
from loanloom.plans.registry import query
from loanloom.session import stage
from loanloom.sources.tables import submission

SCORES = ["p_default", "p_other"]


def scored(spark, sf_dir):
    return stage(applications(spark, sf_dir).select("sk_id_curr", "target_signal", *SCORES))


@query("stratified_sample_ids", """, s AS (SELECT sk_id_curr, target,
  row_number() OVER (PARTITION BY target ORDER BY md5('42:' || sk_id_curr), sk_id_curr) AS rn,
  count(*) OVER (PARTITION BY target) AS n, count(*) OVER () AS total FROM application)
SELECT sk_id_curr, target FROM s WHERE rn <= round_even(1000::DOUBLE / total * n, 0)""")
def stratified_sample_ids(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select("sk_id_curr", "target"))
    return sampling.create_stratified_sample(apps, "target", 1000, "sk_id_curr").select(
        "sk_id_curr", "target")


_SPLIT_SQL = """, s AS (SELECT sk_id_curr, target, target_signal, amt_credit,
  row_number() OVER (PARTITION BY target ORDER BY md5('42:' || sk_id_curr), sk_id_curr) AS rn,
  round_even(0.2::DOUBLE * count(*) OVER (PARTITION BY target), 0) AS t,
  count(*) OVER (PARTITION BY target) AS n FROM application),
p AS (SELECT *, CASE WHEN rn <= t THEN 'test' WHEN rn <= t + round_even(0.25::DOUBLE * (n - t), 0)
  THEN 'validation' ELSE 'train' END AS split FROM s)"""


@query("split_rows", _SPLIT_SQL + " SELECT sk_id_curr, split FROM p")
def split_rows(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select("sk_id_curr", "target"))
    return sampling.stratified_split(apps, "target", "sk_id_curr").select("sk_id_curr", "split")


@query("split_counts", _SPLIT_SQL + """
SELECT split, target, count(*) AS n, round(sum(amt_credit), 2) AS credit FROM p GROUP BY 1, 2""")
def split_counts(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select("sk_id_curr", "target", "amt_credit"))
    return sampling.stratified_split(apps, "target", "sk_id_curr").groupBy("split", "target").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("amt_credit"), 2).alias("credit"))


def _counted(c):
    return f"""SELECT '{c}' AS model, {c} AS score, count(*) FILTER (target_signal = 0) AS n0,
  count(*) FILTER (target_signal = 1) AS n1 FROM application GROUP BY 2"""


_CURVE_SQL = ", h AS (" + " UNION ALL ".join(map(_counted, SCORES)) + """), c AS (SELECT *,
  sum(n0) OVER w AS fp, sum(n1) OVER w AS tp, sum(n0) OVER (PARTITION BY model) AS neg,
  sum(n1) OVER (PARTITION BY model) AS pos
  FROM h WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@query("roc_points", _CURVE_SQL + """
SELECT model, score AS threshold, round(fp / neg, 6) AS fpr, round(tp / pos, 6) AS tpr FROM c
UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE FROM c""")
def roc_points(spark, sf_dir):
    return rounded(rank.roc_points(scored(spark, sf_dir), SCORES, "target_signal"), "fpr", "tpr")


@query("pr_points", _CURVE_SQL + """
SELECT model, score AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / pos, 6) AS recall
FROM c UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 1.0::DOUBLE, 0.0::DOUBLE FROM c""")
def pr_points(spark, sf_dir):
    return rounded(
        rank.pr_points(scored(spark, sf_dir), SCORES, "target_signal"), "precision", "recall")


@query("auc_exact", _CURVE_SQL + """
SELECT model, round(sum(n0 * (tp - n1) + n0 * n1 * 0.5::DOUBLE) / (max(pos) * max(neg)), 8) AS auc
FROM c GROUP BY 1""")
def auc_exact(spark, sf_dir):
    return rounded(rank.auc(scored(spark, sf_dir), SCORES, "target_signal"), "auc", digits=8)


@query("ext_pr_auc", _CURVE_SQL + """
SELECT model, round(sum(n1 / pos * tp / (tp + fp)), 8) AS pr_auc FROM c GROUP BY 1""")
def ext_pr_auc(spark, sf_dir):
    return rounded(
        rank.average_precision(scored(spark, sf_dir), SCORES, "target_signal"), "pr_auc", digits=8)


@query("ext_threshold_for_recall", _CURVE_SQL + """
SELECT model, max(score) AS threshold FROM c WHERE tp / pos >= 0.8 GROUP BY 1""")
def ext_threshold_for_recall(spark, sf_dir):
    return rank.ext_threshold_for_recall(scored(spark, sf_dir), SCORES, "target_signal", 0.8)


_RANKED = ["amt_credit", "ext_source_2"]


@query("average_ranks", """, v AS (
  SELECT 'amt_credit' AS feature, amt_credit AS value FROM application
  UNION ALL SELECT 'ext_source_2', ext_source_2 FROM application),
h AS (SELECT feature, value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT feature, value, n, CAST(sum(n) OVER (PARTITION BY feature ORDER BY value
  ROWS UNBOUNDED PRECEDING) - n AS DOUBLE) + (n + 1) / 2 AS avg_rank FROM h""")
def average_ranks(spark, sf_dir):
    apps = stage(applications(spark, sf_dir).select(*_RANKED))
    return rank.average_ranks(apps, _RANKED)


_OUTCOME_SQL = ", o AS (" + " UNION ALL ".join(f"""
SELECT '{c}' AS model, count(*) FILTER (target_signal = 0 AND {c} < 0.5) AS tn,
  count(*) FILTER (target_signal = 0 AND {c} >= 0.5) AS fp,
  count(*) FILTER (target_signal = 1 AND {c} < 0.5) AS fn,
  count(*) FILTER (target_signal = 1 AND {c} >= 0.5) AS tp FROM application""" for c in SCORES) + ")"


@query("confusion_matrix", _OUTCOME_SQL + """
SELECT model, 0 AS actual, 0 AS predicted, tn AS n, round(tn * 100.0::DOUBLE / (tn + fp), 6) AS pct FROM o
UNION ALL SELECT model, 0, 1, fp, round(fp * 100.0::DOUBLE / (tn + fp), 6) FROM o
UNION ALL SELECT model, 1, 0, fn, round(fn * 100.0::DOUBLE / (fn + tp), 6) FROM o
UNION ALL SELECT model, 1, 1, tp, round(tp * 100.0::DOUBLE / (fn + tp), 6) FROM o""")
def confusion_matrix(spark, sf_dir):
    apps = applications(spark, sf_dir).select("target_signal", *SCORES)
    return rounded(metrics.confusion_matrix(apps, SCORES, "target_signal"), "pct")


_METRIC_SQL = _CURVE_SQL + _OUTCOME_SQL.replace(", o AS", ", o AS", 1) + """,
a AS (SELECT model, sum(n0 * (tp - n1) + n0 * n1 * 0.5::DOUBLE) / (max(pos) * max(neg)) AS auc_roc
  FROM c GROUP BY 1),
m AS (SELECT model, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, auc_roc
  FROM o JOIN a USING (model)),
e AS (SELECT model, precision, recall, 2 * precision * recall / (precision + recall) AS f1_score,
  5 * precision * recall / (4 * precision + recall) AS f2_score, auc_roc FROM m)"""


@query("fbeta_scores", _METRIC_SQL + """
SELECT model, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1_score, 6) AS f1_score, round(f2_score, 6) AS f2_score, round(auc_roc, 6) AS auc_roc FROM e""")
def fbeta_scores(spark, sf_dir):
    out = metrics.evaluate_scores(scored(spark, sf_dir), SCORES, "target_signal")
    return rounded(out, *metrics.METRICS)


@query("model_metric_ranks", _METRIC_SQL + """,
l AS (UNPIVOT e ON precision, recall, f1_score, f2_score, auc_roc INTO NAME metric VALUE value)
SELECT model, metric, round(value, 6) AS value, CAST(row_number() OVER (
  PARTITION BY metric ORDER BY value DESC, model) AS INTEGER) AS position FROM l""")
def model_metric_ranks(spark, sf_dir):
    wide = metrics.evaluate_scores(scored(spark, sf_dir), SCORES, "target_signal")
    return rounded(summary.rank_models(metrics.long_metrics(wide)), "value")


@query("metric_comparison", _METRIC_SQL + """
SELECT model, round(recall, 6) AS recall, round(f2_score, 6) AS f2_score FROM e""")
def metric_comparison(spark, sf_dir):
    wide = metrics.evaluate_scores(scored(spark, sf_dir), SCORES, "target_signal")
    table = summary.metric_table(metrics.long_metrics(wide), ["recall", "f2_score"])
    return rounded(table, "recall", "f2_score")


@query("ext_balanced_accuracy", _OUTCOME_SQL + """
SELECT model, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy FROM o""")
def ext_balanced_accuracy(spark, sf_dir):
    counts = metrics.outcome_counts(
        applications(spark, sf_dir).select("target_signal", *SCORES), SCORES, "target_signal")
    return metrics.threshold_metrics(counts).select(
        "model", F.round("ext_balanced_accuracy", 6).alias("balanced_accuracy"))


@query("class_weights", """
SELECT target_signal AS class, count(*) AS n,
  round(sum(count(*)) OVER () / (2 * count(*)), 8) AS balanced_weight,
  CASE WHEN target_signal = 1 THEN round(sum(count(*)) OVER () / count(*), 8) ELSE 1.0::DOUBLE END
    AS positive_weight FROM application GROUP BY 1""")
def class_weights(spark, sf_dir):
    return rounded(
        metrics.class_weights(applications(spark, sf_dir).select("target_signal"), "target_signal"),
        "balanced_weight", "positive_weight", digits=8)


@query("submission_rows", """
SELECT sk_id_curr AS SK_ID_CURR, round(p_other, 1) AS TARGET FROM application""")
def submission_rows(spark, sf_dir):
    return submission(applications(spark, sf_dir), "sk_id_curr", "p_other")
