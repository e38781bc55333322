"""Registered queries: record validation, loan decisions, batch and stream scoring."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from loanloom.functions import scalars
from loanloom.operators import models
from loanloom.operators.schema import FeatureNameSanitizer
from loanloom.operators.validate import (
    FAMILY_STATUSES,
    HOUSING_TYPES,
    INCOME_TYPES,
    anomaly_records,
    refusal_counts,
    split_valid,
    validate_applications,
)
from loanloom.plans.quality_queries import rounded
from loanloom.plans.registry import query as register
from loanloom.plans.requests import REQUEST_SQL, requests
from loanloom.plans.scoring import (
    SELECTED_FEATURES,
    preprocess,
    score_applications,
    with_expression,
    with_model,
)
from loanloom.session import shared_path, stage
from loanloom.sources import tables
from loanloom.sources.models import load_checkpoint, save_checkpoint
from loanloom.streaming.scoring import start_decision_stream, start_scoring


def query(name, sql):
    return register(name, f"WITH {REQUEST_SQL.strip()} {sql.strip()}", with_applications=False)


def probability():
    return with_expression(F.round((F.col("__sk_id_curr") % 1000) / 1000.0, 3))


@query("validated_applications", "SELECT sk_id_curr, errors FROM checked")
def validated_applications(spark, sf_dir):
    return validate_applications(requests(spark, sf_dir)).select(
        "sk_id_curr", F.concat_ws("; ", "errors").alias("errors"))


@query("refusal_reasons", """
SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(errors, '; ')) AS reason FROM checked
  WHERE errors <> '') GROUP BY 1""")
def refusal_reasons(spark, sf_dir):
    return refusal_counts(split_valid(requests(spark, sf_dir))[1])


@query("age_in_days", "SELECT sk_id_curr, coalesce(-age * 365, days_birth) AS days_birth FROM valid")
def age_in_days(spark, sf_dir):
    return split_valid(requests(spark, sf_dir))[0].select(
        "sk_id_curr", scalars.age_to_days("age", "days_birth").alias("days_birth"))


_ANOMALY_SQL = """, a AS (
  SELECT sk_id_curr, 'amt_income_total' AS feature, amt_income_total AS value,
    0.0::DOUBLE AS lower_bound, 1000000.0::DOUBLE AS upper_bound FROM valid
  UNION ALL SELECT sk_id_curr, 'amt_credit', amt_credit, 1000.0, 1000000.0 FROM valid
  UNION ALL SELECT sk_id_curr, 'amt_goods_price', amt_goods_price, 0.0, 500000.0 FROM valid
  UNION ALL SELECT sk_id_curr, 'amt_annuity', payment, 100.0, 100000.0 FROM valid),
anomaly AS (SELECT * FROM a WHERE value < lower_bound OR value > upper_bound)"""


@query("bound_anomalies", _ANOMALY_SQL + """
SELECT sk_id_curr, feature, round(value, 4) AS value, lower_bound, upper_bound FROM anomaly""")
def bound_anomalies(spark, sf_dir):
    valid = split_valid(requests(spark, sf_dir))[0].withColumn(
        "amt_annuity", scalars.calculate_monthly_payment("amt_credit", "loan_term_years"))
    out = valid.select("sk_id_curr", F.explode(anomaly_records()).alias("a")).select("sk_id_curr", "a.*")
    return rounded(out, "value", digits=4)


@query("monthly_payment", """
SELECT sk_id_curr, round(payment, 2) AS monthly_payment,
  round(amt_credit / (12 * loan_term_years), 8) AS without_interest FROM valid""")
def monthly_payment(spark, sf_dir):
    return split_valid(requests(spark, sf_dir))[0].select(
        "sk_id_curr",
        F.round(scalars.calculate_monthly_payment("amt_credit", "loan_term_years"), 2)
        .alias("monthly_payment"),
        F.round(scalars.calculate_monthly_payment("amt_credit", "loan_term_years", 0.0), 8)
        .alias("without_interest"))


@query("risk_levels", """
SELECT sk_id_curr, round(least(p + 0.05::DOUBLE * (existing_mortgage_payment / 1000), 1), 6) AS adjusted,
  CASE WHEN p < 0.3::DOUBLE THEN 'Low' WHEN p < 0.6::DOUBLE THEN 'Medium' ELSE 'High' END AS risk_level
FROM request""")
def risk_levels(spark, sf_dir):
    p = F.round((F.col("sk_id_curr") % 1000) / 1000.0, 3)
    return requests(spark, sf_dir).select(
        "sk_id_curr",
        F.round(scalars.adjust_default_probability(p, F.col("existing_mortgage_payment") / 1000), 6)
        .alias("adjusted"),
        scalars.determine_risk_level(p).alias("risk_level"))


_DECISION_SQL = _ANOMALY_SQL + """, n AS (SELECT sk_id_curr, count(*) AS k FROM anomaly GROUP BY 1),
d AS (SELECT v.*, CASE WHEN amt_income_total = 0 THEN 1.0::DOUBLE
    ELSE least(p + 0.05::DOUBLE * (payment / amt_income_total), 1.0::DOUBLE) END AS adjusted,
  CASE WHEN amt_income_total = 0 THEN false ELSE (payment + existing_mortgage_payment
    + existing_loan_payments) / amt_income_total <= 0.4::DOUBLE END AS approved FROM valid v),
decision AS (SELECT sk_id_curr, round(adjusted, 4) AS probability_of_default, round(payment, 2) AS monthly_payment,
  CASE WHEN NOT approved THEN 'High' WHEN adjusted < 0.3::DOUBLE THEN 'Low'
    WHEN adjusted < 0.6::DOUBLE THEN 'Medium' ELSE 'High' END AS risk_level,
  CASE WHEN approved THEN 'Approved' ELSE 'Rejected' END AS loan_approval,
  CASE WHEN amt_income_total = 0 THEN 'zero_income' WHEN NOT approved THEN 'debt_ratio' END AS reason,
  coalesce(k, 0) > 0 AS anomalies_detected, CAST(coalesce(k, 0) AS INTEGER) AS n_anomalies
  FROM d LEFT JOIN n USING (sk_id_curr))"""


def _flat(decisions):
    return decisions.withColumn("n_anomalies", F.size("anomalies_details")).drop("anomalies_details")


@query("loan_decisions", _DECISION_SQL + " SELECT * FROM decision")
def loan_decisions(spark, sf_dir):
    return _flat(score_applications(requests(spark, sf_dir), probability())[0])


@query("decision_summary", _DECISION_SQL + """
SELECT loan_approval, risk_level, count(*) AS n, round(avg(monthly_payment), 2) AS mean_payment
FROM decision GROUP BY 1, 2""")
def decision_summary(spark, sf_dir):
    decisions, _ = score_applications(requests(spark, sf_dir), probability())
    return decisions.groupBy("loan_approval", "risk_level").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("monthly_payment"), 2).alias("mean_payment"))


@query("decision_records_json", _DECISION_SQL + " SELECT * FROM decision")
def decision_records_json(spark, sf_dir):
    """Decisions with their anomalies written as JSON records and read back."""
    path = shared_path(spark, "decisions")
    decisions, _ = score_applications(requests(spark, sf_dir), probability())
    tables.write_decisions(decisions, path)
    return _flat(spark.read.schema(decisions.schema).json(path))


def _one_hot_sql(name: str, column: str, words: list[str], by_place: bool) -> str:
    return ", ".join(
        f"CASE WHEN {column} = {i if by_place else repr(w)} THEN 1 ELSE 0 END AS {scalars.clean_name(f'{name}_{w}')}"
        for i, w in enumerate(words))


FEATURE_SQL = f""", features AS (SELECT sk_id_curr, amt_income_total, amt_credit, amt_goods_price, payment AS amt_annuity,
  {_one_hot_sql('name_income_type', 'name_income_type', INCOME_TYPES, False)},
  {_one_hot_sql('name_housing_type', 'housing', HOUSING_TYPES, True)},
  {_one_hot_sql('name_family_status', 'family', FAMILY_STATUSES, True)},
  CAST(education AS DOUBLE) AS name_education_type, CASE WHEN code_gender = 'M' THEN 1 ELSE 0 END AS code_gender,
  CASE WHEN flag_own_car = 'Y' THEN 1 ELSE 0 END AS flag_own_car,
  CASE WHEN flag_own_realty = 'Y' THEN 1 ELSE 0 END AS flag_own_realty,
  CASE WHEN sk_id_curr IN (SELECT sk_id_curr FROM anomaly) THEN 1 ELSE 0 END AS is_anomaly,
  coalesce(-age * 365, days_birth) AS days_birth,
  CASE WHEN amt_income_total = 0 THEN 1e6::DOUBLE ELSE amt_credit / amt_income_total END AS debt_to_income_ratio,
  CASE WHEN amt_goods_price = 0 THEN 1e6::DOUBLE ELSE amt_credit / amt_goods_price END AS credit_to_goods_ratio,
  CASE WHEN amt_income_total = 0 THEN 1e6::DOUBLE ELSE payment / amt_income_total END AS annuity_to_income_ratio,
  {", ".join(f"CASE WHEN dayname(application_time) = '{d}' THEN 1 ELSE 0 END AS weekday_appr_process_start_{d.lower()}"
             for d in scalars.WEEKDAYS)} FROM valid)"""


@query("scoring_features", _ANOMALY_SQL + FEATURE_SQL + """
SELECT * REPLACE (round(amt_annuity, 4) AS amt_annuity, round(debt_to_income_ratio, 6) AS debt_to_income_ratio,
  round(credit_to_goods_ratio, 6) AS credit_to_goods_ratio, round(annuity_to_income_ratio, 6) AS annuity_to_income_ratio)
FROM features""")
def scoring_features(spark, sf_dir):
    """All inputs of the model."""
    out = preprocess(split_valid(requests(spark, sf_dir))[0])
    out = rounded(rounded(out, "amt_annuity", digits=4), "debt_to_income_ratio", "credit_to_goods_ratio",
                  "annuity_to_income_ratio")
    return out.select(F.col("__sk_id_curr").alias("sk_id_curr"), *SELECTED_FEATURES)


def _record_stream(spark, records):
    path = shared_path(spark, "records")
    records.write.json(path)
    return tables.read_applications(spark, path, stream=True)


@query("stream_scored", _DECISION_SQL + " SELECT * FROM decision")
def stream_scored(spark, sf_dir):
    """JSON records as a stream, decisions and refused records in two sinks."""
    decisions, refused, log = (shared_path(spark, n) for n in ("scored", "refused", "log"))
    run = start_scoring(_record_stream(spark, requests(spark, sf_dir)), probability(), decisions, refused, log)
    run.awaitTermination()
    return _flat(spark.read.parquet(decisions).drop("batch"))


@query("stream_refused", "SELECT sk_id_curr, errors FROM checked WHERE errors <> ''")
def stream_refused(spark, sf_dir):
    decisions, refused, log = (shared_path(spark, n) for n in ("scored", "refused", "log"))
    run = start_scoring(_record_stream(spark, requests(spark, sf_dir)), probability(), decisions, refused, log)
    run.awaitTermination()
    return spark.read.parquet(refused).select(
        "sk_id_curr", F.concat_ws("; ", "errors").alias("errors"))


@query("stream_decision_counts", _DECISION_SQL + """
SELECT loan_approval, count(*) AS n FROM decision GROUP BY 1""")
def stream_decision_counts(spark, sf_dir):
    path, log = shared_path(spark, "scored"), shared_path(spark, "log")
    start_decision_stream(_record_stream(spark, requests(spark, sf_dir)), probability(), path, log).awaitTermination()
    return spark.read.parquet(path).groupBy("loan_approval").agg(F.count(F.lit(1)).alias("n"))


# A tree over two flags: each of its four leaves holds the share of label 1 among its records.
_FLAGS = ["code_gender", "flag_own_car"]
_MODEL_SQL = _DECISION_SQL.replace("FROM valid v)", """FROM (SELECT * EXCLUDE (p), avg(CASE
    WHEN sk_id_curr % 10 < CASE WHEN flag_own_car = 'Y' THEN CASE WHEN code_gender = 'M' THEN 3 ELSE 9 END
      WHEN code_gender = 'M' THEN 6 ELSE 2 END THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
    OVER (PARTITION BY code_gender, flag_own_car) AS p FROM valid) v)""")


def _stored_tree(spark, records):
    """Prepare the valid records, fit a tree on them, store it and load it again."""
    prepared = preprocess(split_valid(records)[0])
    man, car = F.col("code_gender") == 1, F.col("flag_own_car") == 1
    # sibling leaves predict different labels, else the tree would merge them
    below = F.when(car & man, 3).when(car, 9).when(man, 6).otherwise(2)
    label = (F.col("__sk_id_curr") % 10 < below).cast("double")
    tree = models.create_pipeline(
        FeatureNameSanitizer(inputCols=SELECTED_FEATURES), models.assembler(_FLAGS, models.CHOSEN),
        DecisionTreeClassifier(labelCol=models.LABEL, featuresCol=models.CHOSEN, maxDepth=2))
    # the fit reads its rows several times
    fitted = tree.fit(stage(prepared.select(*SELECTED_FEATURES, label.alias(models.LABEL)), "prepared"))
    folder = shared_path(spark, "models")
    save_checkpoint(fitted, "Flag Tree", folder)
    return with_model(load_checkpoint("Flag Tree", folder))


@query("model_scored_decisions", _MODEL_SQL + " SELECT * FROM decision")
def model_scored_decisions(spark, sf_dir):
    records = stage(requests(spark, sf_dir), "records")
    return _flat(score_applications(records, _stored_tree(spark, records))[0])


@query("model_scored_outcomes", _MODEL_SQL + """
SELECT sk_id_curr, 'decision' AS outcome FROM decision
UNION ALL SELECT sk_id_curr, 'refused' AS outcome FROM checked WHERE errors <> ''""")
def model_scored_outcomes(spark, sf_dir):
    """Every application once, as a decision or as a refusal."""
    records = stage(requests(spark, sf_dir), "records")
    decisions, refused = score_applications(records, _stored_tree(spark, records))
    return decisions.select("sk_id_curr", F.lit("decision").alias("outcome")).unionByName(
        refused.select("sk_id_curr", F.lit("refused").alias("outcome")))


@query("stream_model_scored", _MODEL_SQL + " SELECT * FROM decision")
def stream_model_scored(spark, sf_dir):
    decisions, refused, log = (shared_path(spark, n) for n in ("scored", "refused", "log"))
    records = stage(requests(spark, sf_dir), "records")
    score = _stored_tree(spark, records)
    start_scoring(_record_stream(spark, records), score, decisions, refused, log).awaitTermination()
    return _flat(spark.read.parquet(decisions).drop("batch"))
