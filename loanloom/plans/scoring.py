"""Scoring of application records: one projection shared by batch and streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.scalars import (
    MAX_DEBT_RATIO,
    WEEKDAYS,
    adjust_default_probability,
    age_to_days,
    binary_flag,
    calculate_monthly_payment,
    clean_name,
    determine_risk_level,
    replace_infinite,
    total_debt_ratio,
    vocabulary_one_hot,
    weekday_one_hot,
)
from loanloom.operators.encode import ordinal_code
from loanloom.operators.features import binned_columns, derived_columns
from loanloom.operators.quantiles import QuantileBins
from loanloom.operators.schema import align_columns
from loanloom.operators.validate import (
    CODES,
    EDUCATION_TYPES,
    FAMILY_STATUSES,
    HOUSING_TYPES,
    INCOME_TYPES,
    anomaly_records,
    split_valid,
)

ONE_HOT = {
    "name_income_type": INCOME_TYPES,
    "name_housing_type": HOUSING_TYPES,
    "name_family_status": FAMILY_STATUSES,
}

# The model's inputs; the one-hot names follow from the vocabularies.
SELECTED_FEATURES = [
    "amt_income_total", "amt_credit", "amt_goods_price", "amt_annuity",
    *[clean_name(f"{c}_{v}") for c, words in ONE_HOT.items() for v in words],
    "name_education_type", "code_gender", "flag_own_car", "flag_own_realty", "is_anomaly",
    "days_birth", "debt_to_income_ratio", "credit_to_goods_ratio", "annuity_to_income_ratio",
    *[f"weekday_appr_process_start_{d.lower()}" for d in WEEKDAYS],
]

# Columns of a record that the decision needs beside the features.
CARRIED = ["sk_id_curr", "amt_income_total", "amt_credit", "loan_term_years",
           "existing_mortgage_payment", "existing_loan_payments"]


def preprocess(
    valid: DataFrame, bins: dict[str, QuantileBins] | None = None, anomaly: Column | None = None,
    carried: Sequence[str] = tuple(CARRIED),
) -> DataFrame:
    """Model inputs of valid records plus the ``carried`` columns and ``anomalies_details``.

    ``bins`` are the edges fitted on training data.  ``anomaly`` replaces the fixed bounds
    as the meaning of the ``is_anomaly`` feature, for models trained with fences.
    """
    if "amt_annuity" not in valid.columns:
        valid = valid.withColumn("amt_annuity", F.lit(None).cast("double"))
    base = valid.withColumns({
        "days_birth": age_to_days("age", "days_birth"),
        "amt_annuity": F.coalesce(
            F.col("amt_annuity"), calculate_monthly_payment("amt_credit", "loan_term_years")),
    }).withColumn("anomalies_details", anomaly_records())
    flagged = (F.size("anomalies_details") > 0) if anomaly is None else anomaly
    engineered = base.withColumns({
        **derived_columns(), **(binned_columns(bins) if bins else {}),
        "is_anomaly": flagged.cast("int"),
    })
    features = engineered.select(
        *[F.col(c).alias(f"__{c}") for c in carried], "anomalies_details",
        *[c for c in engineered.columns
          if c not in ONE_HOT and c not in CODES and c not in ("name_education_type", "anomalies_details")],
        *[c for name, words in ONE_HOT.items() for c in vocabulary_one_hot(name, words)],
        *[binary_flag(c).alias(c) for c in CODES],
        ordinal_code("name_education_type", EDUCATION_TYPES),
        *weekday_one_hot("application_time"),
    )
    keep = [f"__{c}" for c in carried] + ["anomalies_details"]
    out = align_columns(features, [*keep, *SELECTED_FEATURES])
    floats = {f.name for f in out.schema.fields if f.dataType.simpleString() == "double"}
    return out.withColumns({
        f: replace_infinite(f) for f in SELECTED_FEATURES if f in floats
    })


def loan_decision(df: DataFrame, probability: str = "probability") -> DataFrame:
    """Decision columns; a zero income is rejected with reason ``zero_income``."""
    credit, years, income = F.col("__amt_credit"), F.col("__loan_term_years"), F.col("__amt_income_total")
    payment = calculate_monthly_payment(credit, years)
    no_income = income == 0
    ratio = F.when(no_income, F.lit(float("inf"))).otherwise(F.try_divide(payment, income))
    total = total_debt_ratio(
        payment, F.col("__existing_mortgage_payment"), F.col("__existing_loan_payments"), income)
    adjusted = adjust_default_probability(F.col(probability), ratio)
    approved = F.coalesce(total <= MAX_DEBT_RATIO, F.lit(False))
    return df.select(
        F.col("__sk_id_curr").alias("sk_id_curr"),
        F.round(adjusted, 4).alias("probability_of_default"),
        F.round(payment, 2).alias("monthly_payment"),
        F.when(approved, determine_risk_level(adjusted)).otherwise("High").alias("risk_level"),
        F.when(approved, "Approved").otherwise("Rejected").alias("loan_approval"),
        F.when(no_income, "zero_income").when(~approved, "debt_ratio").alias("reason"),
        (F.size("anomalies_details") > 0).alias("anomalies_detected"),
        "anomalies_details",
    )


def with_model(model: PipelineModel) -> Callable[[DataFrame], DataFrame]:
    """Probability of class 1 from a fitted pipeline."""
    return lambda df: model.transform(df).withColumn(
        "probability", vector_to_array("probability")[1])


def with_expression(probability: Column) -> Callable[[DataFrame], DataFrame]:
    """Probability from a column expression over the carried columns and features."""
    return lambda df: df.withColumn("probability", probability)


def score_applications(
    records: DataFrame, score: Callable[[DataFrame], DataFrame],
    bins: dict[str, QuantileBins] | None = None, anomaly: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Decisions for the valid records and the refused records with their reasons."""
    valid, refused = split_valid(records)
    return loan_decision(score(preprocess(valid, bins, anomaly))), refused

