"""Rules for application records: validation with reasons, bounds, anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Vocabularies of an application record.
INCOME_TYPES = [
    "Working", "State servant", "Commercial associate", "Pensioner", "Unemployed", "Student",
    "Businessman", "Maternity leave",
]
HOUSING_TYPES = [
    "House / apartment", "Rented apartment", "With parents", "Municipal apartment",
    "Office apartment", "Co-op apartment",
]
FAMILY_STATUSES = [
    "Single / not married", "Married", "Civil marriage", "Widow", "Separated", "Unknown",
]
EDUCATION_TYPES = [
    "Lower secondary", "Secondary / secondary special", "Incomplete higher", "Higher education",
    "Academic degree",
]
VOCABULARIES = {
    "name_income_type": INCOME_TYPES,
    "name_housing_type": HOUSING_TYPES,
    "name_family_status": FAMILY_STATUSES,
    "name_education_type": EDUCATION_TYPES,
}

# One-letter codes.
CODES = {
    "code_gender": ["M", "F"],
    "flag_own_car": ["Y", "N"],
    "flag_own_realty": ["Y", "N"],
}

# Bounds outside which an amount is anomalous, in report order.
ANOMALY_BOUNDS = {
    "amt_income_total": (0.0, 1_000_000.0),
    "amt_credit": (1_000.0, 1_000_000.0),
    "amt_goods_price": (0.0, 500_000.0),
    "amt_annuity": (100.0, 100_000.0),
}


def _rules() -> list[tuple[str, Column]]:
    """(reason, violated) in the order of the record's fields; missing fields violate."""
    rules = [
        ("amt_income_total must be at least 0", ~(F.col("amt_income_total") >= 0)),
        ("amt_credit must be above 0", ~(F.col("amt_credit") > 0)),
        ("amt_goods_price must be at least 0", ~(F.col("amt_goods_price") >= 0)),
    ]
    rules += [(f"{c} is not a known value", ~F.col(c).isin(v)) for c, v in VOCABULARIES.items()]
    rules += [(f"{c} must be {' or '.join(v)}", ~F.col(c).isin(v)) for c, v in CODES.items()]
    optional = [
        ("days_birth must not be positive", F.col("days_birth") > 0),
        ("age must be 18 to 100", ~F.col("age").between(18, 100)),
    ]
    later = [
        ("buy_goods is required", F.col("buy_goods").isNull()),
        ("loan_term_years must be 1 to 30", ~F.col("loan_term_years").between(1, 30)),
    ]
    defaulted = [
        (f"{c} must be at least 0", F.col(c) < 0)
        for c in ("existing_mortgage_payment", "existing_loan_payments")
    ]
    no_age = [("age or days_birth is required", F.col("age").isNull() & F.col("days_birth").isNull())]

    def known(violated: Column, when_missing: bool) -> Column:
        return F.coalesce(violated, F.lit(when_missing))

    return (
        [(r, known(v, True)) for r, v in rules]
        + [(r, known(v, False)) for r, v in optional]
        + [(r, known(v, True)) for r, v in later]
        + [(r, known(v, False)) for r, v in defaulted + no_age]
    )


def validate_applications(df: DataFrame) -> DataFrame:
    """Add ``errors``: the reasons a record is refused, empty when it is valid.

    A record that could not be read (``malformed`` holds its text) has that one reason.
    """
    reasons = [F.when(violated, F.lit(reason)) for reason, violated in _rules()]
    errors = F.array_compact(F.array(*reasons))
    if "malformed" in df.columns:
        errors = F.when(F.col("malformed").isNotNull(), F.array(F.lit("record is not readable"))).otherwise(errors)
    return df.withColumn("errors", errors)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid records with defaults filled in, and refused records with their reasons."""
    checked = validate_applications(df)
    valid = checked.where(F.size("errors") == 0).drop("errors").fillna(
        0.0, ["existing_mortgage_payment", "existing_loan_payments"]
    )
    return valid, checked.where(F.size("errors") > 0)


def refusal_counts(refused: DataFrame) -> DataFrame:
    """``reason, n`` over refused records."""
    # the outer form: for a plain explode Catalyst derives not-null filters from the long
    # rule expression, which takes minutes of planning; refused records are never empty
    return refused.select(F.explode_outer("errors").alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"))


def anomaly_records(bounds: dict[str, tuple[float, float]] | None = None) -> Column:
    """Array of ``feature, value, lower_bound, upper_bound`` for amounts strictly outside."""
    records = []
    for feature, (low, high) in (bounds or ANOMALY_BOUNDS).items():
        value = F.col(feature).cast("double")
        records.append(F.when((value < low) | (value > high), F.struct(
            F.lit(feature).alias("feature"), value.alias("value"),
            F.lit(float(low)).alias("lower_bound"), F.lit(float(high)).alias("upper_bound"),
        )))
    return F.array_compact(F.array(*records))
