"""Scalar functions as column expressions; all of them stay inside codegen."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age group labels with their upper bound in years (right-closed).
AGE_GROUPS = [
    (25, "18-25"),
    (35, "26-35"),
    (45, "36-45"),
    (55, "46-55"),
    (65, "56-65"),
    (None, "65+"),
]

# Interest, affordability and risk thresholds of the loan decision.
ANNUAL_RATE = 0.05
RISK_WEIGHT = 0.05
MAX_DEBT_RATIO = 0.4
LOW_RISK_BELOW = 0.3
MEDIUM_RISK_BELOW = 0.6
RATIO_FILL = 1e6
INFINITY_FILL = 1e6

# Weekday names.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def as_column(value: Column | str | float | int) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def present(value: Column | str) -> Column:
    """The value as double, with NaN turned into null."""
    number = as_column(value).cast("double")
    return F.when(~F.isnan(number), number)


def clean_name(name: str) -> str:
    """Each run of characters other than ASCII letters, digits and ``_`` becomes ``_``."""
    return re.sub(r"[^A-Za-z0-9_]+", "_", name).lower()


def calculate_ratio(numerator, denominator, fill_value: float = RATIO_FILL) -> Column:
    """``numerator / denominator``; a zero denominator gives the fill value, a missing
    side gives a missing ratio."""
    num = as_column(numerator).cast("double")
    den = as_column(denominator).cast("double")
    return F.when(den == 0, F.lit(float(fill_value))).otherwise(F.try_divide(num, den))


def bin_age_into_groups(days_birth) -> Column:
    """Age group of a (negative) day count; zero, positive and missing give null."""
    years = -present(days_birth) / 365
    group = F.when(years.isNull() | (years <= 0), F.lit(None).cast("string"))
    for upper, label in AGE_GROUPS:
        group = group.otherwise(label) if upper is None else group.when(years <= upper, label)
    return group


def bin_by_edges(value, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(e0, e1], (e1, e2] ...`` with the lowest edge included."""
    x = present(value)
    chain = F.when(x.isNull() | (x < edges[0]) | (x > edges[-1]), F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels, strict=True):
        chain = chain.when(x <= F.lit(float(upper)), label)
    return chain


def replace_infinite(value, fill: float = INFINITY_FILL) -> Column:
    """Both infinities become ``fill``; NaN stays."""
    x = as_column(value).cast("double")
    return F.when(x.isin(float("inf"), float("-inf")), F.lit(float(fill))).otherwise(x)


def age_to_days(age, days_birth) -> Column:
    return F.coalesce(-as_column(age) * 365, as_column(days_birth)).cast("int")


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or missing."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def calculate_monthly_payment(credit, years, rate: float | Column = ANNUAL_RATE) -> Column:
    """Annuity payment over ``12 * years`` months at a yearly rate."""
    monthly = as_column(rate) / 12
    months = as_column(years) * 12
    amount = as_column(credit).cast("double")
    growth = F.pow(1 + monthly, months)
    return F.when(monthly == 0, F.try_divide(amount, months)).otherwise(
        F.try_divide(amount * monthly * growth, growth - 1)
    )


def adjust_default_probability(probability, debt_to_income) -> Column:
    return F.least(
        as_column(probability) + RISK_WEIGHT * as_column(debt_to_income), F.lit(1.0)
    )


def determine_risk_level(probability) -> Column:
    p = as_column(probability)
    return F.when(p < LOW_RISK_BELOW, "Low").when(p < MEDIUM_RISK_BELOW, "Medium").otherwise("High")


def total_debt_ratio(payment, mortgage, other_loans, income) -> Column:
    """All monthly payments over income; missing when income is zero."""
    paid = as_column(payment) + as_column(mortgage) + as_column(other_loans)
    return F.try_divide(paid, as_column(income).cast("double"))


def binary_flag(value) -> Column:
    """``M`` and ``Y`` are 1, everything else is 0."""
    return flag(as_column(value).isin("M", "Y"))


def vocabulary_one_hot(name: str, vocabulary: Sequence[str]) -> list[Column]:
    """One 0/1 column per word of a fixed vocabulary, named by :func:`clean_name`."""
    return [
        flag(F.col(name) == word).alias(clean_name(f"{name}_{word}")) for word in vocabulary
    ]


def weekday_one_hot(event_time, prefix: str = "weekday_appr_process_start") -> list[Column]:
    day = F.date_format(as_column(event_time), "EEEE")
    return [flag(day == name).alias(f"{prefix}_{name.lower()}") for name in WEEKDAYS]


def lookup(value, mapping: Mapping, default) -> Column:
    """Value of a small fixed mapping, or ``default`` when the key is absent."""
    key = as_column(value)
    if not mapping:
        return F.lit(default)
    chain = reduce(
        lambda acc, item: acc.when(key == item[0], F.lit(item[1])),
        list(mapping.items())[1:],
        F.when(key == next(iter(mapping)), F.lit(next(iter(mapping.values())))),
    )
    return chain.otherwise(F.lit(default))


def placeholder_to_null(name: str, placeholder: str = "xna") -> Column:
    """Exact, case-sensitive match of the placeholder becomes null."""
    return F.when(F.col(name) != placeholder, F.col(name)).alias(name)


def recode_code(name: str) -> Column:
    """A numeric code as its rounded integer text."""
    return F.round(F.col(name), 0).cast("int").cast("string").alias(name)


def row_mean(names: Sequence[str]) -> Column:
    """Mean of the non-missing columns of a row."""
    values = [present(n) for n in names]
    total = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v in values])
    filled = reduce(lambda a, b: a + b, [v.isNotNull().cast("int") for v in values])
    return F.try_divide(total, filled)
