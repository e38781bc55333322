"""Binned and derived features of loan applications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.scalars import bin_age_into_groups, calculate_ratio, flag, row_mean
from loanloom.operators.quantiles import QuantileBins, fit_quantile_bins

BINNED_AMOUNTS = {"amt_income_total": "income_group", "amt_credit": "credit_amount_group"}


def fit_amount_bins(df: DataFrame, num_bins: int = 5) -> dict[str, QuantileBins]:
    return fit_quantile_bins(df, list(BINNED_AMOUNTS), num_bins)


def binned_columns(bins: dict[str, QuantileBins]) -> dict[str, Column]:
    return {
        "age_group": bin_age_into_groups("days_birth"),
        **{BINNED_AMOUNTS[c]: b.apply() for c, b in bins.items()},
    }


def derived_columns() -> dict[str, Column]:
    return {
        "zero_income_flag": flag(F.col("amt_income_total") == 0),
        "debt_to_income_ratio": calculate_ratio("amt_credit", "amt_income_total"),
        "credit_to_goods_ratio": calculate_ratio("amt_credit", "amt_goods_price"),
        "annuity_to_income_ratio": calculate_ratio("amt_annuity", "amt_income_total"),
        "credit_exceeds_goods": flag(F.col("amt_credit") > F.col("amt_goods_price")),
    }


def create_binned_features(
    df: DataFrame, bins: dict[str, QuantileBins] | None = None
) -> DataFrame:
    """Age, income and credit groups; pass fitted ``bins`` to reuse training edges."""
    return df.withColumns(binned_columns(fit_amount_bins(df) if bins is None else bins))


def create_derived_features(df: DataFrame) -> DataFrame:
    return df.withColumns(derived_columns())


def engineer_features(
    df: DataFrame, bins: dict[str, QuantileBins] | None = None
) -> DataFrame:
    return df.withColumns({**binned_columns(fit_amount_bins(df) if bins is None else bins), **derived_columns()})


def ext_source_mean(df: DataFrame, sources=("ext_source_2", "ext_source_3")) -> DataFrame:
    """``ext_``: mean of the external scores that are present."""
    return df.withColumn("ext_source_mean", row_mean(sources))


def ext_employed_to_age(employed_days, days_birth) -> Column:
    """``ext_``: share of life in employment."""
    return calculate_ratio(employed_days, days_birth)


def ext_related_total(
    df: DataFrame, related: DataFrame, key: str, amount: str, output: str
) -> DataFrame:
    """``ext_``: sum of a related table's amounts per key, attached to each row."""
    totals = related.groupBy(key).agg(F.sum(amount).alias(output))
    return df.join(totals, key, "left")
