import math

import pytest
from pyspark.sql import functions as F

from loanloom.functions import scalars, tails


def column(frame, values, expr, kind="double"):
    df = frame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expr.alias("y")).orderBy("i").collect()]


def test_age_groups(frame):
    years = [0, 18, 25, 25.01, 65, 65.1, -3, None]
    days = [None if y is None else -y * 365.0 for y in years]
    assert column(frame, days, scalars.bin_age_into_groups("x")) == [
        None, "18-25", "18-25", "26-35", "56-65", "65+", None, None]


def test_age_group_of_nan_is_missing(frame):
    assert column(frame, [math.nan], scalars.bin_age_into_groups("x")) == [None]


def test_ratio(frame):
    df = frame([(1, 1.0, None), (2, 1.0, 0.0), (3, 1.0, 2.0), (4, None, 2.0), (5, None, 0.0)],
               "i int, a double, b double")
    got = df.select("i", scalars.calculate_ratio("a", "b").alias("y")).orderBy("i").collect()
    assert [r["y"] for r in got] == [None, 1e6, 0.5, None, 1e6]


def test_replace_infinite(frame):
    got = column(frame, [math.inf, -math.inf, 2.0, None, math.nan], scalars.replace_infinite("x"))
    assert got[:4] == [1e6, 1e6, 2.0, None] and math.isnan(got[4])


@pytest.mark.parametrize("credit,years,rate,expected", [
    (15000.0, 5, 0.05, 283.07), (1200.0, 1, 0.0, 100.0), (1e9, 30, 0.05, 5368216.23),
    (0.01, 1, 0.05, 0.0)])
def test_monthly_payment(frame, credit, years, rate, expected):
    df = frame([(credit, years)], "c double, y int")
    payment = scalars.calculate_monthly_payment("c", "y", rate)
    assert df.select(F.round(payment, 2).alias("p")).first()["p"] == expected


def test_risk_levels(frame):
    got = column(frame, [0.0, 0.2999, 0.3, 0.5999, 0.6, 1.0], scalars.determine_risk_level("x"))
    assert got == ["Low", "Low", "Medium", "Medium", "High", "High"]


def test_adjusted_probability_is_capped(frame):
    assert column(frame, [0.8], scalars.adjust_default_probability("x", F.lit(10.0))) == [1.0]


def test_names():
    assert scalars.clean_name("House / apartment") == "house_apartment"
    assert [scalars.clean_name(c) for c in ("Column 1", "Column-2", "Column@3")] == [
        "column_1", "column_2", "column_3"]


def test_placeholder_is_case_sensitive(frame):
    df = frame([("xna",), ("XNA",), (None,)], "x string")
    assert [r["x"] for r in df.select(scalars.placeholder_to_null("x")).collect()] == [
        None, "XNA", None]


def test_lookup_default(frame):
    assert column(frame, ["a", "b", None], scalars.lookup("x", {"a": 5}, -1), "string") == [5, -1, -1]


def test_tails():
    assert tails.chi2_upper(0.4464285714, 1) == pytest.approx(0.5040358665, abs=1e-9)
    assert tails.chi2_upper(600.0, 1) == pytest.approx(1.69e-132, rel=0.01)
    assert tails.normal_two_sided(14.8) < 1e-48
    assert tails.mann_whitney_p(11.0, 5, 5, 0.0) == pytest.approx(0.8412698412698413)
    assert tails.t_quantile(0.975, 7) == pytest.approx(2.3646242510, abs=1e-8)
    assert tails.fisher_two_sided(8, 2, 1, 5) == pytest.approx(0.03496503496503495)
    assert tails.fisher_two_sided(3, 3, 3, 3) == pytest.approx(1.0)
    assert tails.chi2_upper(0.0, 0) == 1.0
