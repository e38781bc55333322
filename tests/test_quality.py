import math

import pytest
from pyspark.sql import functions as F

from loanloom.operators import features, outliers, quality, schema, summary


@pytest.fixture()
def small(frame):
    rows = [(10, 1.5, "A", 0), (20, 2.5, "B", 1), (30, 3.5, "A", 0), (40, 4.5, "B", 1),
            (1000, 100.5, "A", 0)]
    return frame(rows, "feature1 int, feature2 double, category string, target int")


def test_fences(small):
    assert outliers.iqr_fences(small, ["feature1", "feature2"]) == {
        "feature1": (-10.0, 70.0), "feature2": (-0.5, 7.5)}
    assert [r[0] for r in outliers.detect_anomalies_iqr(small, ["feature1"]).collect()] == [1000]
    assert outliers.flag_anomalies(small, ["feature1", "feature2"]).where("is_anomaly").count() == 1


def test_missing_is_never_anomalous(frame):
    df = frame([(1.0,), (2.0,), (None,), (math.nan,), (3.0,)], "x double")
    assert outliers.flag_anomalies(df, ["x"]).where("is_anomaly").count() == 0


def test_unknown_feature_is_refused(small):
    with pytest.raises(ValueError):
        outliers.detect_anomalies_iqr(small, ["nothing"])
    assert schema.usable_numeric(small, ["feature1", "category"]) == (["feature1"], ["category"])


def test_duplicates(frame):
    df = frame([(1, "a"), (1, "a"), (2, "b"), (2, "b"), (3, "c")], "A int, B string")
    assert quality.count_duplicated_rows(df).first()[0] == 4


def test_names(frame):
    df = frame([(1, 2, 3)], "`Feature 1` int, `Feature-2` int, `_Feature_3_` int")
    assert schema.sanitize_feature_names(df).columns == ["Feature_1", "Feature_2", "Feature_3"]
    assert schema.FeatureNameSanitizer().transform(df).columns[0] == "Feature_1"
    with pytest.raises(ValueError):
        schema.clean_column_names(frame([(1, 2)], "`a b` int, `a-b` int"))


def test_constant_columns(frame):
    df = frame([(1, None, "a", 1), (1, None, "b", None)], "c int, gone int, v string, part int")
    assert schema.constant_columns(df) == ["c", "part"]
    assert schema.drop_constant_columns(df).columns == ["gone", "v"]


def test_drop_by_name_pattern(frame):
    df = frame([(1, 2, 3)], "a_xna int, `b-1` int, c int")
    assert schema.drop_by_name_pattern(df).columns == ["c"]


def test_narrow_types(frame):
    df = frame([(127, 40000, 1.5, None)], "a bigint, b bigint, c double, d int")
    narrow, report = schema.narrow_types(df)
    assert dict(narrow.dtypes) == {"a": "tinyint", "b": "int", "c": "float", "d": "int"}
    assert report.count() == 4


def test_downcast_uses_train(frame):
    train = frame([(i, float(i), "ABC"[i % 3]) for i in range(100)], "i bigint, d double, c string")
    test = frame([(5, 1.0, "D"), (300, 2.0, "A")], "i bigint, d double, c string")
    narrow, other, model = schema.downscale_dtypes(train, test)
    assert dict(narrow.dtypes)["i"] == "tinyint" and model.types["d"] == "float"
    assert sorted(map(tuple, other.collect()), key=str) == [(5, 1.0, None), (None, 2.0, "A")]
    with pytest.raises(ValueError):
        schema.fit_downcast(train.limit(0))


def test_strict_bounds_for_downcast(frame):
    train = frame([(0,), (127,)], "i bigint")
    assert schema.fit_downcast(train).types["i"] == "smallint"
    assert schema.narrowed_types(train)["i"] == ("bigint", "tinyint")


def test_align(frame):
    df = frame([(1, 2)], "a int, b int")
    assert schema.align_columns(df, ["b", "z"]).first().asDict() == {"b": 2, "z": 0}


def test_reduction_keeps_input_order(frame):
    rows = [(i, float(i % 7), float(i), i % 2, None if i % 2 else 1.0) for i in range(40)]
    train = frame(rows, "id int, noise double, signal double, target int, gaps double")
    train = train.withColumn("signal", F.col("target") * 5 + F.col("noise") / 10)
    kept, other = quality.initial_feature_reduction(
        train, train.drop("target"), "target", essential=["id"], correlation_threshold=0.5)
    assert kept.columns == ["target", "id", "signal"] and other.columns == ["id", "signal"]
    with pytest.raises(ValueError):
        quality.initial_feature_reduction(train, train, "nothing")


def test_constant_column_has_no_correlation(frame):
    df = frame([(1.0, 0), (1.0, 1), (1.0, 1)], "x double, y int")
    assert quality.target_correlations(df, ["x"], "y") == {"x": 0.0}
    matrix = {(r.x, r.y): r.r for r in summary.correlation_matrix(df, ["x", "y"]).collect()}
    assert matrix[("x", "y")] is None and matrix[("y", "y")] == pytest.approx(1.0)
    assert len(matrix) == 4


def test_top_missing(frame):
    df = frame([(1, None, None), (None, None, 1.0), (1, 2, math.nan)], "a int, b int, c double")
    got = quality.get_top_missing_value_percentages(df, 2).collect()
    assert [(r.column_name, r.pct) for r in got] == [("b", 66.67), ("c", 66.67)]
    assert quality.get_top_missing_value_percentages(df.fillna(0), 2).count() == 0


def test_validate_data(frame):
    df = frame([(1, None)], "a int, b int")
    schema.validate_data(df, ["a"], "train")
    with pytest.raises(AssertionError):
        schema.validate_data(df, ["a", "b"], "train")


def test_histogram_edges(frame):
    df = frame([(float(i), i % 2) for i in range(5)], "x double, y int")
    got = summary.histogram_by_class(df, ["x"], "y", 4).orderBy("bin").collect()
    assert [r.n_overall for r in got] == [1, 1, 1, 2]
    same = frame([(3.0, 0)], "x double, y int")
    assert sum(r.n for r in summary.histogram(same, ["x"], 4).collect()) == 1


def test_crosstab_fills_zero_cells(frame):
    df = frame([("a", 0), ("a", 0), ("b", 1), ("c", None)], "x string, y int")
    got = {(r.x, r.y): r.n for r in summary.crosstab(df, "x", "y").collect()}
    assert got == {("a", 0): 2, ("a", 1): 0, ("b", 0): 0, ("b", 1): 1}


def test_interval(frame):
    df = frame([("g", float(v)) for v in (2, 4, 4, 4, 5, 5, 7, 9)] + [("one", 1.0)], "k string, x double")
    got = {r.k: r for r in summary.confidence_interval(df, ["k"], "x").collect()}
    assert got["g"].ci_low == pytest.approx(3.2125120822) and got["g"].ci_high == pytest.approx(6.7874879178)
    assert got["one"].mean == 1.0 and got["one"].ci_low is None


def test_derived_features(frame):
    df = frame([(0.0, 5.0, None, 1.0, -9125), (2.0, 5.0, 4.0, 1.0, -9126)],
               "amt_income_total double, amt_credit double, amt_goods_price double, "
               "amt_annuity double, days_birth int")
    a, b = features.create_derived_features(df).orderBy("amt_income_total").collect()
    assert (a.zero_income_flag, a.debt_to_income_ratio, a.credit_to_goods_ratio, a.credit_exceeds_goods) == (
        1, 1e6, None, 0)
    assert (b.zero_income_flag, b.debt_to_income_ratio, b.credit_exceeds_goods) == (0, 2.5, 1)
