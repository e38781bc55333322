import pytest
from pyspark.sql import functions as F

from loanloom.operators.validate import validate_applications
from loanloom.plans.scoring import SELECTED_FEATURES, preprocess, score_applications, with_expression
from loanloom.session import shared_path
from loanloom.sources import tables
from loanloom.streaming.scoring import start_scoring

GOOD = {
    "sk_id_curr": 1, "amt_income_total": 7300.0, "amt_credit": 26400.0, "amt_goods_price": 24100.0,
    "name_income_type": "Pensioner", "name_housing_type": "Rented apartment",
    "name_family_status": "Widow", "name_education_type": "Incomplete higher", "code_gender": "F",
    "flag_own_car": "N", "flag_own_realty": "Y", "days_birth": None, "age": 44, "buy_goods": False,
    "loan_term_years": 7, "existing_mortgage_payment": 120.0, "existing_loan_payments": 35.0,
    "application_time": None,
}
PROBABILITY = 0.35


@pytest.fixture()
def records(spark):
    def build(*changes):
        rows = [tuple({**GOOD, "sk_id_curr": i, **c}.values()) for i, c in enumerate(changes)]
        return spark.createDataFrame(rows, tables.APPLICATION_SCHEMA)
    return build


def decide(df):
    return score_applications(df, with_expression(F.lit(PROBABILITY)))


def test_golden_decision(records):
    r = decide(records({}))[0].first()
    assert (r.monthly_payment, r.probability_of_default, r.loan_approval, r.risk_level) == (
        373.14, 0.3526, "Approved", "Medium")
    assert not r.anomalies_detected and r.anomalies_details == []


def test_large_income_is_the_only_anomaly(records):
    r = decide(records({"amt_income_total": 2_750_000.0}))[0].first()
    assert [(a.feature, a.lower_bound, a.upper_bound) for a in r.anomalies_details] == [
        ("amt_income_total", 0.0, 1_000_000.0)]
    assert r.probability_of_default == PROBABILITY


def test_extremes(records):
    big = {"amt_income_total": 6.6e8, "amt_credit": 4.2e8, "amt_goods_price": 3.9e8, "loan_term_years": 24,
           "existing_mortgage_payment": 3.1e8, "existing_loan_payments": 2.4e8}
    small = {"amt_income_total": 0.09, "amt_credit": 0.07, "amt_goods_price": 0.08, "loan_term_years": 2,
             "existing_mortgage_payment": 0.0, "existing_loan_payments": 0.0}
    a, b = decide(records(big, small))[0].orderBy("sk_id_curr").collect()
    assert (a.monthly_payment, a.probability_of_default, a.loan_approval, a.risk_level) == (
        2506969.55, 0.3502, "Rejected", "High")
    assert len(a.anomalies_details) == 4
    assert (b.monthly_payment, b.probability_of_default, b.loan_approval) == (0.0, 0.3517, "Approved")
    assert [x.feature for x in b.anomalies_details] == ["amt_credit", "amt_annuity"]


def test_zero_income_is_rejected(records):
    r = decide(records({"amt_income_total": 0.0}))[0].first()
    assert (r.loan_approval, r.risk_level, r.reason, r.probability_of_default) == (
        "Rejected", "High", "zero_income", 1.0)


@pytest.mark.parametrize("change,reason", [
    ({"loan_term_years": 31}, "loan_term_years must be 1 to 30"),
    ({"loan_term_years": 0}, "loan_term_years must be 1 to 30"),
    ({"age": None}, "age or days_birth is required"),
    ({"age": 17}, "age must be 18 to 100"),
    ({"days_birth": 5}, "days_birth must not be positive"),
    ({"name_income_type": "Juggler"}, "name_income_type is not a known value"),
    ({"flag_own_car": "Q"}, "flag_own_car must be Y or N"),
    ({"code_gender": None}, "code_gender must be M or F"),
    ({"amt_income_total": -0.5}, "amt_income_total must be at least 0"),
    ({"amt_credit": 0.0}, "amt_credit must be above 0"),
    ({"existing_loan_payments": -2.5}, "existing_loan_payments must be at least 0"),
    ({"buy_goods": None}, "buy_goods is required")])
def test_refused(records, change, reason):
    assert validate_applications(records(change)).first()["errors"] == [reason]


def test_optional_fields(records):
    change = {"age": None, "days_birth": -10000, "existing_mortgage_payment": None}
    decisions, refused = decide(records(change))
    assert decisions.count() == 1 and refused.count() == 0


def test_features(records, spark):
    df = records({}).withColumn("application_time", F.lit("2023-07-13 08:30:00").cast("timestamp_ntz"))
    r = preprocess(df).first().asDict()
    assert len(SELECTED_FEATURES) == 40 and set(SELECTED_FEATURES) <= set(r)
    assert r["name_housing_type_rented_apartment"] == 1 and r["name_education_type"] == 2.0
    assert r["days_birth"] == -44 * 365 and r["weekday_appr_process_start_thursday"] == 1
    assert (r["code_gender"], r["flag_own_car"], r["flag_own_realty"]) == (0, 0, 1)


def test_stream_equals_batch_over_two_runs(records, spark):
    first = records({}, {"age": 9}, {"amt_credit": 31000.0})
    second = records({"sk_id_curr": 7}, {"sk_id_curr": 8, "loan_term_years": 99})
    source, out, refused, log = (shared_path(spark, n) for n in ("in", "out", "refused", "log"))
    for part in (first, second):
        part.coalesce(1).write.mode("append").json(source)
        stream = tables.read_applications(spark, source, stream=True)
        start_scoring(stream, with_expression(F.lit(PROBABILITY)), out, refused, log).awaitTermination()
    want = sorted(map(str, decide(first.unionByName(second))[0].collect()))
    assert sorted(map(str, spark.read.parquet(out).drop("batch").collect())) == want
    assert spark.read.parquet(refused).count() == 2


def test_json_text_round_trip(records, spark):
    text = tables.decision_json(decide(records({}))[0]).first()["value"]
    assert '"loan_approval":"Approved"' in text
    message = spark.createDataFrame([('{"sk_id_curr": 3, "amt_credit": 2.5}',)], "value string")
    assert tables.parse_applications(message).first()["amt_credit"] == 2.5


def test_a_stored_model_scores(records, spark):
    """Features keep their names beside the carried columns, and every record gets an outcome."""
    from loanloom.operators import models
    from loanloom.plans.scoring import with_model
    from loanloom.sources.models import load_checkpoint, save_checkpoint

    rows = records(*[{"amt_credit": 5000.0 + 900 * i, "age": 20 + i} for i in range(40)], {"age": 9})
    prepared = preprocess(rows.where("age > 17")).withColumn(
        "label", (F.col("amt_credit") > 20000).cast("double")).withColumn("weight", F.lit(1.0))
    fitted = models.model_pipeline("Logistic Regression", ["amt_credit", "days_birth"], 40).fit(prepared)
    folder = shared_path(spark, "models")
    save_checkpoint(fitted, "any", folder)
    decisions, refused = score_applications(rows, with_model(load_checkpoint("any", folder)))
    got = {r["sk_id_curr"]: r["probability_of_default"] for r in decisions.collect()}
    assert sorted(got) == list(range(40)) and got[39] > got[0]
    assert [r["sk_id_curr"] for r in refused.collect()] == [40]


def test_records_are_made_once_for_fit_and_stream(records, spark, monkeypatch):
    """The joins behind the records run once, however often the fit and the stream read them."""
    from loanloom.plans import scoring_queries

    made = spark.sparkContext.accumulator(0)

    def seen(number):
        made.add(1)
        return True

    rows = records(*[{"amt_credit": 5000.0 + 900 * i, "age": 20 + i, "code_gender": "MF"[i % 2], "flag_own_car": "YNN"[i % 3]}
                     for i in range(40)], {"age": 9})
    counted = rows.where(F.udf(seen, "boolean").asNondeterministic()("sk_id_curr"))
    monkeypatch.setattr(scoring_queries, "requests", lambda *_: counted)
    assert scoring_queries.stream_model_scored(spark, "").count() == 40
    assert made.value == 41


def test_lines_that_are_no_records_keep_their_text(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"sk_id_curr": 3, "amt_credit": "many"\nno json\n')
    _, refused = decide(tables.read_applications(spark, str(tmp_path)))
    got = refused.select("errors", "malformed").collect()
    assert [r["errors"] for r in got] == [["record is not readable"]] * 2 and got[1]["malformed"] == "no json"


def test_staged_files_go(spark):
    import os

    from loanloom.session import stage, staged_files

    with staged_files(spark):
        path = stage(spark.range(3)).inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)
