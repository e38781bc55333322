"""Stored preparation and bundles: new sessions, SQL over exported parameters, reloads in a stream."""

import subprocess
import sys

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from loanloom.operators import encode, schema, stages
from loanloom.plans import decision_queries
from loanloom.plans.applications import applications, split_tables
from loanloom.plans.decisions import decide, split_records, start_bundle_scoring, train_bundle
from loanloom.plans.requests import REQUEST_SQL
from loanloom.plans.scoring import SELECTED_FEATURES
from loanloom.plans.scoring_queries import _ANOMALY_SQL, FEATURE_SQL
from loanloom.plans.training import ESSENTIAL, TrainingFlow
from loanloom.session import shared_path, stage, staged_files
from loanloom.sources import bundles, tables
from tests.oracle import connect

LABEL = decision_queries.LABEL


def rows_of(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_flow_is_loaded_in_another_session(spark, sf_dir, tmp_path):
    """The files of the fit are gone and another process has loaded the stages."""
    apps = applications(spark, sf_dir).select(
        "sk_id_curr", "dataset", "target_signal", "amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price",
        "days_birth", "name_income_type", "name_type_suite", "code_gender", "flag_own_car", "organization_type",
        "region_rating_client").where("sk_id_curr % 3 = 0")
    apps.write.parquet(f"{tmp_path}/apps")
    train, test = split_tables(spark.read.parquet(f"{tmp_path}/apps"))
    flow = TrainingFlow(
        "target_signal", essential=[*ESSENTIAL, "days_birth"], binary=["code_gender", "flag_own_car"],
        categorical=["name_income_type", "name_type_suite"], target_encoded=["region_rating_client"], ordinal_orders={
            "age_group": ["18-25", "26-35", "36-45", "46-55", "56-65", "65+"]})
    with staged_files(spark):
        prepared = flow.run(train, test.drop("target_signal"))
        want = rows_of(prepared.test)
        prepared.model.write().save(f"{tmp_path}/flow")
    code = f"""
from pyspark.ml import PipelineModel
from loanloom.session import build_session
spark = build_session("other", "2", 4)
test = spark.read.parquet("{tmp_path}/apps").where("dataset = 'test'").drop("dataset", "target_signal")
PipelineModel.load("{tmp_path}/flow").transform(test).write.parquet("{tmp_path}/out")
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=600, capture_output=True)
    assert rows_of(spark.read.parquet(f"{tmp_path}/out")) == want and want
    assert "target" in prepared.train.columns and "target" not in prepared.test.columns


def test_encoders_and_types_with_tables(spark, tmp_path):
    """More classes than literals, category sums, unseen, missing and oddly named values."""
    df = spark.range(600).selectExpr(
        "id", "concat('c', id % 150) AS many", "concat('g', id % 7) AS `sum:up`", "cast(id % 3 = 0 as int) AS y")
    model = encode.CategoricalEncoder(["many"], [], ["sum_up"], target_column="y").fit(df)
    kinds = schema.fit_downcast(df, "y")
    new = spark.createDataFrame([(1, "c3", "g1"), (2, "new", None), (3, None, "g9")], "id long, many string, `sum:up` string")
    for stored, table in ((stages.EncodedCategories(model), new), (stages.NarrowedTypes(kinds), new)):
        path = f"{tmp_path}/{type(stored).__name__}"
        PipelineModel([stored]).write().save(path)
        again = PipelineModel.load(path)
        assert rows_of(again.transform(table)) == rows_of(stored.transform(table))
        assert again.stages[0].uid == stored.uid


def test_empty_fits_stay_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, 5.0, 1.0, 1.0, 1.0, -9000), (2, 900.0, 1.0, 1.0, 1.0, -9000)],
                               "id long, amt_income_total double, amt_credit double, amt_goods_price double, "
                               "amt_annuity double, days_birth int")
    done = PipelineModel([stages.FenceFlag(["amt_income_total"], {}), stages.AmountFeatures({}), stages.ModeFill({})])
    done.write().save(f"{tmp_path}/empty")
    out = PipelineModel.load(f"{tmp_path}/empty").transform(df)
    assert [r["is_anomaly"] for r in out.collect()] == [0, 0] and "income_group" not in out.columns


def probability_sql(bundle):
    """The bundle's probability over SQL features: exported fences, medians, scales and coefficients."""
    features = bundle.preparation.stages[0]
    parameters = {r["feature"]: r["coefficient"] for r in bundles.linear_parameters(bundle, SELECTED_FEATURES).collect()}
    outside = " OR ".join(f"{f} < {low!r}::DOUBLE OR {f} > {high!r}::DOUBLE" for f, (low, high) in features.fences.items())
    terms = [f"{parameters['(intercept)']!r}::DOUBLE"]
    for f in SELECTED_FEATURES:
        middle, mean, spread = features.scales[f]
        value = f"CASE WHEN {outside} THEN 1 ELSE 0 END" if f == "is_anomaly" else f
        terms.append(f"{parameters[f]!r}::DOUBLE * ((coalesce({value}, {middle!r}::DOUBLE) - {mean!r}::DOUBLE) / {spread or 1.0!r}::DOUBLE)")
    return f"WITH {REQUEST_SQL.strip()} {_ANOMALY_SQL} {FEATURE_SQL} SELECT sk_id_curr, 1 / (1 + exp(-({' + '.join(terms)}))) AS p FROM features"


@pytest.fixture(scope="module")
def published(spark, sf_dir):
    return decision_queries.published(spark, sf_dir)


def test_decisions_follow_exported_parameters(spark, sf_dir, published):
    parts, folder = published
    bundle = bundles.load(spark, folder)
    test = parts.where("split = 'test'").drop("split", LABEL)
    scored = {r["sk_id_curr"]: r["probability"] for r in
              bundle.score(bundle.prepare(test)).selectExpr("__sk_id_curr AS sk_id_curr", "probability").collect()}
    want = dict(connect(sf_dir).execute(probability_sql(bundle)).fetchall())
    assert len(scored) > 100 and all(p == pytest.approx(want[i], rel=1e-9) for i, p in scored.items())
    assert len(set(map(lambda p: round(p, 6), scored.values()))) > len(scored) / 2
    seen = {r[0] for r in parts.where("split <> 'test'").select("sk_id_curr").collect()}
    assert not seen & set(scored)
    assert bundle.notes["auc_roc"] > 0.7  # on the validation part
    decisions = {r["sk_id_curr"]: r for r in decide(test, bundle)[0].collect()}
    assert set(decisions) == set(scored) and all(r["bundle_version"] == 1 for r in decisions.values())


def test_stream_takes_a_new_version_between_batches(spark, sf_dir, published, tmp_path):
    parts, first = published
    bundle = bundles.load(spark, first)
    folder, records = f"{tmp_path}/bundles", f"{tmp_path}/records"
    bundles.publish(spark, bundle, folder)
    test = parts.where("split = 'test'").drop("split", LABEL).limit(40)
    test.coalesce(1).write.json(f"{records}/a")
    stream = lambda: tables.read_applications(spark, f"{records}/*", stream=True)
    paths = [f"{tmp_path}/{n}" for n in ("scored", "refused", "log")]
    run = start_bundle_scoring(stream(), folder, *paths, trigger={"processingTime": "1 second"})
    try:
        run.processAllAvailable()
        assert bundles.publish(spark, bundle, folder) == 2
        test.coalesce(1).write.json(f"{records}/b")
        run.processAllAvailable()
    finally:
        run.stop()
    got = spark.read.parquet(paths[0])
    assert {tuple(r) for r in got.select("batch", "bundle_version").distinct().collect()} == {(0, 1), (1, 2)}
    assert got.count() == 80
    batch = rows_of(decide(test, bundles.load(spark, folder, 2))[0])
    assert rows_of(got.where("batch = 1").drop("batch")) == batch


def test_versions(spark, sf_dir, published, tmp_path):
    parts, first = published
    bundle = bundles.load(spark, first)
    folder = f"{tmp_path}/bundles"
    with pytest.raises(FileNotFoundError):
        bundles.load(spark, folder)
    bundles.publish(spark, bundle, folder)
    bundle.model.write().save(f"{folder}/version=2/model")  # a writer that failed
    assert bundles.versions(spark, folder) == [1] and bundles.publish(spark, bundle, folder) == 3
    assert bundles.load(spark, folder).version == 3 and bundles.load(spark, folder, 1).version == 1
    wrong = parts.drop("split", "amt_credit").withColumn("age", F.col("age").cast("string"))
    with pytest.raises(ValueError, match="age: string.*amt_credit: absent"):
        bundle.prepare(wrong)
    same = bundle.columns | {}
    assert bundles.fingerprint(dict(reversed(same.items()))) == bundles.fingerprint(same)


def test_refused_records_teach_nothing(spark, sf_dir):
    known = decision_queries.outcomes(spark, sf_dir).where("sk_id_curr % 2 = 0")
    parts = split_records(known, LABEL)
    assert 0 < parts.count() < known.count() and "errors" not in parts.columns
    missing = stage(parts.withColumn("flag_own_realty", F.lit("N")), "constant")
    bundle = train_bundle(missing, LABEL)
    assert all(s[2] == 0 for f, s in bundle.preparation.stages[0].scales.items() if f == "flag_own_realty")
    assert bundle.score(bundle.prepare(parts)).where("probability IS NULL").count() == 0
