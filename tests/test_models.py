import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from loanloom.operators import metrics, models, tuning
from loanloom.session import shared_path, stage
from loanloom.sources import models as store

FEATURES = ["good", "noise", "more"]


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(600).select(
        "id", (F.col("id") * 37 % 101 / 101.0).alias("good"), (F.col("id") * 53 % 97 / 97.0).alias("noise"),
        (F.col("id") * 11 % 89 / 89.0).alias("more"))
    return df.withColumn("y", (F.col("good") + 0.2 * F.col("more") > 0.7).cast("int")).persist()


@pytest.mark.parametrize("name", ["Logistic Regression", "Decision Tree", "LightGBM"])
def test_models_learn(table, name):
    row, model = models.evaluate_model(
        name, table.where("id % 5 > 0"), table.where("id % 5 = 0"), FEATURES, "y", rounds=5)
    got = row.first()
    assert got["model"] == name and got["auc_roc"] > 0.9
    scored = models.with_probability(model.transform(models.labelled(table, FEATURES, "y")))
    exact = BinaryClassificationEvaluator(rawPredictionCol="p1", labelCol="label", numBins=0).evaluate(scored)
    mine = models.score_row(name, scored).first()["auc_roc"]
    assert mine == pytest.approx(exact)


def test_selector_keeps_the_signal(table):
    ready = models.labelled(table, FEATURES, "y", "Decision Tree")
    ready = models.assembler(FEATURES).transform(ready)
    slicer = models.ImportanceSelector(DecisionTreeClassifier(labelCol="label")).fit(ready)
    assert 0 in list(slicer.getIndices()) and 1 not in list(slicer.getIndices())


def test_unknown_model():
    with pytest.raises(ValueError):
        models.model_pipeline("nothing", FEATURES, 10)


def test_checkpoints(table, spark):
    folder = shared_path(spark, "models")
    assert store.load_checkpoint("My Model", folder) is None
    pipeline = models.create_pipeline(models.assembler(FEATURES, "features"), LogisticRegression(labelCol="y"))
    path = store.save_checkpoint(pipeline.fit(table), "My Model", folder, is_tuned=True)
    assert path.endswith("/tuned_my_model_checkpoint")
    again = store.load_checkpoint("My Model", folder, is_tuned=True)
    assert again.transform(table).count() == 600
    assert store.checkpoint_path("tuned_x", "d", True) == "d/tuned_x_checkpoint"


def test_permutation_finds_the_signal(table):
    ready = models.labelled(table, FEATURES, "y", "Decision Tree", keep=["id"])
    fitted = models.create_pipeline(
        models.assembler(FEATURES, "features"), DecisionTreeClassifier(labelCol="label")).fit(ready)
    got = {r.feature: r.importance for r in models.permutation_importances(fitted, ready, FEATURES, "id", 2).collect()}
    assert got["good"] > 0.2 and got["good"] > got["noise"] and len(got) == 3
    rows = stage(ready.withColumn("before_n", F.col("id")), "rows")
    hits = models.shuffled_hits(fitted, rows, FEATURES, 30, 1)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "Join" not in plan
    assert hits.count() == 90
    # against the same places applied by hand
    table_of = {r["before_n"]: r for r in rows.collect()}
    for repeat in (0, 29):
        place = models.shuffled_places(np.arange(600), 600, 1, repeat)
        moved = [(*(table_of[j][f] for f in FEATURES), table_of[i]["label"], table_of[j]["good"]) for j, i in enumerate(place)]
        other = [(g, table_of[i]["noise"], table_of[i]["more"], table_of[i]["label"]) for (*_, g), i in zip(moved, place)]
        df = table.sparkSession.createDataFrame([tuple(map(float, r)) for r in other], "good double, noise double, more double, label double")
        want = models.accuracy(fitted.transform(df))
        assert hits.where(f"repeat = {repeat} and feature = 'good'").first()["score"] == pytest.approx(want)


def test_unread_features_are_not_shuffled(table, monkeypatch):
    ready = models.labelled(table, FEATURES, "y", "Logistic Regression", keep=["id"])
    fitted = models.model_pipeline("Logistic Regression", FEATURES, 600).fit(ready)
    read = models.read_features(fitted, ready, FEATURES)
    assert read and len(read) < 3
    tree = models.create_pipeline(
        models.assembler(FEATURES, "features"), DecisionTreeClassifier(labelCol="label")).fit(ready)
    assert models.read_features(tree, ready, FEATURES) == models.read_features(fitted.stages[-1], ready, FEATURES) == FEATURES
    got = models.permutation_importances(fitted, ready, FEATURES, "id", 3)
    assert "Generate explode([%s])" % ",".join(read) in got._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(models, "read_features", lambda model, df, features: list(features))
    want = models.permutation_importances(fitted, ready, FEATURES, "id", 3)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_shuffles_are_permutations():
    for total in (1, 2, 3, 7, 64, 65, 1000):
        every = [models.shuffled_places(np.arange(total), total, 42, r) for r in range(6)]
        assert all(sorted(p) == list(range(total)) for p in every)
        if total > 60:
            assert len({tuple(p) for p in every}) == 6
            shifts = [(p - np.arange(total)) % total for p in every]
            assert all(len(set(s)) > total / 3 for s in shifts)
            assert all((p == np.arange(total)).sum() < 8 for p in every)


def test_top_features():
    assert models.top_features({"a": 0.1, "b": 0.7, "c": 0.2}, 0.67) == ["b", "c"]
    assert models.top_features({"a": 0.1, "b": 0.7}, 0.01) == ["b"]


def test_baseline_share(table):
    got = models.stratified_random(table, "id", 0.3).agg(F.avg("p1")).first()[0]
    assert 0.2 < got < 0.4


def test_class_weights(table):
    n1 = table.where("y = 1").count()
    got = {r["class"]: r for r in metrics.class_weights(table, "y").collect()}
    assert got[1].balanced_weight == pytest.approx(600 / (2 * n1))
    assert got[1].positive_weight == pytest.approx(600 / n1) and got[0].positive_weight == 1.0


def test_metrics_without_predictions(frame):
    df = frame([(0.1, 1), (0.2, 0)], "p double, y int")
    got = metrics.evaluate_scores(df, ["p"], "y").first()
    assert (got.precision, got.recall, got.f1_score, got.f2_score) == (0.0, 0.0, 0.0, 0.0)


def test_tuning_resumes(table, spark):
    parts = [models.labelled(table.where(c), FEATURES, "y") for c in ("id % 5 > 1", "id % 5 = 1", "id % 5 = 0")]
    path, progress = shared_path(spark, "trials"), shared_path(spark, "progress")
    options = {"overrides": {"n_estimators": ("int", 2, 3), "max_depth": ("int", 2, 3)},
               "feature_selection_threshold": 0.7, "progress_path": progress}
    one = tuning.optimize_hyperparameters(*parts, FEATURES, "xgboost", path, n_trials=1, **options)
    assert one.trials.count() == 1
    two = tuning.optimize_hyperparameters(*parts, FEATURES, "xgboost", path, n_trials=2, **options)
    assert sorted(r.trial_id for r in two.trials.collect()) == [0, 1]
    assert two.f2_score >= one.f2_score and two.metrics.count() == 1
    assert len(two.features) == 2 and two.features == two.model.stages[0].getInputCols()
    assert store.load_progress(spark, progress, 1).count() == parts[1].count()
    assert store.load_progress(spark, progress, 9) is None


def test_trials_that_end_together_are_all_kept(spark):
    from concurrent.futures import ThreadPoolExecutor

    path = shared_path(spark, "trials")
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(lambda i: store.append_trial(spark, path, i, {"a": i}, i / 40, ["x"]), range(40)))
    store.append_trial(spark, path, 7, {"a": -7}, 0.0)
    got = {r["trial_id"]: r for r in store.read_trials(spark, path).collect()}
    assert sorted(got) == list(range(40)) and got[7]["params"] == '{"a": -7}' and got[8]["selected"] == ["x"]


def test_search_space():
    space = tuning.search_space("lightgbm")
    params = tuning.sample_params(space, 42, 3)
    assert params == tuning.sample_params(space, 42, 3) != tuning.sample_params(space, 42, 4)
    assert len(params) == 8 and 20 <= params["num_leaves"] <= 3000 and 0.6 <= params["subsample"] <= 1
    with pytest.raises(ValueError):
        tuning.search_space("catboost")


def test_learning_curve(table):
    rows = models.labelled(table, FEATURES, "y", keep=["id"])
    tree = models.create_pipeline(
        models.assembler(FEATURES, "features"), DecisionTreeClassifier(labelCol="label", maxDepth=3))
    got = models.learning_curve(tree, rows, "id", sizes=(0.5, 1.0), folds=2).orderBy("train_share").collect()
    assert [r.train_share for r in got] == [0.5, 1.0] and all(0.5 < r.test_mean <= 1 for r in got)
