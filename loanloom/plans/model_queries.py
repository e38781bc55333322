"""Registered queries: model training, tuning, importances, learning curve."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom.functions.scalars import present
from loanloom.operators import models, sampling, tuning
from loanloom.operators.features import create_derived_features
from loanloom.operators.metrics import METRICS
from loanloom.operators.quantiles import exact_quantiles
from loanloom.plans.applications import applications, orders, split_tables
from loanloom.plans.quality_queries import rounded
from loanloom.plans.registry import query
from loanloom.plans.training import ESSENTIAL, TrainingFlow
from loanloom.session import dealt, shared_path, stage
from loanloom.sources.models import load_checkpoint, save_checkpoint
from loanloom.sources.tables import submission

TARGET = "target_signal"
FEATURES = ["amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price", "days_birth",
            "days_id_publish", "debt_to_income_ratio", "credit_to_goods_ratio",
            "credit_exceeds_goods"]


def splits(spark, sf_dir, features=FEATURES):
    """All rows in the three parts of the stratified split; gaps hold the training part's medians."""
    apps = create_derived_features(applications(spark, sf_dir))
    # the split reads its table several times: the joins are run once, and fits pass over equal parts
    table = stage(dealt(apps.select("sk_id_curr", TARGET, *features), orders(spark, sf_dir)), "applications")
    parts = stage(sampling.stratified_split(table, TARGET, "sk_id_curr"), "split")
    middle = exact_quantiles(parts.where("split = 'train'"), features, [0.5])
    filled = parts.withColumns({f: F.coalesce(present(f), F.lit(middle[f][0])) for f in features})
    return [filled.where(F.col("split") == s).drop("split") for s in ("train", "validation", "test")]


def _evaluated(name):
    def run(spark, sf_dir):
        train, validation, _ = splits(spark, sf_dir)
        return models.evaluate_model(name, train, validation, FEATURES, TARGET)[0]

    return run


for _name in models.MODEL_NAMES:
    query("model_" + _name.lower().replace(" ", "_"))(_evaluated(_name))


# The split and the guesses are md5 rules; with scores of 0 and 1 the area is the mean of both rates.
@query("model_random_baseline", """, s AS (SELECT sk_id_curr, target_signal AS y,
  row_number() OVER (PARTITION BY target_signal ORDER BY md5('42:' || sk_id_curr), sk_id_curr) AS rn,
  round_even(0.2::DOUBLE * count(*) OVER (PARTITION BY target_signal), 0) AS t,
  count(*) OVER (PARTITION BY target_signal) AS n FROM application),
p AS (SELECT *, CASE WHEN rn <= t THEN 'test' WHEN rn <= t + round_even(0.25::DOUBLE * (n - t), 0)
  THEN 'validation' ELSE 'train' END AS split FROM s),
g AS (SELECT y, CAST('0x' || substr(md5('42:guess:' || sk_id_curr), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE
  < (SELECT avg(CAST(y AS DOUBLE)) FROM p WHERE split = 'train') AS hit FROM p WHERE split = 'validation'),
c AS (SELECT CAST(count(*) FILTER (y = 1 AND hit) AS DOUBLE) AS tp, CAST(count(*) FILTER (y = 0 AND hit) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (y = 1) AS DOUBLE) AS p, CAST(count(*) FILTER (y = 0) AS DOUBLE) AS n FROM g),
r AS (SELECT coalesce(tp / nullif(tp + fp, 0), 0.0::DOUBLE) AS a, coalesce(tp / nullif(p, 0), 0.0::DOUBLE) AS b, fp / n AS f FROM c)
SELECT 'Dummy Classifier' AS model, round(a, 8) AS precision, round(b, 8) AS recall,
  round(coalesce(2 * a * b / nullif(a + b, 0), 0.0::DOUBLE), 8) AS f1_score,
  round(coalesce(5 * a * b / nullif(4 * a + b, 0), 0.0::DOUBLE), 8) AS f2_score,
  round((1 + b - f) / 2, 8) AS auc_roc FROM r""")
def model_random_baseline(spark, sf_dir):
    train, validation, _ = splits(spark, sf_dir)
    share = train.agg(F.avg(TARGET)).first()[0]
    scored = models.stratified_random(validation, "sk_id_curr", share)
    return rounded(models.score_row("Dummy Classifier", scored, label=TARGET), *METRICS, digits=8)


@query("batch_scored_submission")
def batch_scored_submission(spark, sf_dir):
    """A stored model loaded again and applied to the test rows."""
    train, _, test = splits(spark, sf_dir)
    ready = models.labelled(train, FEATURES, TARGET, "Decision Tree")
    fitted = models.model_pipeline("Decision Tree", FEATURES, ready.count()).fit(ready)
    folder = shared_path(spark, "models")
    save_checkpoint(fitted, "Decision Tree", folder)
    model = load_checkpoint("Decision Tree", folder)
    scored = models.with_probability(model.transform(
        models.labelled(test, FEATURES, TARGET, keep=["sk_id_curr"])))
    return submission(scored, "sk_id_curr", "p1")


@query("feature_importances")
def feature_importances(spark, sf_dir):
    train, validation, _ = splits(spark, sf_dir)
    ready = models.labelled(train, FEATURES, TARGET, "Random Forest")
    fitted = models.model_pipeline("Random Forest", FEATURES, ready.count()).fit(ready)
    return models.extract_feature_importances(fitted, validation, FEATURES, "sk_id_curr")


@query("permutation_importance")
def permutation_importance(spark, sf_dir):
    train, validation, _ = splits(spark, sf_dir)
    ready = models.labelled(train, FEATURES, TARGET, "Logistic Regression")
    fitted = models.model_pipeline("Logistic Regression", FEATURES, ready.count()).fit(ready)
    rows = models.labelled(validation, FEATURES, TARGET, keep=["sk_id_curr"])
    return rounded(models.permutation_importances(fitted, rows, FEATURES, "sk_id_curr"),
                   "importance", "importance_std")


@query("learning_curve")
def learning_curve(spark, sf_dir):
    train, _, _ = splits(spark, sf_dir)
    from pyspark.ml.classification import DecisionTreeClassifier

    rows = models.labelled(train, FEATURES, TARGET, keep=["sk_id_curr"])
    tree = models.create_pipeline(
        models.assembler(FEATURES, "features"),
        DecisionTreeClassifier(labelCol="label", maxDepth=3, seed=42))
    return models.learning_curve(tree, rows, "sk_id_curr")


@query("tuning_trials")
def tuning_trials(spark, sf_dir):
    parts = [models.labelled(p, FEATURES, TARGET) for p in splits(spark, sf_dir)]
    result = tuning.optimize_hyperparameters(
        *parts, FEATURES, "xgboost", shared_path(spark, "trials"), n_trials=3,
        feature_selection_threshold=0.5,
        overrides={"n_estimators": ("int", 5, 10), "max_depth": ("int", 3, 5)})
    return result.trials.join(result.metrics.select(
        F.col("f2_score").alias("test_f2"), F.lit(result.f2_score).alias("f2_score")), "f2_score", "left")


@query("prepared_training_table")
def prepared_training_table(spark, sf_dir):
    """All preparation steps in a row, from applications with gaps to encoded numbers."""
    apps = stage(applications(spark, sf_dir).select(
        "sk_id_curr", "dataset", TARGET, "amt_income_total", "amt_credit", "amt_annuity",
        "amt_goods_price", "days_birth", "days_id_publish", "name_income_type", "name_type_suite",
        "code_gender", "flag_own_car", "region_rating_client", "organization_type",
        "weekday_appr_process_start"), "raw")
    train, test = split_tables(apps)
    flow = TrainingFlow(
        TARGET, essential=[*ESSENTIAL, "days_birth"], binary=["code_gender", "flag_own_car"],
        categorical=["name_income_type", "name_type_suite", "weekday_appr_process_start"])
    return flow.run(train, test.drop(TARGET)).train
