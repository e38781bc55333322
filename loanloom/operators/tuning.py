"""Seeded random search over boosting settings with resumable trials."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.operators.fits import side_by_side
from loanloom.operators.metrics import with_weight
from loanloom.operators.models import (
    CHOSEN,
    LABEL,
    WEIGHT,
    score_row,
    train_and_evaluate,
    with_probability,
)
from loanloom.sources.models import append_trial, read_trials, save_checkpoint, save_progress

# Ranges of the tuned settings per model family.
SEARCH_SPACES = {
    "xgboost": {
        "max_depth": ("int", 3, 10),
        "learning_rate": ("log", 1e-3, 1.0),
        "n_estimators": ("int", 50, 1000),
        "min_child_weight": ("int", 1, 10),
        "subsample": ("uniform", 0.6, 1.0),
        "colsample_bytree": ("uniform", 0.6, 1.0),
        "gamma": ("log", 1e-8, 1.0),
        "scale_pos_weight": ("log", 1, 100),
    },
    "lightgbm": {
        "num_leaves": ("int", 20, 3000),
        "learning_rate": ("log", 1e-3, 1.0),
        "n_estimators": ("int", 50, 1000),
        "min_child_samples": ("int", 1, 300),
        "subsample": ("uniform", 0.6, 1.0),
        "colsample_bytree": ("uniform", 0.6, 1.0),
        "reg_alpha": ("log", 1e-8, 10.0),
        "reg_lambda": ("log", 1e-8, 10.0),
    },
}
DEEPEST_TREE = 30


def search_space(family: str, overrides: dict | None = None) -> dict:
    if family not in SEARCH_SPACES:
        raise ValueError(f"model family must be one of {sorted(SEARCH_SPACES)}")
    return {**SEARCH_SPACES[family], **(overrides or {})}


def sample_params(space: dict, seed: int, trial_id: int) -> dict:
    """Settings of one trial; they depend only on the seed and the trial number."""
    rng = random.Random(f"{seed}:{trial_id}")
    draw = {
        "int": lambda lo, hi: rng.randint(lo, hi),
        "uniform": lambda lo, hi: rng.uniform(lo, hi),
        "log": lambda lo, hi: math.exp(rng.uniform(math.log(lo), math.log(hi))),
    }
    return {name: draw[kind](lo, hi) for name, (kind, lo, hi) in space.items()}


def classifier_for(family: str, params: dict, seed: int = 42) -> GBTClassifier:
    """Boosted trees with the nearest Spark settings.

    ``num_leaves`` becomes the depth that can hold as many leaves; the two penalty
    settings have no counterpart and are recorded only.
    """
    depth = params.get("max_depth") or min(
        DEEPEST_TREE, math.ceil(math.log2(params.get("num_leaves", 8))))
    return GBTClassifier(
        labelCol=LABEL, featuresCol=CHOSEN, weightCol=WEIGHT, seed=seed, maxDepth=depth,
        maxIter=params["n_estimators"], stepSize=params["learning_rate"],
        minInstancesPerNode=params.get("min_child_weight") or params.get("min_child_samples", 1),
        subsamplingRate=params["subsample"],
        featureSubsetStrategy=str(round(params["colsample_bytree"], 4)),
        minInfoGain=params.get("gamma", 0.0),
    )


def weigh(df: DataFrame, params: dict) -> DataFrame:
    """Positive-class weight when the family tunes one, else balanced weights."""
    if "scale_pos_weight" in params:
        positive = F.lit(float(params["scale_pos_weight"]))
        return df.withColumn(WEIGHT, F.when(F.col(LABEL) == 1, positive).otherwise(1.0))
    return with_weight(df, LABEL, "balanced", WEIGHT)


@dataclass
class TuningResult:
    params: dict
    f2_score: float
    features: list[str]
    model: PipelineModel
    metrics: DataFrame
    trials: DataFrame


def optimize_hyperparameters(
    train: DataFrame, validation: DataFrame, test: DataFrame, features: Sequence[str],
    family: str, trials_path: str, n_trials: int = 100, seed: int = 42,
    feature_selection_threshold: float = 1.0, overrides: dict | None = None,
    parallelism: int = 2, model_directory: str | None = None, progress_path: str | None = None,
) -> TuningResult:
    """Maximise validation F2; resume at the trials that are not stored yet.

    The three tables carry the features and ``label``.  The best settings, together with
    the fixed ones, are fitted again on train and validation and scored on test.
    """
    spark, features = train.sparkSession, list(features)
    space = search_space(family, overrides)
    done = {r["trial_id"] for r in read_trials(spark, trials_path).select("trial_id").collect()}
    todo = [t for t in range(n_trials) if t not in done]
    train, validation = train.persist(), validation.persist()

    def run(trial_id: int) -> None:
        params = sample_params(space, seed, trial_id)
        f2, chosen, fitted = train_and_evaluate(
            classifier_for(family, params, seed), weigh(train, params), validation, features,
            feature_selection_threshold)
        if progress_path:
            scored = with_probability(fitted.transform(validation))
            save_progress(scored.select("prediction", F.col("p1").alias("probability")),
                          progress_path, trial_id)
        append_trial(spark, trials_path, trial_id, params, f2, chosen)

    try:
        side_by_side(spark, run, todo, max(1, parallelism), pool="trials")
        trials = read_trials(spark, trials_path)
        best = trials.orderBy(F.desc("f2_score"), "trial_id").first()
        params = json.loads(best["params"])
        both = weigh(train.unionByName(validation), params)
        # the final fit selects again, on both tables
        _, chosen, fitted = train_and_evaluate(
            classifier_for(family, params, seed), both, test, features, feature_selection_threshold)
    finally:
        train.unpersist()
        validation.unpersist()
    name = f"tuned_{family}"
    if model_directory:
        save_checkpoint(fitted, name, model_directory, is_tuned=True)
    metrics = score_row(name, with_probability(fitted.transform(test)))
    return TuningResult(params, best["f2_score"], chosen, fitted, metrics, trials)
