"""Storage of fitted pipelines, tuning trials and trial predictions."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

TRIAL_SCHEMA = "trial_id int, params string, f2_score double, selected array<string>"


def checkpoint_path(name: str, directory: str, is_tuned: bool = False) -> str:
    """``[tuned_]<name in lower case with underscores>_checkpoint`` in the directory."""
    stem = name.lower().replace(" ", "_")
    prefix = "tuned_" if is_tuned and not stem.startswith("tuned_") else ""
    return f"{directory.rstrip('/')}/{prefix}{stem}_checkpoint"


def save_checkpoint(
    model: PipelineModel, name: str, directory: str, is_tuned: bool = False
) -> str:
    path = checkpoint_path(name, directory, is_tuned)
    model.write().overwrite().save(path)
    return path


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def load_checkpoint(name: str, directory: str, is_tuned: bool = False) -> PipelineModel | None:
    """The stored model, or None when there is none; a store or model that can't be read raises."""
    path = checkpoint_path(name, directory, is_tuned)
    if not _exists(SparkSession.getActiveSession(), path):
        return None
    return PipelineModel.load(path)


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """Trials so far; an empty table when there are none."""
    if not _exists(spark, path):
        return spark.createDataFrame([], TRIAL_SCHEMA)
    return spark.read.schema(TRIAL_SCHEMA).option("recursiveFileLookup", "true").parquet(path)


def append_trial(spark: SparkSession, path: str, trial_id: int, params: dict, f2_score: float,
                 selected: list[str] = ()) -> None:
    """Each trial is a folder of its own, so trials that end side by side don't meet, and a
    trial that runs again replaces itself."""
    row = [(trial_id, json.dumps(params, sort_keys=True), float(f2_score), list(selected))]
    spark.createDataFrame(row, TRIAL_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{path.rstrip('/')}/trial-{trial_id}")


def save_progress(predictions: DataFrame, path: str, trial_id: int) -> None:
    """Predicted labels and probabilities of one trial; a repeated trial is replaced."""
    predictions.write.mode("overwrite").parquet(f"{path}/trial_id={trial_id}")


def load_progress(spark: SparkSession, path: str, trial_id: int) -> DataFrame | None:
    folder = f"{path}/trial_id={trial_id}"
    return spark.read.parquet(folder) if _exists(spark, folder) else None
