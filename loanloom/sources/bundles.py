"""Versioned bundles of preparation and model in one folder.

``<folder>/version=<n>`` holds the two fitted pipelines and, written last, a manifest with the
schema they expect; a version without a manifest isn't there yet.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_of(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    kinds = dict(df.dtypes)
    return {c: kinds[c] for c in columns}


def fingerprint(columns: dict[str, str]) -> str:
    """Names and types in order of names, so that the order of a table's columns doesn't matter."""
    return hashlib.sha256(json.dumps(sorted(columns.items())).encode()).hexdigest()


@dataclass
class Bundle:
    """What a table needs to become probabilities: ``preparation``, then ``model``."""

    preparation: PipelineModel
    model: PipelineModel
    columns: dict[str, str]
    version: int = 0
    notes: dict = field(default_factory=dict)

    def check(self, df: DataFrame) -> None:
        """Raise unless ``df`` has the columns the bundle was fitted on, with their types."""
        have = dict(df.dtypes)
        wrong = [f"{c}: {have.get(c, 'absent')} instead of {t}" for c, t in self.columns.items() if have.get(c) != t]
        if wrong:
            raise ValueError(f"the table doesn't fit version {self.version}: {'; '.join(wrong)}")

    def prepare(self, df: DataFrame) -> DataFrame:
        self.check(df)
        return self.preparation.transform(df)

    def score(self, prepared: DataFrame) -> DataFrame:
        """``prepared`` with the ``probability`` of class 1."""
        return self.model.transform(prepared).withColumn("probability", vector_to_array("probability")[1])


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Complete versions, oldest first."""
    fs, path = _files(spark, folder)
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = re.fullmatch(r"version=(\d+)", status.getPath().getName())
        if name and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{status.getPath()}/manifest/_SUCCESS")):
            found.append(int(name[1]))
    return sorted(found)


def publish(spark: SparkSession, bundle: Bundle, folder: str) -> int:
    """Write ``bundle`` as the version after the newest one; a folder left by a failed writer is passed over."""
    fs, path = _files(spark, folder)
    taken = [int(m[1]) for s in (fs.listStatus(path) if fs.exists(path) else [])
             if (m := re.fullmatch(r"version=(\d+)", s.getPath().getName()))]
    number = max(taken, default=0) + 1
    own = f"{folder.rstrip('/')}/version={number}"
    bundle.preparation.write().save(f"{own}/preparation")
    bundle.model.write().save(f"{own}/model")
    manifest = json.dumps({"version": number, "columns": bundle.columns, "fingerprint": fingerprint(bundle.columns),
                           "notes": bundle.notes}, sort_keys=True)
    spark.createDataFrame([(manifest,)], T.StructType([T.StructField("value", T.StringType())])).coalesce(1).write.text(
        f"{own}/manifest")
    return number


def load(spark: SparkSession, folder: str, version: int | None = None) -> Bundle:
    """One version, the newest by default; a manifest whose fingerprint doesn't match its schema raises."""
    there = versions(spark, folder)
    if not there or (version is not None and version not in there):
        raise FileNotFoundError(f"no version {version or ''} in {folder}")
    number = there[-1] if version is None else version
    own = f"{folder.rstrip('/')}/version={number}"
    found = json.loads(spark.read.text(f"{own}/manifest").first()[0])
    if fingerprint(found["columns"]) != found["fingerprint"]:
        raise ValueError(f"the manifest of {own} was changed")
    return Bundle(PipelineModel.load(f"{own}/preparation"), PipelineModel.load(f"{own}/model"), found["columns"],
                  number, found["notes"])


def linear_parameters(bundle: Bundle, features: Sequence[str]) -> DataFrame:
    """``feature, coefficient`` of a bundle's linear model on unscaled inputs, the intercept as ``(intercept)``."""
    last = bundle.model.stages[-1]
    rows = [("(intercept)", float(last.intercept))] + list(zip(features, (float(v) for v in last.coefficients), strict=True))
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "feature string, coefficient double").orderBy(F.col("feature"))
