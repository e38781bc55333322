"""From records with known outcomes to decisions on new ones: split, fit, publish, load, decide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loanloom.functions.scalars import present
from loanloom.operators import models
from loanloom.operators.outliers import Fences, iqr_fences, outside
from loanloom.operators.quantiles import exact_quantiles
from loanloom.operators.sampling import stratified_split
from loanloom.operators.stages import StoredStage
from loanloom.operators.validate import split_valid
from loanloom.plans.scoring import CARRIED, SELECTED_FEATURES, loan_decision, preprocess
from loanloom.session import stage
from loanloom.sources import bundles

FENCED = ("amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price")
#: Columns of a record that the features and the decision are made of.
RECORD = ["sk_id_curr", "amt_income_total", "amt_credit", "amt_goods_price", "name_income_type", "name_housing_type",
          "name_family_status", "name_education_type", "code_gender", "flag_own_car", "flag_own_realty", "days_birth",
          "age", "loan_term_years", "existing_mortgage_payment", "existing_loan_payments", "application_time"]


class RequestFeatures(StoredStage):
    """Valid records to the model's inputs: fitted fences decide ``is_anomaly``, fitted medians fill
    gaps and a fitted mean and deviation scale every input.

    ``more`` are further columns to carry; they come out as ``__<name>`` like all carried ones.
    """

    def __init__(self, fences: Fences, scales: Mapping[str, Sequence[float]], more: Sequence[str] = ()):
        super().__init__()
        self.fences = {f: (low, high) for f, (low, high) in fences.items()}
        self.scales, self.more = {f: list(v) for f, v in scales.items()}, list(more)

    def facts(self):
        return {"fences": {f: list(v) for f, v in self.fences.items()}, "scales": self.scales, "more": self.more}

    def unscaled(self, records: DataFrame) -> DataFrame:
        more = [c for c in self.more if c in records.columns]
        return preprocess(records, anomaly=outside(self.fences), carried=[*CARRIED, *more])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scaled = {f: (F.coalesce(present(f), F.lit(middle)) - mean) / (spread or 1.0)
                  for f, (middle, mean, spread) in self.scales.items()}
        return self.unscaled(dataset).withColumns(scaled)


def fit_features(train: DataFrame, more: Sequence[str] = ()) -> RequestFeatures:
    """Fences over the amounts, then medians, means and deviations of all inputs, from valid records."""
    first = RequestFeatures(iqr_fences(train, [c for c in FENCED if c in train.columns]), {}, more)
    inputs = stage(first.unscaled(train).select(SELECTED_FEATURES), "inputs")
    middle = exact_quantiles(inputs, SELECTED_FEATURES, [0.5])
    # a feature without any value is 0 everywhere
    filled = [F.coalesce(present(f), F.lit(middle[f][0] if middle[f][0] is not None else 0.0)).alias(f) for f in SELECTED_FEATURES]
    facts = inputs.select(filled).agg(*[F.struct(F.avg(f).alias("mean"), F.stddev_samp(f).alias("spread")).alias(f)
                                        for f in SELECTED_FEATURES]).first()
    return RequestFeatures(first.fences, {
        f: (float(middle[f][0] or 0.0), float(facts[f]["mean"] or 0.0), float(facts[f]["spread"] or 0.0))
        for f in SELECTED_FEATURES}, more)


def split_records(records: DataFrame, label: str, seed: int = 42) -> DataFrame:
    """Valid records with their ``split``; refused ones teach nothing."""
    # written first: below joins Catalyst derives filters from the long rules, which takes minutes
    valid = stage(split_valid(records)[0], "valid")
    return stage(stratified_split(valid, label, "sk_id_curr", seed=seed), "split")


def train_bundle(parts: DataFrame, label: str, seed: int = 42) -> bundles.Bundle:
    """Preparation and a weighted logistic regression over all inputs, both from the ``train`` part
    alone; the notes hold the metrics over the ``validation`` part."""
    part = lambda name: parts.where(F.col("split") == name).drop("split")
    train = part("train")
    features = fit_features(train, [label])
    labelled = lambda df, name=None: models.labelled(
        features.transform(df), SELECTED_FEATURES, f"__{label}", name)
    ready = stage(labelled(train, "Logistic Regression"), "ready")
    model = models.create_pipeline(
        models.assembler(SELECTED_FEATURES, models.CHOSEN),
        LogisticRegression(labelCol=models.LABEL, weightCol=models.WEIGHT, standardization=False, maxIter=200,
                           regParam=1.0 / (models.INVERSE_REGULARISATION * max(1, ready.count())))).fit(ready)
    scored = models.with_probability(model.transform(labelled(part("validation"))))
    metrics = models.score_row("Logistic Regression", scored).first().asDict()
    return bundles.Bundle(PipelineModel([features]), model, bundles.schema_of(train, RECORD),
                          notes={k: v for k, v in metrics.items() if k != "model"})


def decide(records: DataFrame, bundle: bundles.Bundle) -> tuple[DataFrame, DataFrame]:
    """Decisions for the valid records, with the bundle's version, and the refused records."""
    valid, refused = split_valid(records)
    decisions = loan_decision(bundle.score(bundle.prepare(valid)))
    return decisions.withColumn("bundle_version", F.lit(bundle.version)), refused


def start_bundle_scoring(
    records: DataFrame, folder: str, decisions_path: str, refused_path: str, checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """A running stream that decides every micro-batch by the newest complete version in ``folder``.

    Versions are looked up between micro-batches and loaded when they change.  A batch that is
    repeated after a failure replaces its own files, with the version of the repetition.
    """
    spark = records.sparkSession
    loaded: dict[str, bundles.Bundle] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = bundles.versions(spark, folder)[-1:]
        if "now" not in loaded or newest != [loaded["now"].version]:
            loaded["now"] = bundles.load(spark, folder)
        cached = batch.persist()
        try:
            decisions, refused = decide(cached, loaded["now"])
            decisions.write.mode("overwrite").parquet(f"{decisions_path}/batch={batch_id}")
            refused.write.mode("overwrite").parquet(f"{refused_path}/batch={batch_id}")
        finally:
            cached.unpersist()

    return (
        records.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
