"""Training pipelines, evaluation, importances and learning curves on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.operators.fits import side_by_side
from loanloom.operators.forest import DeepForest
from loanloom.operators.metrics import (
    METRICS,
    evaluate_scores,
    outcome_counts,
    threshold_metrics,
    with_weight,
)
from loanloom.operators.rank import prefix_sum
from loanloom.operators.sampling import hash_folds, hash_key, hash_unit
from loanloom.operators.schema import FeatureNameSanitizer, sanitized_names
from loanloom.session import stage
from loanloom.sources.models import load_checkpoint, save_checkpoint

RAW, CHOSEN, LABEL, WEIGHT = "features_all", "features", "label", "weight"

# Settings of the compared models.
DEPTH = 3
FOREST_DEPTH = 5
TREES = 100
ROUNDS = 100
STEP = 0.01
SUBSAMPLE = 0.8
MIN_LEAF = 5
INVERSE_REGULARISATION = 0.1
ITERATIONS = 1000
# The selectors' trees grow as deep as the library allows.
DEEPEST_TREE = 30
MODEL_NAMES = [
    "Logistic Regression", "Decision Tree", "Random Forest", "Gradient Boosting", "XGBoost",
    "LightGBM",
]
WEIGHTS = {"Gradient Boosting": "none", "XGBoost": "positive"}


def create_pipeline(*stages) -> Pipeline:
    return Pipeline(stages=list(stages))


def importances_of(model) -> list[float]:
    """Importances of a fitted classifier, or the absolute coefficients of a linear one."""
    if hasattr(model, "featureImportances"):
        return [float(v) for v in model.featureImportances.toArray()]
    return [abs(float(v)) for v in model.coefficients.toArray()]


class ImportanceSelector(Estimator):
    """Fit a classifier (or grow a :class:`DeepForest`) and keep the vector slots whose importance
    reaches the mean."""

    def __init__(self, classifier, input_col: str = RAW, output_col: str = CHOSEN):
        super().__init__()
        self.classifier, self.input_col, self.output_col = classifier, input_col, output_col

    def _fit(self, dataset: DataFrame) -> VectorSlicer:
        if isinstance(self.classifier, DeepForest):
            scores = self.classifier.importances(dataset, self.input_col, LABEL)
        else:
            fitted = self.classifier.copy({self.classifier.featuresCol: self.input_col}).fit(dataset)
            scores = importances_of(fitted)
        mean = sum(scores) / len(scores)
        # equal importances may round to just below their mean
        kept = [i for i, s in enumerate(scores) if s >= mean * (1 - 1e-12)]
        return VectorSlicer(inputCol=self.input_col, outputCol=self.output_col, indices=kept)


def assembler(features: Sequence[str], output: str = RAW) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="error")


def model_pipeline(
    name: str, features: Sequence[str], rows: int, seed: int = 42, rounds: int = ROUNDS,
    trees: int = TREES,
) -> Pipeline:
    """The pipeline of a named model.

    The two boosting libraries the comparison also had are stood in for by ``GBTClassifier``
    with the matching class weights.
    """
    common = {"labelCol": LABEL, "seed": seed}
    weighted = {**common, "weightCol": WEIGHT}
    first = [FeatureNameSanitizer(inputCols=list(features))]
    names = sanitized_names(features)
    if name == "Logistic Regression":
        shared = {"labelCol": LABEL, "standardization": False}
        return create_pipeline(
            *first, assembler(names, "features_raw"),
            StandardScaler(inputCol="features_raw", outputCol=RAW, withMean=True, withStd=True),
            ImportanceSelector(LogisticRegression(**shared, regParam=1.0 / rows)),
            LogisticRegression(
                **shared, weightCol=WEIGHT, maxIter=ITERATIONS,
                regParam=1.0 / (INVERSE_REGULARISATION * rows)),
        )
    if name == "Decision Tree":
        selector = DeepForest(1, DEEPEST_TREE, seed, bagged=False, pruned=True)
        last = DecisionTreeClassifier(**weighted, maxDepth=DEPTH, minInstancesPerNode=MIN_LEAF)
    elif name == "Random Forest":
        selector = DeepForest(trees, DEEPEST_TREE, seed)
        last = RandomForestClassifier(
            **weighted, numTrees=trees, maxDepth=FOREST_DEPTH, minInstancesPerNode=MIN_LEAF)
    elif name in ("Gradient Boosting", "XGBoost", "LightGBM"):
        selector = GBTClassifier(**common, maxIter=rounds, maxDepth=DEPTH)
        last = GBTClassifier(
            **weighted, maxIter=rounds, maxDepth=DEPTH, stepSize=STEP, subsamplingRate=SUBSAMPLE,
            minInstancesPerNode=MIN_LEAF,
            featureSubsetStrategy="all" if name == "Gradient Boosting" else "0.8")
    else:
        raise ValueError(f"unknown model {name!r}")
    return create_pipeline(*first, assembler(names), ImportanceSelector(selector), last)


def labelled(df: DataFrame, features: Sequence[str], target: str, name: str | None = None,
             keep: Sequence[str] = ()) -> DataFrame:
    """The features, ``label`` as double and, for training, the model's ``weight``."""
    base = df.select(*keep, *features, F.col(target).cast("double").alias(LABEL))
    return with_weight(base, LABEL, WEIGHTS.get(name, "balanced"), WEIGHT) if name else base


def with_probability(scored: DataFrame, output: str = "p1") -> DataFrame:
    return scored.withColumn(output, vector_to_array("probability")[1])


def stratified_random(df: DataFrame, id_column: str, share: float, seed: int = 42,
                      output: str = "p1") -> DataFrame:
    """Baseline scores 0/1 with the class frequency, from the row's hash."""
    unit = hash_unit(id_column, seed, "guess:")
    return df.withColumn(output, F.when(unit < share, 1.0).otherwise(0.0))


def evaluate_model(
    name: str, train: DataFrame, validation: DataFrame, features: Sequence[str], target: str,
    seed: int = 42, rounds: int = ROUNDS, trees: int = TREES, directory: str | None = None,
    reuse: bool = False,
) -> tuple[DataFrame, PipelineModel]:
    """Fit (or, with ``reuse``, load) a model; one row of validation metrics."""
    model = load_checkpoint(name, directory) if reuse and directory else None
    if model is None:
        ready = labelled(train, features, target, name).persist()
        try:
            model = model_pipeline(name, features, ready.count(), seed, rounds, trees).fit(ready)
        finally:
            ready.unpersist()
        if directory:
            save_checkpoint(model, name, directory)
    scored = with_probability(model.transform(labelled(validation, features, target)), "p1")
    return score_row(name, scored), model


def score_row(name: str, scored: DataFrame, score: str = "p1", label: str = LABEL) -> DataFrame:
    flat = scored.select(F.col(score), F.col(label).cast("int").alias("label"))
    out = evaluate_scores(flat, [score], "label")
    return out.withColumn("model", F.lit(name)).select("model", *METRICS)


def f2_score(scored: DataFrame, score: str = "p1", label: str = LABEL) -> float:
    flat = scored.select(F.col(score), F.col(label).cast("int").alias("label"))
    return threshold_metrics(outcome_counts(flat, [score], "label")).first()["f2_score"]


def accuracy(scored: DataFrame) -> float:
    return scored.agg(F.avg((F.col("prediction") == F.col(LABEL)).cast("double"))).first()[0]


def top_features(importances: dict[str, float], threshold: float) -> list[str]:
    """The ``max(1, int(n * threshold))`` most important features, ties by name."""
    ordered = sorted(importances, key=lambda f: (-importances[f], f))
    return ordered[: max(1, int(len(ordered) * threshold))]


def train_and_evaluate(
    classifier: Estimator, train: DataFrame, validation: DataFrame, features: Sequence[str],
    threshold: float = 0.5,
) -> tuple[float, list[str], PipelineModel]:
    """Fit, keep the top features, refit on them; F2 on the validation table.

    Both tables carry ``label`` (and ``weight`` when the classifier uses one).
    """
    first = create_pipeline(assembler(features, CHOSEN), classifier).fit(train)
    chosen = top_features(dict(zip(features, importances_of(first.stages[-1]), strict=True)), threshold)
    second = create_pipeline(assembler(chosen, CHOSEN), classifier).fit(train)
    return f2_score(with_probability(second.transform(validation))), chosen, second


def shuffled_places(numbers: np.ndarray, total: int, seed: int, repeat: int) -> np.ndarray:
    """New places of row ``numbers`` below ``total``: a keyed one-to-one map that needs no other row.

    Six Feistel rounds over the halves of a number permute the next power of four; numbers that
    leave the range go through again until they are back in it.
    """
    half = max(1, (max(1, total - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = np.random.Generator(np.random.Philox(key=[seed % 2**64, repeat])).integers(0, 2**63, 6).astype(np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & low
        for key in keys:
            mixed = (right + key) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & low)
        return (left << np.uint64(half)) | right

    out = once(numbers.astype(np.uint64))
    away = np.flatnonzero(out >= total)
    while len(away):
        out[away] = once(out[away])
        away = away[out[away] >= total]
    return out.astype(np.int64)


def permutation_importances(
    model: Transformer, df: DataFrame, features: Sequence[str], id_column: str,
    repeats: int = 30, seed: int = 42,
) -> DataFrame:
    """``feature, importance, importance_std``: mean accuracy drop when a feature is shuffled.

    Rows are numbered once in hash order and written.  In every repeat a row's features go to
    the row that :func:`shuffled_places` names, a permutation of its own for each repeat; all
    repeats travel in one exchange, which also brings the row's own features and label.  A
    second exchange sums the hits of all features and repeats.  Features that the model does not
    read (:func:`read_features`) change no prediction and are not shuffled.
    """
    part = F.conv(F.substring("key", 1, 3), 16, 10).cast("int")
    keyed = df.select("*", hash_key(id_column, seed, "shuffle:").alias("key")).select(
        "*", part.alias("part"), F.lit("rows").alias("all"), F.lit(1).cast("bigint").alias("n"))
    rows = stage(prefix_sum(keyed, ["all"], "key", ["n"]).drop("key", "part", "all", "n"), "rows")
    base = accuracy(model.transform(rows))
    read = list(features) if base is None else read_features(model, rows, features)
    out = shuffled_hits(model, rows, features, repeats, seed, read).groupBy("feature").agg(
        F.avg(F.lit(base) - F.col("score")).alias("importance"),
        F.stddev_pop(F.lit(base) - F.col("score")).alias("importance_std"))
    rest = [(f, 0.0, 0.0) for f in features if f not in read]
    return out.unionByName(df.sparkSession.createDataFrame(rest, out.schema)) if rest else out


def read_features(model: Transformer, df: DataFrame, features: Sequence[str]) -> list[str]:
    """The features that the classifier of a pipeline reads: all, unless a slicer just before it
    takes slots out of a vector that is assembled from plain numbers and at most scaled."""
    *first, slicer, last = model.stages if isinstance(model, PipelineModel) and len(model.stages) > 2 else [None, None]
    at = next((i for i, s in enumerate(first) if isinstance(s, VectorAssembler)), None)
    plain = all(df.schema[f].dataType.typeName() in ("double", "float", "integer", "long", "short", "byte") for f in features)
    if not isinstance(slicer, VectorSlicer) or slicer.getNames() or at is None or not plain:
        return list(features)
    column = first[at].getOutputCol()
    for s in first[at + 1:]:
        if not isinstance(s, StandardScalerModel) or s.getInputCol() != column:
            return list(features)
        column = s.getOutputCol()
    if (column != slicer.getInputCol() or last.getFeaturesCol() != slicer.getOutputCol()
            or not all(isinstance(s, FeatureNameSanitizer) for s in first[:at])
            or first[at].getInputCols() != sanitized_names(features)):
        return list(features)
    return [features[i] for i in slicer.getIndices()]


def shuffled_hits(model: Transformer, rows: DataFrame, features: Sequence[str], repeats: int, seed: int,
                  shuffled: Sequence[str] | None = None) -> DataFrame:
    """``feature, repeat, score``: accuracy over numbered ``rows`` with one feature (of ``shuffled``,
    or of all) shuffled."""
    total = rows.count()
    shuffled = list(features if shuffled is None else shuffled)

    @F.pandas_udf("array<bigint>")
    def places(numbers: pd.Series) -> pd.Series:
        found = [shuffled_places(numbers.to_numpy(), total, seed, r) for r in range(repeats)]
        return pd.Series(list(np.stack(found, axis=1)) if len(numbers) else [])

    sent = rows.select(F.struct(*shuffled).alias("w"), F.posexplode(places("before_n")).alias("repeat", "place"))
    own = rows.select(F.struct(*features).alias("v"), F.lit(-1).alias("repeat"), F.col("before_n").alias("place"), LABEL)
    met = own.unionByName(sent, allowMissingColumns=True).groupBy("place").agg(
        F.max(LABEL).alias(LABEL), F.max_by("v", F.when(F.col("repeat") < 0, 1)).alias("own"),
        F.collect_list(F.when(F.col("repeat") >= 0, F.struct("repeat", "w"))).alias("others"))
    each = met.select(LABEL, "own", F.explode("others").alias("other")).select(
        LABEL, "own", "other.repeat", F.col("other.w").alias("other"),
        F.explode(F.array(*[F.lit(f) for f in shuffled])).alias("__feature"))
    both = each.select(LABEL, "repeat", "__feature", *[
        (F.when(F.col("__feature") == f, F.col("other")[f]).otherwise(F.col("own")[f]) if f in shuffled
         else F.col("own")[f]).alias(f) for f in features])
    hit = (F.col("prediction") == F.col(LABEL)).cast("double")
    return model.transform(both).groupBy(F.col("__feature").alias("feature"), "repeat").agg(F.avg(hit).alias("score"))


def extract_feature_importances(
    model: PipelineModel, df: DataFrame, features: Sequence[str], id_column: str,
    repeats: int = 30, seed: int = 42,
) -> DataFrame:
    """Built-in importances of the last stage, else permutation importances.

    Slots that a selection stage removed have importance 0.
    """
    last = model.stages[-1]
    if not hasattr(last, "featureImportances"):
        return permutation_importances(model, df, features, id_column, repeats, seed).select(
            "feature", "importance")
    kept = next((list(s.getIndices()) for s in model.stages if isinstance(s, VectorSlicer)),
                list(range(len(features))))
    found = dict(zip(kept, importances_of(last), strict=True))
    rows = [(f, found.get(i, 0.0)) for i, f in enumerate(features)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def learning_curve(
    estimator: Callable[[], Estimator] | Estimator, df: DataFrame, id_column: str,
    sizes: Sequence[float] = (0.1, 0.325, 0.55, 0.775, 1.0), folds: int = 5, seed: int = 42,
    metric: Callable[[DataFrame], float] = accuracy, at_once: int = 4,
) -> DataFrame:
    """``train_share, train_mean, train_std, test_mean, test_std`` over the folds.

    A row's fold and its place in the growing training sets come from its hash, so smaller
    training sets are contained in larger ones.  Fits run side by side, ``at_once`` at a time.
    """
    unit = hash_unit(id_column, seed, "curve:")
    ready = stage(hash_folds(df, id_column, folds, seed).withColumn("__u", unit), "folds")

    def fit(job: tuple[float, int]) -> tuple[float, int, float, float]:
        share, k = job
        train = ready.where((F.col("fold") != k) & (F.col("__u") < share))
        fitted = (estimator.copy() if isinstance(estimator, Estimator) else estimator()).fit(train)
        test = ready.where(F.col("fold") == k)
        return share, k, metric(fitted.transform(train)), metric(fitted.transform(test))

    jobs = [(float(share), k) for share in sizes for k in range(folds)]
    rows = side_by_side(df.sparkSession, fit, jobs, at_once)
    scores = df.sparkSession.createDataFrame(
        rows, "train_share double, fold int, train double, test double")
    return scores.groupBy("train_share").agg(
        F.avg("train").alias("train_mean"), F.stddev_pop("train").alias("train_std"),
        F.avg("test").alias("test_mean"), F.stddev_pop("test").alias("test_std"))
