"""Class weights, confusion matrices and threshold metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.operators.rank import auc, average_precision

METRICS = ["precision", "recall", "f1_score", "f2_score", "auc_roc"]


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """``class, n, balanced_weight, positive_weight`` for a 0/1 target."""
    counts = df.where(F.col(target).isin(0, 1)).groupBy(
        F.col(target).cast("int").alias("class")
    ).agg(F.count(F.lit(1)).alias("n"))
    facts = df.agg(
        F.count_if(F.col(target).isin(0, 1)).alias("rows"),
        F.count_if(F.col(target) == 1).alias("positives"),
    ).first()
    rows, positives = facts["rows"], facts["positives"]
    positive = rows / positives if positives else None
    return counts.select(
        "class", "n", (F.lit(rows) / (2 * F.col("n"))).alias("balanced_weight"),
        F.when(F.col("class") == 1, F.lit(positive)).otherwise(1.0).alias("positive_weight"),
    )


def with_weight(df: DataFrame, target: str, kind: str = "balanced", output="weight") -> DataFrame:
    """Attach the per-row training weight."""
    facts = df.agg(
        F.count(F.col(target)).alias("n"), F.count_if(F.col(target) == 1).alias("p")
    ).first()
    n, p = facts["n"], facts["p"]
    if not p or p == n:
        raise ValueError(f"{target!r} needs both classes")
    one, zero = {
        "balanced": (n / (2 * p), n / (2 * (n - p))), "positive": (n / p, 1.0), "none": (1.0, 1.0),
    }[kind]
    return df.withColumn(output, F.when(F.col(target) == 1, one).otherwise(zero))


def outcome_counts(
    df: DataFrame, scores: Sequence[str], label: str, threshold: float = 0.5
) -> DataFrame:
    """``model, tn, fp, fn, tp`` in one pass for all score columns."""
    y = F.col(label)
    cells, rows = [], []
    for i, s in enumerate(scores):
        hit = F.col(s) >= threshold
        counts = {"tn": (y == 0) & ~hit, "fp": (y == 0) & hit, "fn": (y == 1) & ~hit, "tp": (y == 1) & hit}
        cells += [F.count_if(c).alias(f"{name}{i}") for name, c in counts.items()]
        rows.append(F.struct(F.lit(s).alias("model"), *[F.col(f"{n}{i}").alias(n) for n in counts]))
    return df.agg(*cells).select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def confusion_matrix(
    df: DataFrame, scores: Sequence[str], label: str, threshold: float = 0.5
) -> DataFrame:
    """All four cells per model with the percentage of the actual class."""
    counts = outcome_counts(df, scores, label, threshold)
    cells = [("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)]
    actual_total = {0: F.col("tn") + F.col("fp"), 1: F.col("fn") + F.col("tp")}
    structs = [
        F.struct(
            F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"),
            F.try_divide(F.col(c) * 100.0, actual_total[a]).alias("pct"),
        )
        for c, a, p in cells
    ]
    return counts.select("model", F.explode(F.array(*structs)).alias("c")).select("model", "c.*")


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    b2 = beta * beta
    return F.coalesce(
        F.try_divide((1 + b2) * precision * recall, b2 * precision + recall), F.lit(0.0)
    )


def threshold_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and F2 from outcome counts; undefined values are 0."""
    precision = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0))
    recall = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0))
    specificity = F.coalesce(F.try_divide("tn", F.col("tn") + F.col("fp")), F.lit(0.0))
    return counts.select(
        "model", precision.alias("precision"), recall.alias("recall"),
        f_beta(precision, recall, 1.0).alias("f1_score"),
        f_beta(precision, recall, 2.0).alias("f2_score"),
        ((recall + specificity) / 2).alias("ext_balanced_accuracy"),
    )


def evaluate_scores(
    df: DataFrame, scores: Sequence[str], label: str, threshold: float = 0.5
) -> DataFrame:
    """One row per score column: precision, recall, F1, F2 and exact AUC."""
    basic = threshold_metrics(outcome_counts(df, scores, label, threshold))
    areas = auc(df, scores, label).withColumnRenamed("auc", "auc_roc")
    return basic.join(areas, "model").select("model", *METRICS)


def ext_evaluate_scores(
    df: DataFrame, scores: Sequence[str], label: str, threshold: float = 0.5
) -> DataFrame:
    """``ext_``: adds area under precision-recall and balanced accuracy."""
    basic = threshold_metrics(outcome_counts(df, scores, label, threshold))
    return basic.join(average_precision(df, scores, label), "model")


def long_metrics(wide: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    return wide.unpivot("model", list(metrics), "metric", "value")
