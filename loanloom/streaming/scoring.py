"""Continuous application scoring.

Scoring keeps no state between records, so the stream runs in append mode without a
watermark.  Each micro-batch goes to two sinks, decisions and refused records; both are
written under the batch number, so a batch repeated after a failure replaces its own files
instead of adding rows twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from loanloom.operators.quantiles import QuantileBins
from loanloom.plans.scoring import score_applications


def start_scoring(
    records: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    decisions_path: str,
    refused_path: str,
    checkpoint: str,
    bins: dict[str, QuantileBins] | None = None,
    anomaly: Column | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start scoring a stream of records; ``trigger`` defaults to everything available."""

    def write(batch: DataFrame, batch_id: int) -> None:
        cached = batch.persist()
        try:
            decisions, refused = score_applications(cached, score, bins, anomaly)
            decisions.write.mode("overwrite").parquet(f"{decisions_path}/batch={batch_id}")
            refused.write.mode("overwrite").parquet(f"{refused_path}/batch={batch_id}")
        finally:
            cached.unpersist()

    return (
        records.writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_decision_stream(
    records: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
    bins: dict[str, QuantileBins] | None = None,
) -> StreamingQuery:
    """Decisions only, with the file sink's exactly-once log."""
    decisions, _ = score_applications(records, score, bins)
    return (
        decisions.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
