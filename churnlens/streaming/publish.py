"""Structured Streaming: staged predictions -> idempotent RunDate sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources.sinks import append_batch


def publish_staged_predictions(spark: SparkSession, staged_dir: str, schema: StructType, sink_path: str,
                               checkpoint: str | None = None, once: bool = True):
    """Start (and, with ``once``, drain) a stream that publishes every new batch of
    staged prediction files. Each micro-batch is stored below (RunDate, batch): a replay
    after a failure cannot duplicate rows, and a RunDate that arrives in several batches
    keeps all of them (``sinks.read_batches`` reads the newest row set of each member).
    A sink needs one checkpoint for its whole life; by default it stands beside the sink."""
    ckpt = checkpoint or sink_path.rstrip("/") + "-checkpoint"
    src = spark.readStream.schema(schema).parquet(staged_dir)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, sink_path, batch_id)

    w = src.writeStream.foreachBatch(upsert).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")
    q = w.start()
    if once:
        q.awaitTermination()
    return q
