"""Restartable candidate generation: reference records arrive as files, targets are static."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

RECORD = "ord long, feed string, entity_id string, business_name string, business_address string, country string"


def stream_candidates(
    spark: SparkSession, source: str, sink: str, checkpoint: str, candidates: Callable[[DataFrame], DataFrame], files_per_batch: int = 1
) -> StreamingQuery:
    """Runs `candidates` on each batch of new record files and appends its rows under sink/batch=N.

    A batch overwrites its own folder, so a batch that is repeated after a failure leaves no second copy; batches
    that the checkpoint knows are not run again.
    """

    def write(batch: DataFrame, number: int) -> None:
        candidates(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    rows = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_feeds(rows: DataFrame, path: str) -> None:
    """Result rows by feed; a folder without its success marker is not complete."""
    rows.write.mode("overwrite").partitionBy("feed").parquet(path)
