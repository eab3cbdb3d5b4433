"""A2: Spark's built-in generator sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def rate_stream(spark: SparkSession, rows_per_second: int = 5000,
                partitions: int | None = None) -> DataFrame:
    """``(timestamp, value)`` rows at a fixed rate (wall-clock paced)."""
    r = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if partitions:
        r = r.option("numPartitions", partitions)
    return r.load()


def rate_micro_batch(spark: SparkSession, rows_per_batch: int, start_ms: int = 0,
                     advance_ms: int = 1000, partitions: int | None = None) -> DataFrame:
    """Deterministic form: a fixed number of rows per micro-batch with
    event times advancing by ``advance_ms`` per batch (for tests)."""
    r = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
         .option("startTimestamp", start_ms).option("advanceMillisPerBatch", advance_ms))
    if partitions:
        r = r.option("numPartitions", partitions)
    return r.load()
