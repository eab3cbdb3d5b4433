"""File sinks: metric CSV, CSV / JSON exports, Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType


def write_metrics_csv(metrics: DataFrame, path: str) -> str:
    """K7: ``metric,value`` CSV with header.  The table has a handful of
    rows, so one output file is written (``coalesce(1)``)."""
    metrics.select("metric", F.col("value").cast("double")).coalesce(1) \
        .write.mode("overwrite").option("header", True).csv(path)
    return path


CSV_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def export_csv(df: DataFrame, path: str, time_format: str = CSV_TIME_FORMAT) -> str:
    """K8: table export as CSV with header (one file per task); times as
    ``2024-01-01 00:05:00``."""
    (df.write.mode("overwrite").option("header", True)
     .option("timestampFormat", time_format).option("timestampNTZFormat", time_format)
     .csv(path))
    return path


def times_as_strings(df: DataFrame, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Timestamps rendered as text (K9's JSON answer format)."""
    return df.select(*[F.date_format(F.col(f.name), fmt).alias(f.name)
                       if isinstance(f.dataType, (TimestampType, TimestampNTZType)) else F.col(f.name)
                       for f in df.schema.fields])


def export_json(df: DataFrame, path: str) -> str:
    """K9: JSON lines with timestamps as strings."""
    times_as_strings(df).write.mode("overwrite").json(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
