"""Event-time tumbling-window statistics per city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyrisk.schemas import AGGREGATE_COLUMNS


def window_aggregates() -> list[Column]:
    """The ten statistics of a window, all algebraic (partial + final)."""
    return [
        F.avg("temperature").alias("avg_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.min("temperature").alias("min_temperature"),
        F.avg("humidity").alias("avg_humidity"),
        F.sum("precipitation").alias("total_precipitation"),
        F.max("wind_speed").alias("max_wind_speed"),
        F.max("wind_gusts").alias("max_wind_gusts"),
        F.avg("surface_pressure").alias("avg_surface_pressure"),
        F.avg("apparent_temperature").alias("avg_apparent_temperature"),
        F.count(F.lit(1)).alias("event_count"),
    ]


# What a stream keeps of each statistic until its window closes, in the order above.
_MEAN, _ONE = (("sum", "double"), ("count", "long")), (("value", "double"),)
WINDOW_STATE = [
    ("avg_temperature", _MEAN), ("max_temperature", _ONE), ("min_temperature", _ONE), ("avg_humidity", _MEAN),
    ("total_precipitation", _ONE), ("max_wind_speed", _ONE), ("max_wind_gusts", _ONE), ("avg_surface_pressure", _MEAN),
    ("avg_apparent_temperature", _MEAN), ("event_count", (("value", "long"),)),
]


def window_statistics(clean: DataFrame, width: str = "1 minute",
                      watermark: str | None = None,
                      time_col: str = "timestamp") -> DataFrame:
    """Group by (tumbling window, city) and flatten the window struct.

    With ``watermark`` set (streams), append mode emits a window once the
    watermark passes its end.  All ten statistics are algebraic, so the
    plan is HashAggregate(partial) -> Exchange(window, city) ->
    HashAggregate(final): a hot city is pre-reduced on every map task and
    only one row per (window, city, task) crosses the shuffle.
    """
    df = clean
    if watermark:
        df = df.withWatermark(time_col, watermark)
    stats = df.groupBy(F.window(F.col(time_col), width).alias("window"), F.col("city")) \
              .agg(*window_aggregates())
    return stats.select(
        "city",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *AGGREGATE_COLUMNS[3:],
    )


def closed_windows(stats: DataFrame, max_event_time: Column, delay_seconds: int) -> DataFrame:
    """Batch statement of the append-mode emission rule: a window is final
    once ``window_end <= max(event time) - delay``."""
    return stats.where(
        F.col("window_end") <= max_event_time - F.make_interval(secs=F.lit(delay_seconds)))
