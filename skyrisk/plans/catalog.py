"""The named query catalogue: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry reads the driver's tables (or data Spark derives from them) in
full and calls the package operators; ``plans.oracle`` holds the matching
DuckDB SQL where one exists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk.functions.rules import risk_label as risk_label_expr, risk_level
from skyrisk.functions.timeparse import parse_event_time
from skyrisk.operators.clean import clean_features, clean_required, clean_strict
from skyrisk.operators.parse import parse_events
from skyrisk.operators.windows import window_statistics
from skyrisk.plans.present import present
from skyrisk.sources import fixture as fx

QueryFn = Callable[[SparkSession, str], DataFrame]
_CATALOG: dict[str, QueryFn] = {}

WINDOW_ROUND = ["avg_temperature", "avg_humidity", "total_precipitation",
                "avg_surface_pressure", "avg_apparent_temperature"]


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _CATALOG[name] = run
        return run
    return deco


def catalog() -> dict[str, QueryFn]:
    # import side modules that register more entries
    from skyrisk.plans import catalog_ml, catalog_serving, catalog_stream  # noqa: F401
    return dict(_CATALOG)


# ------------------------------------------------------------ shared inputs
def weather(spark, sf_dir) -> DataFrame:
    return fx.load_weather(spark, sf_dir)


def parsed(spark, sf_dir) -> DataFrame:
    """Topic records derived from ``events`` -> parsed events (batch form)."""
    return parse_events(fx.topic_records(weather(spark, sf_dir)))


def processed(spark, sf_dir) -> DataFrame:
    return clean_required(parsed(spark, sf_dir))


def strict(spark, sf_dir) -> DataFrame:
    return clean_strict(parsed(spark, sf_dir))


def aggregates(spark, sf_dir, width="1 minute") -> DataFrame:
    return window_statistics(processed(spark, sf_dir), width)


def labelled(spark, sf_dir) -> DataFrame:
    df = clean_features(processed(spark, sf_dir))
    return df.withColumn("risk_label", risk_label_expr()).withColumn("risk_level", risk_level())


# ------------------------------------------------------------ B1-B7, C1
@query("parse_events")
def q_parse_events(spark, sf_dir):
    """B1+B2: JSON with fixed schema -> typed columns, bad JSON -> nulls."""
    return present(parsed(spark, sf_dir))


@query("parse_timestamp")
def q_parse_timestamp(spark, sf_dir):
    """B2: minute-format time parse; other shapes of the same instant give null."""
    ev = fx.load_table(spark, sf_dir, "events")
    raw = (F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
           .when(F.col("event_id") % 4 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
           .when(F.col("event_id") % 4 == 2, F.date_format("ts", "yyyy-MM-dd HH:mm"))
           .otherwise(F.col("event_type")))
    df = ev.select("event_id", raw.alias("raw"))
    return present(df.withColumn("parsed", parse_event_time("raw")))


@query("clean_required")
def q_clean_required(spark, sf_dir):
    """Drop on the six required columns."""
    return present(processed(spark, sf_dir))


@query("clean_strict")
def q_clean_strict(spark, sf_dir):
    """Drop on all ten columns."""
    return present(strict(spark, sf_dir))


@query("clean_features")
def q_clean_features(spark, sf_dir):
    """Drop on the eight features."""
    return present(clean_features(processed(spark, sf_dir)))


@query("risk_label")
def q_risk_label(spark, sf_dir):
    """B6+B7: rule label and its text."""
    return present(labelled(spark, sf_dir).select(
        "event_id", "temperature", "precipitation", "wind_speed", "risk_label", "risk_level"))


@query("window_stats_1m")
def q_window_stats_1m(spark, sf_dir):
    """1-minute tumbling windows per city (batch)."""
    return present(aggregates(spark, sf_dir, "1 minute"), WINDOW_ROUND)


@query("window_stats_1h")
def q_window_stats_1h(spark, sf_dir):
    """1-hour tumbling windows per city (batch)."""
    return present(aggregates(spark, sf_dir, "1 hour"), WINDOW_ROUND)
