"""Test inputs derived from the driver's ``events`` table.

The reference consumes weather observations; the test data ships a generic
``events`` table.  ``weather_events`` maps each event row to one weather
observation with integer arithmetic or a short fixed chain of double
operations, so Spark and DuckDB produce bit-identical values.  Every derived
input (topic records, hourly documents, run metrics, predictions) is a Spark
job over that table, so its size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk.functions.timeparse import format_event_time
from skyrisk.schemas import EVENT_COLUMNS, HOURLY_TO_EVENT

# Fixture parameters (documented in FIXTURES.md).
BROKEN_JSON_EVERY = 97        # event_id % 97 == 0 -> a second opening brace
HOURLY_BLOCK = 1680           # event ids per hourly document block


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> "F.Column":
    return F.get_json_object("props", "$.k").cast("int")


def weather_events(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One weather observation per event row (wire form: time as string);
    ``keep`` names extra input columns to carry along."""
    k = _k()
    base_temp = (F.col("event_id") * 37 % 300) / F.lit(10.0) + F.lit(10.0)
    wind = (F.col("user_id") % 75).cast("double")
    return events.select(
        F.col("event_id"),
        F.concat(F.lit("city_"), (F.col("user_id") % 10).cast("string")).alias("city"),
        format_event_time("ts").alias("timestamp"),
        base_temp.alias("temperature"),
        F.when((F.col("event_type") == "error") & (F.col("event_id") % 5 == 0), F.lit(None))
         .otherwise(F.lit(20.0) + k * F.lit(0.8)).cast("double").alias("humidity"),
        (F.col("value") / F.lit(4.0)).alias("precipitation"),
        wind.alias("wind_speed"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None))
         .otherwise(wind + k / F.lit(10.0)).cast("double").alias("wind_gusts"),
        (F.lit(1000.0) + k / F.lit(4.0)).alias("surface_pressure"),
        (base_temp + (k - 50) / F.lit(20.0)).alias("apparent_temperature"),
        (k % 66).cast("int").alias("weather_code"),
        *(keep or []),
    )


def load_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_events(load_table(spark, sf_dir, "events"))


def topic_records(weather: DataFrame) -> DataFrame:
    """Kafka-shaped records: key = event id, value = JSON event.

    Every 97th record opens with one brace too many (broken JSON), to exercise
    the parser's bad-input path.
    """
    value = F.to_json(F.struct(*EVENT_COLUMNS))
    broken = F.col("event_id") % BROKEN_JSON_EVERY == 0
    return weather.select(
        F.col("event_id").cast("string").alias("key"),
        F.when(broken, F.concat(F.lit("{"), value)).otherwise(value).alias("value"),
    )


def hourly_documents(weather: DataFrame, named: bool = True) -> DataFrame:
    """Source documents: one struct of parallel arrays per (city, id block).

    A block spans 1,680 consecutive event ids, so a document holds about a
    week of hourly values and never more than 1,680: the group a document is
    built from is bounded whatever the data size.  Arrays are in event-id
    order.  To exercise the explode rules: ``precipitation`` lacks its last value,
    ``wind_speed_10m`` is absent, and
    ``apparent_temperature`` carries one extra trailing value.  Documents that
    are not ``named`` have neither ``doc_id`` nor ``city``.
    """
    rows = weather.select(
        "city",
        (F.col("event_id") / HOURLY_BLOCK).cast("long").alias("block"),
        F.struct(
            F.col("event_id").alias("eid"),
            F.col("timestamp").alias("time"),
            *[F.col(ev).alias(src) for src, ev in HOURLY_TO_EVENT if src != "wind_speed_10m"],
        ).alias("obs"),
    )
    docs = rows.groupBy("city", "block").agg(F.array_sort(F.collect_list("obs")).alias("o"))
    def field_of(name):
        return F.transform("o", lambda x: x[name])

    fields = {src: field_of(src) for src, _ in HOURLY_TO_EVENT if src != "wind_speed_10m"}
    fields["precipitation"] = F.slice(fields["precipitation"], F.lit(1), F.size("o") - 1)
    fields["apparent_temperature"] = F.concat(
        fields["apparent_temperature"], F.array(F.lit(None).cast("double")))
    name = [F.concat_ws("-", "city", F.col("block").cast("string")).alias("doc_id"), "city"]
    return docs.select(
        *(name if named else []),
        F.struct(
            F.transform("o", lambda x: x["time"]).alias("time"),
            *[fields[src].alias(src) for src, _ in HOURLY_TO_EVENT if src != "wind_speed_10m"],
        ).alias("hourly"),
    )


def fixture_predictions(clean_strict: DataFrame) -> DataFrame:
    """A temperature-only guess standing in for a model's output."""
    t = F.col("temperature")
    pred = F.when(t > 35, F.lit(2.0)).when(t >= 30, F.lit(1.0)).otherwise(F.lit(0.0))
    return clean_strict.withColumn("prediction", pred)


# ---------------------------------------------------------------- run metrics
def _gmt_string(c) -> "F.Column":
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("GMT"))


def fixture_jobs(events: DataFrame) -> DataFrame:
    """Job records shaped like the monitoring API's /jobs answer."""
    end = F.col("ts") + F.make_interval(secs=(F.col("user_id") % 40).cast("int"))
    return events.select(
        F.col("event_id").alias("jobId"),
        _gmt_string(F.col("ts")).alias("submissionTime"),
        F.when(F.col("event_id") % 50 == 0, F.lit(None)).otherwise(_gmt_string(end))
         .alias("completionTime"),
    )


# ---------------------------------------------------------------- event logs
def _lines_of_jobs(events: DataFrame) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    start = F.to_json(F.struct(F.lit("SparkListenerJobStart").alias("Event"),
                               F.floor(F.col("event_id") / 2).alias("Job ID"),
                               ms.alias("Submission Time")))
    end = F.when(F.col("event_id") % 50 != 0, F.to_json(F.struct(
        F.lit("SparkListenerJobEnd").alias("Event"), F.floor(F.col("event_id") / 2).alias("Job ID"),
        (ms + F.col("user_id") % 40 * 1000).alias("Completion Time"))))
    return events.select((F.col("event_id") % 2).alias("app"), F.explode(F.array(start, end)).alias("value")) \
        .where("value is not null")


def _lines_of_stages(events: DataFrame) -> DataFrame:
    def acc(name, value):
        return F.struct(F.lit(name).alias("Name"), value.cast("string").alias("Value"))
    info = F.struct(
        F.floor(F.col("event_id") / 2).alias("Stage ID"),
        F.array(acc("internal.metrics.shuffle.read.localBytesRead", F.col("event_id") * 13 % 5000),
                acc("internal.metrics.shuffle.write.bytesWritten", F.col("event_id") * 17 % 5000),
                acc("internal.metrics.jvmGCTime", F.col("user_id") % 30)).alias("Accumulables"))
    return events.select((F.col("event_id") % 2).alias("app"), F.to_json(F.struct(
        F.lit("SparkListenerStageCompleted").alias("Event"), info.alias("Stage Info"))).alias("value"))


def write_event_logs(events: DataFrame, path: str, kind: str = "jobs") -> None:
    """Rolled event logs of two applications, event ids alternately, whose job, stage
    and executor ids are the same: one plain, one gzip-packed."""
    lines = {"jobs": _lines_of_jobs, "stages": _lines_of_stages, "executors": _lines_of_executors}[kind](events)
    for app, codec in ((0, "none"), (1, "gzip")):
        lines.where(F.col("app") == app).select("value").write.option("compression", codec) \
            .text(f"{path}/eventlog_v2_app-{app}")


def fixture_stages(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("stageId"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None))
         .otherwise(F.col("event_id") * 13 % 5000).alias("shuffleReadBytes"),
        (F.col("event_id") * 17 % 5000).alias("shuffleWriteBytes"),
        (F.col("user_id") % 30).alias("jvmGcTime"),
    )


def fixture_executors(events: DataFrame) -> DataFrame:
    return (events.groupBy((F.col("user_id") % 8).alias("eid"))
            .agg(F.count("*").alias("completedTasks"),
                 F.sum("user_id").alias("totalDuration"),
                 F.sum(F.col("user_id") % 30).alias("totalGCTime"))
            .select(F.col("eid").cast("string").alias("id"),
                    F.lit(2).alias("totalCores"),
                    F.lit(455501414).cast("long").alias("maxMemory"),
                    "completedTasks", "totalDuration", "totalGCTime"))


# ---------------------------------------------------------------- query progress, executors
def progress_lines(events: DataFrame) -> DataFrame:
    """Progress JSON as a streaming query's listener gives it: five runs of two queries
    each, one batch per event, some of which overlap and some of which stand twice."""
    line = F.to_json(F.struct(
        F.concat(F.lit("run-"), (F.col("user_id") % 5).cast("string")).alias("runId"),
        F.when(F.col("event_id") % 2 == 0, "processed").otherwise("aggregates").alias("name"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        F.col("event_id").alias("batchId"), F.col("user_id").alias("numInputRows"),
        F.struct((F.col("event_id") * 7919 % 9_000_000).alias("triggerExecution")).alias("durationMs")))
    twice = F.when(F.col("event_id") % 10 == 0, F.array(line, line)).otherwise(F.array(line))
    return events.select(F.explode(twice).alias("value"))


def _lines_of_executors(events: DataFrame) -> DataFrame:
    """Executors of two applications with the same ids: added, their memory, tasks (every
    11th failed, every 13th killed), every third executor removed."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    app, executor = (F.col("event_id") % 2).alias("app"), (F.col("user_id") % 8).cast("string")
    end = F.when(F.col("event_id") % 11 == 0, "ExceptionFailure").when(F.col("event_id") % 13 == 0, "TaskKilled").otherwise("Success")
    task = F.to_json(F.struct(
        F.lit("SparkListenerTaskEnd").alias("Event"), (F.col("event_id") % 100).alias("Stage ID"), (F.col("event_id") % 3).alias("Stage Attempt ID"),
        F.struct(end.alias("Reason")).alias("Task End Reason"),
        F.struct(F.col("event_id").alias("Task ID"), executor.alias("Executor ID"), ms.alias("Launch Time"),
                 (ms + F.col("user_id")).alias("Finish Time")).alias("Task Info"),
        F.when(F.col("event_id") % 13 != 0, F.struct((F.col("user_id") * 2).alias("Executor Run Time"), (F.col("user_id") % 30).alias("JVM GC Time")))
         .alias("Task Metrics")))
    own = events.select(app, executor.alias("e"), ms.alias("ms")).groupBy("app", "e").agg(F.min("ms").alias("first"), F.max("ms").alias("last"))
    added = F.to_json(F.struct(F.lit("SparkListenerExecutorAdded").alias("Event"), F.col("first").alias("Timestamp"), F.col("e").alias("Executor ID"),
                               F.struct(F.lit("host").alias("Host"), F.lit(2).alias("Total Cores")).alias("Executor Info")))
    memory = F.to_json(F.struct(F.lit("SparkListenerBlockManagerAdded").alias("Event"), F.struct(F.col("e").alias("Executor ID")).alias("Block Manager ID"),
                                F.lit(455501414).alias("Maximum Memory"), F.col("first").alias("Timestamp")))
    removed = F.when(F.col("e").cast("int") % 3 == 0, F.to_json(F.struct(
        F.lit("SparkListenerExecutorRemoved").alias("Event"), F.col("last").alias("Timestamp"), F.col("e").alias("Executor ID"), F.lit("lost").alias("Removed Reason"))))
    life = own.select("app", F.explode(F.array(added, memory, removed)).alias("value")).where("value is not null")
    return life.unionByName(events.select(app, task.alias("value")))
