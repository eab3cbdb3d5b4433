"""Statistics about runs, from monitoring-API JSON records or a
Spark event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_API_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def _api_ms(c: str):
    """'2024-01-01T00:00:07.179GMT' -> epoch milliseconds (null if absent)."""
    return F.unix_millis(F.try_to_timestamp(F.substring(F.col(c), 1, 23), F.lit(_API_TIME)))


def job_duration_stats(jobs: DataFrame) -> DataFrame:
    """Average / min / max job duration in seconds; jobs without a
    completion time are left out."""
    d = jobs.select(((_api_ms("completionTime") - _api_ms("submissionTime")) / 1000.0)
                    .alias("d")).where(F.col("d").isNotNull())
    return d.agg(F.count(F.lit(1)).alias("jobs"), F.avg("d").alias("avg_s"),
                 F.min("d").alias("min_s"), F.max("d").alias("max_s"))


def stage_totals(stages: DataFrame) -> DataFrame:
    """C11: totals over stages; a missing field counts as 0."""
    return stages.agg(
        F.sum(F.coalesce("shuffleReadBytes", F.lit(0))).alias("shuffle_read_bytes"),
        F.sum(F.coalesce("shuffleWriteBytes", F.lit(0))).alias("shuffle_write_bytes"),
        F.sum(F.coalesce("jvmGcTime", F.lit(0))).alias("gc_ms"))


def executor_report(executors: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Cores, memory (MB), completed tasks, run and GC seconds; ``carry``: further columns."""
    return executors.select(
        *(carry or []), "id", F.col("totalCores").alias("cores"),
        (F.coalesce("maxMemory", F.lit(0)) / 1e6).alias("memory_mb"),
        F.coalesce("completedTasks", F.lit(0)).alias("tasks"),
        (F.coalesce("totalDuration", F.lit(0)) / 1000.0).alias("run_s"),
        (F.coalesce("totalGCTime", F.lit(0)) / 1000.0).alias("gc_s"))


# ---------------------------------------------------------------- event logs
def jobs_from_event_log(log: DataFrame) -> DataFrame:
    """Job records (``log``, ``jobId``, submission and completion time strings in
    the monitoring API's format) from ``SparkListenerJobStart`` /
    ``SparkListenerJobEnd`` lines of event logs (``scan_event_log``).

    Job ids start anew in every application, so they count within their log;
    one aggregate brings start and end together."""
    def ms_to_api(c):
        return F.when(F.col(c).isNotNull(), F.concat(
            F.date_format(F.timestamp_millis(c), _API_TIME), F.lit("GMT")))

    lines = log.where(F.col("Event").isin("SparkListenerJobStart", "SparkListenerJobEnd"))
    both = lines.select(
        "log", F.get_json_object("line", "$.Job ID").cast("long").alias("jobId"),
        F.get_json_object("line", "$.Submission Time").cast("long").alias("s"),
        F.get_json_object("line", "$.Completion Time").cast("long").alias("e"))
    return both.groupBy("log", "jobId").agg(F.max("s").alias("s"), F.max("e").alias("e")).select(
        "log", "jobId", ms_to_api("s").alias("submissionTime"), ms_to_api("e").alias("completionTime"))


def stages_from_event_log(log: DataFrame) -> DataFrame:
    """Stage records (``log``, stage id, shuffle read / write bytes, GC
    ms) from ``SparkListenerStageCompleted`` accumulables."""
    done = log.where(F.col("Event") == "SparkListenerStageCompleted").select(
        "log", F.get_json_object("line", "$['Stage Info']['Stage ID']").cast("long").alias("stageId"),
        F.from_json(F.get_json_object("line", "$['Stage Info']['Accumulables']"),
                    "array<struct<Name:string,Value:string>>").alias("acc"))

    def acc(name):
        vals = F.filter("acc", lambda a: a["Name"] == name)
        return F.get(vals, 0)["Value"].cast("long")

    return done.select(
        "log", "stageId",
        (F.coalesce(acc("internal.metrics.shuffle.read.remoteBytesRead"), F.lit(0))
         + F.coalesce(acc("internal.metrics.shuffle.read.localBytesRead"), F.lit(0)))
        .alias("shuffleReadBytes"),
        acc("internal.metrics.shuffle.write.bytesWritten").alias("shuffleWriteBytes"),
        acc("internal.metrics.jvmGCTime").alias("jvmGcTime"))


# What the executor fold reads of a line, parsed once.
_LIFE = ["SparkListenerExecutorAdded", "SparkListenerBlockManagerAdded", "SparkListenerExecutorRemoved"]
_TASK_END = "SparkListenerTaskEnd"
_EXECUTOR_LINE = """`Executor ID` string, Timestamp long, `Executor Info` struct<`Total Cores`: int>, `Block Manager ID` struct<`Executor ID`: string>,
    `Maximum Memory` long, `Stage ID` long, `Stage Attempt ID` int, `Task End Reason` struct<Reason: string>,
    `Task Info` struct<`Executor ID`: string, `Launch Time`: long, `Finish Time`: long>,
    `Task Metrics` struct<`Executor Run Time`: long, `JVM GC Time`: long>"""


def _executor_lines(log: DataFrame, events: list[str]) -> DataFrame:
    """(log, Event, fields of the line); how a task ended is told in three columns."""
    lines = log.where(F.col("Event").isin(events)).select("log", "Event", F.from_json("line", _EXECUTOR_LINE).alias("l"))
    reason = F.when(F.col("Event") == _TASK_END, F.coalesce(F.col("l")["Task End Reason"]["Reason"], F.lit("")))
    killed = reason.isin("TaskKilled", "TaskCommitDenied")
    return lines.withColumn("ok", reason == "Success").withColumn("killed", killed).withColumn(
        "failed", (reason != "Success") & ~killed & (reason != "Resubmitted")).withColumn("again", reason == "Resubmitted")


def executors_from_event_log(log: DataFrame) -> DataFrame:
    """C12 from event logs: one row per application (``log``) and executor, in the
    monitoring API's names, with failed and killed tasks and when it came and went.

    Executor ids start anew in every application.  One aggregate folds the lines of an
    executor's life and of its tasks; a resubmitted task's end counts as nothing, its
    time having counted at its first end.  Executors that no line but a task's names
    (cut logs) are there without cores."""
    d = _executor_lines(log, [*_LIFE, _TASK_END])
    f = F.col("l")
    name = F.coalesce(f["Task Info"]["Executor ID"], f["Block Manager ID"]["Executor ID"], f["Executor ID"])
    info = f["Task Info"]
    spent = F.when(F.coalesce("again", F.lit(False)), F.lit(0)).otherwise(info["Finish Time"] - info["Launch Time"])
    gc = F.when(F.coalesce("again", F.lit(False)), F.lit(0)).otherwise(f["Task Metrics"]["JVM GC Time"])
    rows = d.select("log", name.alias("id"), "Event", "ok", "failed", "killed", f["Executor Info"]["Total Cores"].alias("cores"),
                    f["Maximum Memory"].alias("memory"), f["Timestamp"].alias("at"), spent.alias("spent"), gc.alias("gc"))
    return rows.where(F.col("id").isNotNull()).groupBy("log", "id").agg(
        F.max("cores").alias("totalCores"), F.max("memory").alias("maxMemory"),
        F.count_if("ok").alias("completedTasks"), F.count_if("failed").alias("failedTasks"), F.count_if("killed").alias("killedTasks"),
        F.sum("spent").alias("totalDuration"), F.sum("gc").alias("totalGCTime"),
        F.min(F.when(F.col("Event") == _LIFE[0], F.col("at"))).alias("addedMs"),
        F.max(F.when(F.col("Event") == _LIFE[2], F.col("at"))).alias("removedMs"))


def attempts_from_event_log(log: DataFrame) -> DataFrame:
    """Tasks per application, stage and attempt: how they ended, their time and span."""
    d = _executor_lines(log, [_TASK_END]).where(~F.col("again"))
    f, info = F.col("l"), F.col("l")["Task Info"]
    return d.select("log", f["Stage ID"].alias("stageId"), f["Stage Attempt ID"].alias("attempt"), "ok", "failed", "killed",
                    f["Task Metrics"]["Executor Run Time"].alias("run"), info["Launch Time"].alias("from"), info["Finish Time"].alias("to")) \
        .groupBy("log", "stageId", "attempt").agg(
            F.count_if("ok").alias("completedTasks"), F.count_if("failed").alias("failedTasks"), F.count_if("killed").alias("killedTasks"),
            F.coalesce(F.sum("run"), F.lit(0)).alias("executorRunMs"), F.min("from").alias("firstLaunchMs"), F.max("to").alias("lastFinishMs"))
