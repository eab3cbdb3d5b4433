"""Streaming query progress as data.

A ``StreamingQueryListener`` writes each ``onQueryProgress`` event as a JSON line
(one small record per micro-batch, independent of data volume) to the shared
folder; the records become a DataFrame with the input rate, processing rate, batch duration,
backlog (rows behind the latest offset) and phase times.
"""

from __future__ import annotations

import json
import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("runId", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("batchId", T.LongType()),
    T.StructField("numInputRows", T.LongType()),
    T.StructField("inputRowsPerSecond", T.DoubleType()),
    T.StructField("processedRowsPerSecond", T.DoubleType()),
    T.StructField("durationMs", T.MapType(T.StringType(), T.LongType())),
    T.StructField("eventTime", T.MapType(T.StringType(), T.StringType())),
    T.StructField("stateOperators", T.ArrayType(T.StructType([
        T.StructField("numRowsTotal", T.LongType()),
        T.StructField("numRowsUpdated", T.LongType()),
        T.StructField("numRowsDroppedByWatermark", T.LongType()),
        T.StructField("memoryUsedBytes", T.LongType()),
    ]))),
    T.StructField("sources", T.ArrayType(T.StructType([
        T.StructField("description", T.StringType()),
        T.StructField("numInputRows", T.LongType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.StringType())),
    ]))),
])


class ProgressCollector(StreamingQueryListener):
    """Writes the progress events of the session's queries under ``path``.

    Every ``every`` events, and what came in ``seconds`` if that is sooner, go out as one
    file of JSON lines in the shared folder, so neither the driver's memory nor a
    query's ring of recent batches bounds what is kept, and rare batches are not held
    back.  ``finished`` waits for queries to end and writes what is left; ``close``
    writes it and takes the listener off, also when a query failed.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 50, seconds: float = 60.0):
        self.spark, self.path, self.every, self.seconds = spark, path.rstrip("/"), every, seconds
        self.written = time.monotonic()
        self.events: list[str] = []
        self.ended: set[str] = set()
        self.lock = threading.Condition(threading.RLock())

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        with self.lock:
            self.events.append(json.dumps(json.loads(event.progress.json)))
            self._flush_if_due()

    def _flush_if_due(self) -> None:
        if len(self.events) >= self.every or time.monotonic() - self.written >= self.seconds:
            self.flush()

    def onQueryIdle(self, event):  # noqa: N802
        with self.lock:
            self._flush_if_due()

    def onQueryTerminated(self, event):  # noqa: N802
        with self.lock:
            self.flush()
            self.ended.add(str(event.runId))
            self.lock.notify_all()

    def flush(self) -> None:
        """Held events to one new file; readers see it under its name once it is whole."""
        with self.lock:
            self.written = time.monotonic()
            if not self.events:
                return
            jvm = self.spark.sparkContext._jvm
            name = f"{self.path}/events-{uuid.uuid4().hex}.json"
            tmp, final = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{name.replace('events-', '_events-')}", name))
            fs = final.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            out = fs.create(tmp)
            out.write(bytearray(("\n".join(self.events) + "\n").encode()))
            out.close()
            if not fs.rename(tmp, final):
                raise OSError(f"cannot rename {tmp} to {final}")
            self.events.clear()

    def finished(self, run_ids: list[str], timeout_s: float = 60.0) -> DataFrame:
        """Progress of all batches once the runs have ended (their last event comes
        after their end on the listener's own thread)."""
        with self.lock:
            if not self.lock.wait_for(lambda: set(run_ids) <= self.ended, timeout_s):
                raise TimeoutError(f"no end of {set(run_ids) - self.ended} in {timeout_s}s")
        return self.frame()

    def close(self) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def frame(self) -> DataFrame:
        self.flush()
        return progress_frame(self.spark.read.schema("value string").text(self.path))


def progress_frame(lines: DataFrame) -> DataFrame:
    """Progress JSON lines (column ``value``) -> typed progress table."""
    p = lines.select(F.from_json("value", PROGRESS_SCHEMA).alias("p")).select("p.*")
    # only Kafka sources say how far behind they are (a file topic: streaming.backlog)
    known = F.filter(F.transform("sources", lambda s: s["metrics"]["avgOffsetsBehindLatest"].cast("double")),
                     lambda x: x.isNotNull())
    backlog = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, b: a + b))
    return p.select(
        "runId", "name", "batchId", F.to_timestamp("timestamp").alias("timestamp"), "numInputRows",
        "inputRowsPerSecond", "processedRowsPerSecond",
        F.col("durationMs")["triggerExecution"].alias("batch_ms"),
        F.col("durationMs")["addBatch"].alias("add_batch_ms"),
        F.col("durationMs")["latestOffset"].alias("latest_offset_ms"),
        F.col("durationMs")["walCommit"].alias("wal_commit_ms"),
        F.col("durationMs")["queryPlanning"].alias("planning_ms"),
        F.aggregate(F.transform("stateOperators", lambda s: F.coalesce(
            s["numRowsDroppedByWatermark"], F.lit(0))), F.lit(0).cast("long"),
            lambda a, b: a + b).alias("rows_dropped_by_watermark"),
        backlog.alias("offsets_behind_latest"),
        F.col("eventTime")["watermark"].alias("watermark"),
    )


def throughput(progress: DataFrame) -> DataFrame:
    """Rows, busy seconds and rows/s over all batches of each query of each run."""
    g = progress.groupBy("runId", "name").agg(
        F.sum("numInputRows").alias("sent"),
        (F.sum("batch_ms") / 1000.0).alias("elapsed_s"),
        F.count(F.lit(1)).alias("batches"))
    return g.withColumn("rate_ev_s",
                        F.col("sent") / F.greatest(F.col("elapsed_s"), F.lit(1e-6)))


def throughput_wall(progress: DataFrame, run: tuple[str, ...] = ("runId", "name")) -> DataFrame:
    """C13 by the clock: what a run sent between its first batch's start and its last
    batch's end, and how much of that time it was at work.

    ``busy_s`` is the length of the union of the batches' intervals: a batch adds what
    lies beyond the farthest end of those that started before it, so overlapping batches
    count once, and ``pauses`` counts the batches that began after all before had ended.
    The farthest end is carried from hour to hour over one row per hour, so no window
    sorts more than an hour's batches of a run (or the hours of a run).  Progress rows
    that stand twice count once; rows without a time or duration do not count."""
    key = [F.col(c) for c in run]
    start = F.unix_millis("timestamp")
    rows = progress.where(F.col("timestamp").isNotNull() & F.col("batch_ms").isNotNull()) \
        .groupBy(*key, "batchId", "timestamp").agg(F.max("batch_ms").alias("ms"), F.max("numInputRows").alias("sent")) \
        .select(*run, "batchId", "sent", start.alias("at"), (start + F.col("ms")).alias("to"), F.floor(start / 3_600_000).alias("hour"))
    def same(a, b):
        cond = F.col(f"{a}.hour") == F.col(f"{b}.hour")
        for c in run:
            cond = cond & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
        return cond
    before = Window.partitionBy(*run).orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = rows.groupBy(*run, "hour").agg(F.max("to").alias("far")).withColumn("carried", F.max("far").over(before))
    earlier = Window.partitionBy(*[f"r.{c}" for c in run], "r.hour").orderBy("r.at", "r.to", "r.batchId") \
        .rowsBetween(Window.unboundedPreceding, -1)
    far = F.greatest(F.max("r.to").over(earlier), F.col("h.carried"))  # greatest skips nulls
    adds = rows.alias("r").join(hours.alias("h"), same("r", "h")).select(*[F.col(f"r.{c}") for c in run], "r.sent", "r.at", "r.to", far.alias("far"))
    g = adds.groupBy(*run).agg(
        F.sum("sent").alias("sent"), F.count(F.lit(1)).alias("batches"), (F.max("to") - F.min("at")).alias("wall"),
        F.sum(F.greatest(F.lit(0), F.col("to") - F.greatest("at", "far"))).alias("busy"), F.count_if(F.col("at") > F.col("far")).alias("pauses"))
    return g.select(*run, "sent", "batches", "pauses", (F.col("wall") / 1000.0).alias("wall_s"), (F.col("busy") / 1000.0).alias("busy_s"),
                    (F.col("sent") / F.greatest(F.col("wall") / 1000.0, F.lit(1e-6))).alias("rate_ev_s"))
