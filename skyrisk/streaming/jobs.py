"""Structured Streaming jobs of the pipeline.

* processing stream: topic -> parse -> clean -> Parquet (``processed``) and
  -> watermarked window statistics -> Parquet (``aggregates``);
* scoring stream: topic -> parse -> strict clean -> model -> Parquet.

Each query has its own checkpoint under a shared folder, so a restart
resumes from the committed offsets and the file sink's commit log keeps the
output free of duplicates.  Triggers: ``availableNow`` (drain what is there,
then stop - tests, backfills, scheduled runs) or a processing-time interval
for a long-running service.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyrisk.operators.clean import clean_required, clean_strict
from skyrisk.operators.parse import parse_events
from skyrisk.operators.serving import with_key
from skyrisk.operators.windows import window_statistics
from skyrisk.sources.topic import Topic, read_topic_stream

WINDOW_WIDTH = "1 minute"     # fixed values: window width and allowed lateness
WATERMARK_DELAY = "2 minutes"


class shuffle_partitions_for_start:
    """Context: use ``n`` shuffle partitions for queries started inside it.

    A stateful query fixes its partition count (= state-store partitions)
    in its checkpoint at the first run; the stream clones the session conf
    when it starts, so setting the value only around ``start()`` leaves the
    caller's session untouched.
    """

    def __init__(self, spark: SparkSession, n: int | None):
        self.spark, self.n, self.old = spark, n, None

    def __enter__(self):
        if self.n:
            self.old = self.spark.conf.get("spark.sql.shuffle.partitions")
            self.spark.conf.set("spark.sql.shuffle.partitions", str(self.n))
        return self

    def __exit__(self, *exc):
        if self.n and self.old is not None:
            self.spark.conf.set("spark.sql.shuffle.partitions", self.old)
        return False


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create a folder on whatever file system ``path`` names (HDFS, S3 ...)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def parquet_sink(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                 trigger: str | None = "availableNow", name: str | None = None,
                 partition_by: list[str] | None = None) -> StreamingQuery:
    """K1/K2/K3: a stream into a Parquet folder (exactly-once file sink)."""
    w = (df.writeStream.format("parquet").outputMode(mode)
         .option("path", path).option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return _trigger(w, trigger).start()


def console_sink(df: DataFrame, mode: str = "append", trigger: str | None = None,
                 rows: int = 20) -> StreamingQuery:
    """K4/K5: console output (debugging only; every row goes to the driver)."""
    w = (df.writeStream.format("console").outputMode(mode)
         .option("truncate", "false").option("numRows", rows))
    return _trigger(w, trigger).start() if trigger else w.start()


def table_snapshot_sink(df: DataFrame, path: str, checkpoint: str,
                        trigger: str | None = "availableNow") -> StreamingQuery:
    """Complete-mode result kept as Parquet snapshots.

    Each micro-batch of a complete-mode query is the whole result table; it is
    written under ``path/batch=<id>`` (a retried batch writes the same again) and
    only then are snapshots before the last one removed, so a reader
    (``read_snapshot``) always finds a whole one.  The first batch of a new checkpoint
    removes the snapshots of an earlier run.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for old in _snapshots(spark, path):
            if old < batch_id - 1 or batch_id == 0 and old > 0:
                p = jvm.org.apache.hadoop.fs.Path(f"{path}/batch={old}")
                p.getFileSystem(conf).delete(p, True)

    w = (df.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def _snapshots(spark: SparkSession, path: str) -> list[int]:
    """Batch ids under ``path`` whose write was committed."""
    from skyrisk.sources.files import child_folders, path_exists
    found = [d for d in child_folders(spark, path) if d.startswith("batch=")]
    return sorted(int(d.split("=")[1]) for d in found if path_exists(spark, f"{path}/{d}/_SUCCESS"))


def read_snapshot(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The newest whole snapshot of a complete-mode query."""
    ids = _snapshots(spark, path)
    if not ids:
        if schema is None:
            raise FileNotFoundError(f"no snapshot under {path}")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{path}/batch={ids[-1]}")


def clean_stream(spark: SparkSession, topic: Topic, starting_offsets: str = "latest",
                 max_per_trigger: int | None = None, start: str | None = None,
                 checkpoints: tuple[str, ...] = (), lineage: bool = False) -> DataFrame:
    """Clean events of the topic, each with a key; ``start``, ``checkpoints`` and ``lineage`` as in ``read_topic_stream``."""
    records = read_topic_stream(spark, topic, starting_offsets, max_per_trigger, None, start, checkpoints, lineage)
    return with_key(clean_required(parse_events(records, keep=["source_file"] if lineage else None)))


def start_processing(spark: SparkSession, topic: Topic, processed_path: str,
                     aggregates_path: str, checkpoint_root: str,
                     trigger: str | None = "availableNow", starting_offsets: str = "latest",
                     max_per_trigger: int | None = None, width: str = WINDOW_WIDTH,
                     watermark: str = WATERMARK_DELAY, console: bool = False,
                     chain: bool = False,
                     state_partitions: int | None = None,
                     partition_by_date: bool = False,
                     timeout_s: float | None = None, lineage: bool = False,
                     named: bool = False) -> list[StreamingQuery]:
    """the processing job as several queries over one source.

    ``partition_by_date`` writes ``processed`` partitioned by ``event_date``
    and ``aggregates`` by ``window_date``: long-lived tables whose
    time-range reads then prune partitions (``sources.files.read_processed``
    / ``read_aggregates`` with ``since``) and whose retention is a folder
    drop.
    ``state_partitions`` sets the window query's shuffle / state-store
    partition count for a new checkpoint (default: the session's value).
    With ``chain=True`` the window query reads the ``processed`` folder as a
    stream instead of the topic, so each record is read from the topic and
    parsed once for both outputs (two queries on the topic each read and
    parse it), at the cost of one extra hop of latency.  ``max_per_trigger``
    then bounds the files of its batches too; with ``availableNow`` it starts
    when the first query has drained the topic, ``timeout_s`` at most later.
    Console sinks (``console=True``) run with the same trigger.  ``lineage`` (file topics)
    lands each event with its topic file (``source_file``), which ``streaming.backlog`` needs.
    ``named`` calls the queries ``processed`` and ``aggregates``, in a session that runs
    one such job at a time.
    """
    names = ("processed", "aggregates")
    clean = clean_stream(spark, topic, starting_offsets, max_per_trigger, f"{checkpoint_root}/start",
                         tuple(f"{checkpoint_root}/{n}" for n in names), lineage)
    if chain:
        # the window query's file source must find the folder; an empty one
        # is fine (it waits for the sink's first commit)
        ensure_dir(spark, processed_path)
    landed = clean.withColumn("event_date", F.to_date("timestamp")) if partition_by_date else clean
    queries = [parquet_sink(landed, processed_path, f"{checkpoint_root}/processed", "append",
                            trigger, names[0] if named else None, ["event_date"] if partition_by_date else None)]
    if chain:
        if trigger in (None, "availableNow"):
            await_all(spark, queries, timeout_s)
        from skyrisk.schemas import PROCESSED_SCHEMA
        reader = spark.readStream.schema(PROCESSED_SCHEMA)
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        src = reader.parquet(processed_path)
    else:
        src = clean
    stats = window_statistics(src, width, watermark)
    out = stats.withColumn("window_date", F.to_date("window_start")) if partition_by_date \
        else stats
    with shuffle_partitions_for_start(spark, state_partitions):
        queries.append(parquet_sink(out, aggregates_path, f"{checkpoint_root}/aggregates",
                                    "append", trigger, names[1] if named else None,
                                    ["window_date"] if partition_by_date else None))
    if console:
        queries.append(console_sink(clean, trigger=trigger or "availableNow"))
        queries.append(console_sink(stats, "complete", trigger=trigger or "availableNow"))
    return queries


def await_all(spark: SparkSession, queries: list[StreamingQuery],
              timeout_s: float | None = None, poll_s: float = 1.0) -> None:
    """Wait until every query has finished.  As soon as any query ends with
    an error, or the deadline passes, stop the whole group and raise - a
    caller must never read a half-written sink as done."""
    deadline = time.monotonic() + timeout_s if timeout_s else None
    failed: list[StreamingQuery] = []
    unfinished: list[str] = []
    try:
        while True:
            failed = [q for q in queries if not q.isActive and q.exception() is not None]
            active = [q for q in queries if q.isActive]
            if failed or not active:
                break
            wait = poll_s
            if deadline is not None:
                left = deadline - time.monotonic()
                if left <= 0:
                    unfinished = [str(q.id) for q in active]
                    break
                wait = min(wait, left)
            try:
                active[0].awaitTermination(wait)
            except Exception:  # noqa: BLE001 - its error is read from q.exception()
                pass
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    failed = [q for q in queries if q.exception() is not None]
    if failed:
        raise RuntimeError(f"streaming query failed: {failed[0].exception()}")
    if unfinished:
        raise TimeoutError(f"streaming queries did not finish in {timeout_s}s: {unfinished}")


def scoring_stream(spark: SparkSession, topic: Topic, model, starting_offsets: str = "latest",
                   max_per_trigger: int | None = None, start: str | None = None,
                   checkpoints: tuple[str, ...] = ()) -> DataFrame:
    """parse, strict clean (all ten columns), score, project."""
    from skyrisk.operators.ml import score
    raw = read_topic_stream(spark, topic, starting_offsets, max_per_trigger, None, start, checkpoints)
    return score(model, with_key(clean_strict(parse_events(raw))))
