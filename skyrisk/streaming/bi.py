"""F8: push only changed latest rows to a BI table.

Append-mode windows never change once emitted, so "changed" means "a newer
window than the last one pushed for that city".  Per micro-batch:

1. newest window per city in the batch (``latest_per_key``);
2. left join with the last pushed window per city - a compact state table
   (one row per city) kept under ``_state/batch=<id>``; batch ``id`` reads
   ``batch=id-1`` by its path and removes older ones, so the lookup does not
   grow with the number of batches ever run;
3. keep the newer rows, BI row format, write under ``rows/batch=<id>``;
4. write the merged state under ``_state/batch=<id>``.

Both writes overwrite the batch's own folders, so a retried batch is
idempotent and never sees its own earlier attempt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skyrisk.operators.serving import bi_rows, latest_per_key
from skyrisk.sources.files import child_folders, path_exists

STATE_SCHEMA = T.StructType([
    T.StructField("City", T.StringType()),
    T.StructField("last_start", T.StringType()),
])


def changed_rows(batch: DataFrame, last: DataFrame | None) -> DataFrame:
    """Newest window per city in ``batch`` that is newer than ``last``
    (``City``, ``last_start``: ISO text, so text order is time order)."""
    latest = latest_per_key(batch, "city", "window_start")
    rows = bi_rows(latest, with_push_time=True)
    if last is None:
        return rows
    return (rows.join(last.select("City", "last_start"), "City", "left")
            .where(F.col("last_start").isNull() | (F.col("WindowStart") > F.col("last_start")))
            .drop("last_start"))


def merge_state(last: DataFrame | None, pushed: DataFrame) -> DataFrame:
    """Last pushed window per city after this batch."""
    new = pushed.select("City", F.col("WindowStart").alias("last_start"))
    if last is not None:
        new = new.unionByName(last.select("City", "last_start"))
    return new.groupBy("City").agg(F.max("last_start").alias("last_start"))


def _last_state(spark: SparkSession, state_path: str, batch_id: int) -> DataFrame | None:
    """State of the newest batch before this one: ``batch=<id - 1>`` by its path, or
    after a gap the newest that is there.  Only a missing folder means that
    nothing was pushed yet; a read that fails stops the batch."""
    path = f"{state_path}/batch={batch_id - 1}"
    if not path_exists(spark, path):
        done = [int(d.split("=")[1]) for d in child_folders(spark, state_path) if d.startswith("batch=")]
        done = [b for b in done if b < batch_id]
        if not done:
            return None
        path = f"{state_path}/batch={max(done)}"
    return spark.read.schema(STATE_SCHEMA).parquet(path)


def drop_old_states(spark: SparkSession, state_path: str, batch_id: int) -> None:
    """Removes states that neither this batch nor a retry of it reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for d in child_folders(spark, state_path):
        if d.startswith("batch=") and int(d.split("=")[1]) < batch_id - 1:
            p = jvm.org.apache.hadoop.fs.Path(f"{state_path}/{d}")
            p.getFileSystem(conf).delete(p, True)


def start_bi_push(spark: SparkSession, aggregates_stream: DataFrame, out_path: str,
                  checkpoint: str, trigger: str | None = "availableNow") -> StreamingQuery:
    rows_path, state_path = f"{out_path}/rows", f"{out_path}/_state"

    def push(batch: DataFrame, batch_id: int) -> None:
        last = _last_state(spark, state_path, batch_id)
        rows = changed_rows(batch, last).persist()
        try:
            rows.write.mode("overwrite").parquet(f"{rows_path}/batch={batch_id}")
            merge_state(last, rows).write.mode("overwrite") \
                .parquet(f"{state_path}/batch={batch_id}")
            drop_old_states(spark, state_path, batch_id)
        finally:
            rows.unpersist()

    w = aggregates_stream.writeStream.foreachBatch(push).option("checkpointLocation", checkpoint)
    if trigger in (None, "availableNow"):
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger)
    return w.start()


def pushed_rows(spark: SparkSession, out_path: str) -> DataFrame:
    """All rows pushed so far (with their ``batch`` id)."""
    return spark.read.parquet(f"{out_path}/rows")
