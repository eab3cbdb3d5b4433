"""F4/K5 for large key spaces: window results kept up to date day by day.

Complete mode writes every window again in each batch.  In update mode a batch brings
only the windows that changed; they are merged into the days they belong to, and only
those days are written again, as a new version under ``path/batch=<id>/<date>=<day>``.
A day's newest version is the one in the newest batch folder that was written whole.  A
retried batch starts from the versions before it and writes the same again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from skyrisk.sinks.claims import hadoop_path
from skyrisk.sources.files import child_folders, path_exists


def _versions(spark: SparkSession, path: str, date_col: str, before: int | None = None) -> dict[str, int]:
    """Day -> newest batch that wrote it whole (of batches below ``before``)."""
    out: dict[str, int] = {}
    for folder in child_folders(spark, path):
        if folder.startswith("batch=") and path_exists(spark, f"{path}/{folder}/_SUCCESS"):
            k = int(folder.split("=")[1])
            if before is None or k < before:
                for day in child_folders(spark, f"{path}/{folder}"):
                    if day.startswith(f"{date_col}="):
                        out[day] = max(k, out.get(day, -1))
    return out


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def _retire(spark: SparkSession, path: str, date_col: str, batch_id: int) -> None:
    """Removes day versions that two newer ones have replaced, and batch folders left empty;
    the version before the newest stays for readers that listed it."""
    seen: dict[str, int] = {}
    for k in sorted((int(f.split("=")[1]) for f in child_folders(spark, path) if f.startswith("batch=")), reverse=True):
        days = [d for d in child_folders(spark, f"{path}/batch={k}") if d.startswith(f"{date_col}=")]
        for day in days:
            seen[day] = seen.get(day, 0) + 1
            if seen[day] > 2:
                _delete(spark, f"{path}/batch={k}/{day}")
        if k < batch_id - 1 and all(seen[d] > 2 for d in days):
            _delete(spark, f"{path}/batch={k}")


def merged_sink(df: DataFrame, path: str, checkpoint: str, key: tuple[str, ...] = ("city", "window_start"), time_col: str = "window_start",
                date_col: str = "window_date", trigger: str | None = "availableNow", name: str | None = None) -> StreamingQuery:
    """An update-mode aggregate into a table of days.  The first batch of a new
    checkpoint begins the table anew: its windows know nothing of those before."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changed_path = f"{path}/_changed-{batch_id}"
        batch.withColumn(date_col, F.to_date(time_col)).write.mode("overwrite").parquet(changed_path)  # the aggregation runs once
        changed = spark.read.parquet(changed_path)
        days = [f"{date_col}={r['d']}" for r in changed.select(F.col(date_col).cast("string").alias("d")).distinct().collect()]
        had = {} if batch_id == 0 else _versions(spark, path, date_col, batch_id)
        old = [f"{path}/batch={had[d]}/{d}" for d in days if d in had]
        out = changed
        if old:
            kept = spark.read.schema(batch.schema).parquet(*old).withColumn(date_col, F.to_date(time_col))
            out = kept.join(changed.select(*key), list(key), "left_anti").select(*changed.columns).unionByName(changed)
        if days:
            out.write.mode("overwrite").option("maxRecordsPerFile", 5_000_000).partitionBy(date_col).parquet(f"{path}/batch={batch_id}")
        if batch_id == 0:
            for folder in child_folders(spark, path):
                if folder.startswith("batch=") and (folder != "batch=0" or not days):
                    _delete(spark, f"{path}/{folder}")
        _delete(spark, changed_path)
        _retire(spark, path, date_col, batch_id)

    w = df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if trigger in (None, "availableNow") else w.trigger(processingTime=trigger)
    return w.start()


def read_merged(spark: SparkSession, path: str, schema: StructType, date_col: str = "window_date", since: str | None = None) -> DataFrame:
    """The table: each day's newest version; ``since``: days from there on."""
    days = _versions(spark, path, date_col)
    paths = [f"{path}/batch={k}/{d}" for d, k in sorted(days.items()) if since is None or d.split("=", 1)[1] >= since]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
