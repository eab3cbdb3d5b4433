"""A zone map: per data file of a landed table its rows and its oldest and newest time.

A stream over the table writes the rows of each micro-batch's files into a folder of its
own (a retried batch writes the same again).  The newest N rows are then found by reading
the few files that can hold them, whether or not the table is partitioned by date.  Files
that the map does not know yet are read as well, so an old map costs time and no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from skyrisk.sources.files import list_files, path_exists, scan_parquet

ZONE_SCHEMA = StructType([StructField("file", StringType()), StructField("rows", LongType()),
                          StructField("oldest", TimestampType()), StructField("newest", TimestampType())])


def start_zones(spark: SparkSession, path: str, time_col: str, zones: str, checkpoint: str, trigger: str | None = "availableNow",
                max_per_trigger: int | None = None, name: str | None = None) -> StreamingQuery:
    """Follows the table under ``path``: one row per new file, from its time column alone."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy("file").agg(F.count("time").alias("rows"), F.min("time").alias("oldest"), F.max("time").alias("newest")) \
            .write.mode("overwrite").parquet(f"{zones}/batch={batch_id}")

    reader = spark.readStream.schema(StructType([StructField(time_col, TimestampType())]))
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    rows = reader.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col(time_col).alias("time"))
    w = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if trigger in (None, "availableNow") else w.trigger(processingTime=trigger)
    return w.start()


def read_zones(spark: SparkSession, zones: str) -> DataFrame:
    """One row per file; a map built twice (a new checkpoint) says the same twice."""
    return scan_parquet(spark, zones, ZONE_SCHEMA).groupBy("file").agg(
        F.max("rows").alias("rows"), F.min("oldest").alias("oldest"), F.max("newest").alias("newest"))


def files_of_newest(spark: SparkSession, path: str, zones: str, n: int) -> list[str] | None:
    """Paths of the files that hold the newest ``n`` rows of the table; None: any may.

    Files whose oldest times are the newest certainly give ``n`` rows from some time t on
    (at most ``n`` rows of the map tell t); every other file that counts reaches t."""
    files = list_files(spark, path, recursive=True).where("path like '%.parquet'").join(read_zones(spark, zones), "file", "left")
    sure, since = 0, None
    for r in files.where("rows > 0").orderBy(F.desc("oldest")).select("rows", "oldest", F.unix_micros("oldest").alias("us")).limit(n).collect():
        sure += r["rows"]
        if sure >= n:
            since = r["us"]
            break
    if since is None:
        return None
    picked = files.where(F.col("rows").isNull() | (F.col("newest") >= F.timestamp_micros(F.lit(since))))
    return [r["path"] for r in picked.select("path").collect()]


def scan_newest(spark: SparkSession, path: str, zones: str, schema: StructType, n: int) -> DataFrame:
    """Rows of the table, at least its newest ``n`` by the map's time among them."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    paths = files_of_newest(spark, path, zones, n)
    return scan_parquet(spark, path if paths is None else paths, schema)
