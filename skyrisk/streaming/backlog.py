"""what a file topic holds that the processing stream has not landed yet.

Landed events carry the topic file they came from (``start_processing(lineage=True)``).
The topic's listing is anti-joined with those names, and only the files left are read: of
their records those count that the processing stream would land, so a file of bad records
alone is no backlog, though no landed row ever names it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from skyrisk.operators.clean import clean_required
from skyrisk.operators.parse import parse_events
from skyrisk.schemas import PROCESSED_SCHEMA, TOPIC_SCHEMA
from skyrisk.sources.files import list_files, scan_parquet
from skyrisk.sources.start import read_start
from skyrisk.sources.topic import Topic


def landed_events(spark: SparkSession, path: str) -> DataFrame:
    """The landed table with its ``source_file`` (no rows before the first run)."""
    return scan_parquet(spark, path, StructType(PROCESSED_SCHEMA.fields + [StructField("source_file", StringType())]))


def events_behind(spark: SparkSession, topic: Topic, landed: DataFrame, start: str | None = None) -> DataFrame:
    """Events of topic files that ``landed`` names none of; ``start``: the job's start
    folder, whose earlier files do not count.  Rows landed without their file are an error.

    On the driver: the paths of the files behind, which Spark's own scan holds there too."""
    if not landed.where("source_file is null").isEmpty():
        raise ValueError("events were landed without their topic file; run process with --lineage")
    files = list_files(spark, topic.path)
    kept = read_start(spark, start) if start else None
    counts = kept.condition("file", "time") if kept else None
    if counts is not None:
        files = files.where(counts)
    done = landed.where("source_file is not null").select(F.col("source_file").alias("file")).distinct()
    paths = [r["path"] for r in files.join(done, "file", "left_anti").select("path").collect()]
    if not paths:
        records = spark.createDataFrame([], StructType(TOPIC_SCHEMA.fields + [StructField("source_file", StringType())]))
    else:
        records = spark.read.schema(TOPIC_SCHEMA).json(paths).withColumn("source_file", F.col("_metadata.file_path"))
    return clean_required(parse_events(records, keep=["source_file"]))


def backlog(behind: DataFrame) -> DataFrame:
    """One row: files and events behind, and the span of their event times."""
    return behind.agg(F.count_distinct("source_file").alias("files_behind"), F.count(F.lit(1)).alias("events_behind"),
                      F.min("timestamp").alias("oldest"), F.max("timestamp").alias("newest"))
