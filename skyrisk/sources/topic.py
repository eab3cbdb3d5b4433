"""Event topics: Kafka, or a folder of JSON-line files with the same
``(key, value)`` record shape.

Both forms give a frame of string ``key`` / ``value``, so parsing and every
later step are the same.  The Kafka form needs the ``spark-sql-kafka``
package on the classpath; the file form needs nothing and is what the tests
use.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk.schemas import TOPIC_SCHEMA

DEFAULT_TOPIC = "weather_stream"   # fixed value: topic name


@dataclass(frozen=True)
class Topic:
    name: str = DEFAULT_TOPIC
    fmt: str = "files"                 # "files" | "kafka"
    path: str | None = None            # folder of the file topic
    bootstrap: str | None = None       # kafka.bootstrap.servers
    options: dict = field(default_factory=dict)

    def kafka_options(self) -> dict:
        opts = {"kafka.bootstrap.servers": self.bootstrap or "localhost:9092"}
        opts.update(self.options)
        return opts


def _as_strings(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"))


def read_topic_stream(spark: SparkSession, topic: Topic, starting_offsets: str = "latest",
                      max_per_trigger: int | None = None,
                      min_partitions: int | None = None, start: str | None = None,
                      checkpoints: tuple[str, ...] = (), lineage: bool = False) -> DataFrame:
    """A1: the topic as an unbounded frame of string key/value.

    ``starting_offsets``: "earliest" or "latest" (what is there at the first start does
    not count; later restarts go on).  Kafka keeps the start in the checkpoint; a file
    topic needs ``start``, a folder beside the checkpoint (``sources.start``), and may be
    told the ``checkpoints`` that already began without one.  ``lineage`` (file topics)
    adds ``source_file``, the file a record came from.

    ``max_per_trigger`` bounds a micro-batch (offsets for Kafka, files for
    the file form), which keeps batch size and state growth predictable.
    ``min_partitions`` (Kafka) splits large topic partitions into more
    Spark tasks, so parsing is not capped at the topic's partition count.
    """
    if topic.fmt == "kafka":
        r = (spark.readStream.format("kafka").options(**topic.kafka_options())
             .option("subscribe", topic.name).option("startingOffsets", starting_offsets))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        if min_partitions:
            r = r.option("minPartitions", min_partitions)
        return _as_strings(r.load())
    if starting_offsets not in ("earliest", "latest"):
        raise ValueError(f"a file topic starts at earliest or latest, not {starting_offsets}")
    since = None
    if starting_offsets == "latest":
        if start is None:
            raise ValueError("a file topic read from latest needs a folder for its start")
        from skyrisk.sources.start import start_of
        since = start_of(spark, topic.path, start, checkpoints).condition()
    r = spark.readStream.schema(TOPIC_SCHEMA)
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    rows = r.json(topic.path)
    if since is not None:
        rows = rows.where(since)
    return rows.select("key", "value", *([F.col("_metadata.file_path").alias("source_file")] if lineage else []))


def read_topic_batch(spark: SparkSession, topic: Topic) -> DataFrame:
    """The topic's current content as a bounded frame (replays, backfills)."""
    if topic.fmt == "kafka":
        r = (spark.read.format("kafka").options(**topic.kafka_options())
             .option("subscribe", topic.name).option("startingOffsets", "earliest"))
        return _as_strings(r.load())
    return spark.read.schema(TOPIC_SCHEMA).json(topic.path)
