"""K6: events to a topic as JSON values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.sources.topic import Topic


def to_records(df: DataFrame, key_col: str | None = None,
               value_cols: list[str] | None = None) -> DataFrame:
    """Rows -> ``(key, value)`` with value = ``to_json`` of the row (null
    fields left out, as a JSON producer does)."""
    cols = value_cols or [c for c in df.columns if c != key_col]
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return df.select(key.alias("key"), F.to_json(F.struct(*cols)).alias("value"))


def write_topic(records: DataFrame, topic: Topic, compression: str = "gzip",
                acks: str = "1", partitions: int | None = None) -> None:
    """Append records to the topic.  Kafka producer settings (compression,
    acks) are passed through as ``kafka.*`` options; Kafka partitions by key
    itself.  For the file form, ``partitions`` spreads records over that
    many files by key hash (same key -> same file, as a Kafka partitioner
    keeps per-key order)."""
    if topic.fmt == "kafka":
        (records.write.format("kafka").options(**topic.kafka_options())
         .option("kafka.compression.type", compression).option("kafka.acks", acks)
         .option("topic", topic.name).save())
        return
    out = records.select("key", "value")
    if partitions:
        out = out.repartition(partitions, "key")
    out.write.mode("append").json(topic.path)
