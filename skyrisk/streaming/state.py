"""windows that a stopped stream still holds open.

Append mode emits a window once the watermark has passed its end; until then its
partial statistics live in the query's state.  Spark's state data source reads that
state from the checkpoint as a table, one row per open window and city.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk.operators.windows import WINDOW_STATE
from skyrisk.schemas import AGGREGATE_COLUMNS, AGGREGATE_SCHEMA
from skyrisk.sinks.claims import hadoop_path


def open_windows(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The statistics so far of every window that the window query of ``checkpoint`` has
    not emitted, as of its last committed batch (or ``batch``); none before its first."""
    if not _committed(spark, checkpoint):
        return spark.createDataFrame([], AGGREGATE_SCHEMA)
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    rows = reader.load(checkpoint)
    fields = [(f"{name}_{part}", kind) for name, parts in WINDOW_STATE for part, kind in parts]
    value = F.col("value").cast("struct<" + ",".join(f"{n}:{k}" for n, k in fields) + ">")  # by position: the names repeat

    def stat(name, parts):
        v = [F.col(f"v.{name}_{p}") for p, _ in parts]
        return (F.try_divide(*v) if len(v) == 2 else v[0]).alias(name)  # no value yet: null
    named = rows.select(F.col("key.city").alias("city"), F.col("key.window.start").alias("window_start"),
                        F.col("key.window.end").alias("window_end"), value.alias("v"))
    return named.select("city", "window_start", "window_end", *[stat(n, p) for n, p in WINDOW_STATE]) \
        .select("city", "window_start", "window_end", *AGGREGATE_COLUMNS[3:])


def _committed(spark: SparkSession, checkpoint: str) -> bool:
    fs, p = hadoop_path(spark, f"{checkpoint.rstrip('/')}/commits")
    return fs.exists(p) and any(s.getPath().getName().isdigit() for s in fs.listStatus(p))
