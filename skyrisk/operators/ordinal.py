"""Global ordinal (0-based position in key order) without a single-task sort.

``row_number()`` over an unpartitioned window moves every row into one task.
Instead the rows are range-partitioned on key *and* tie columns, sorted inside
their partition, numbered there and written once to the shared folder; the P
partition sizes give the offsets (a table bounded by P, so it is broadcast).
Ranges are cut by sampled quantiles of the whole order, so a key value that a
large share of the rows has (one hour of all cities) spreads over many ranges
as long as the tie columns differ.

The written table fixes which row is where: a lost task recomputes nothing
that could come out otherwise.  The order is ``key ASC NULLS FIRST, *tie``;
(key, tie) must be unique for the ordinal to be deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyrisk.session import scratch_path


def ranged(df: DataFrame, key: str, buckets: int | None = None,
           tie: list[str] | None = None) -> DataFrame:
    """``df`` with ``__part`` and ``__idx``: its range in (key, tie) order and the
    0-based place in it, from a table written to the shared folder."""
    spark = df.sparkSession
    p = max(1, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col(key).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in (tie or [])]]
    path = scratch_path(spark, "ordinal")
    # in each task the row id counts up from the partition number << 33
    (df.repartitionByRange(p, *order).sortWithinPartitions(*order)
     .withColumn("__id", F.monotonically_increasing_id())
     .withColumn("__part", F.shiftright("__id", 33).cast("int"))
     .withColumn("__idx", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
     .drop("__id").write.parquet(path))
    return spark.read.parquet(path)


def with_ordinal(df: DataFrame, key: str, name: str = "ordinal", buckets: int | None = None,
                 tie: list[str] | None = None) -> DataFrame:
    """``df`` with its position in (key, tie) order."""
    rows = ranged(df, key, buckets, tie)
    counts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # offsets over at most P rows: a tiny single-partition window is fine here
    offsets = counts.select(
        "__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__off"))
    return (rows.join(F.broadcast(offsets), "__part")
            .withColumn(name, (F.col("__off") + F.col("__idx")).cast("long"))
            .select(*df.columns, name))
