"""Window aggregates to a JDBC table.

Spark has no streaming JDBC sink ("Data source jdbc does not support
streamed writing"), so each micro-batch is written with the batch JDBC
writer inside ``foreachBatch``.  Rows carry the batch id.  A batch first deletes
the rows of its own id, so one that is tried again replaces what its earlier
attempt left, with or without a unique key on (city, window_start).
Untested here against a database: none may be started in this environment.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def jdbc_batch_frame(batch: DataFrame, batch_id: int, num_partitions: int = 8) -> DataFrame:
    """The rows one micro-batch appends: the window rows plus ``batch_id``, in
    ``num_partitions`` tasks (bounds concurrent connections).  A shuffle, not a
    merge of tasks: the stateful stage before it keeps its own parallelism."""
    return batch.withColumn("batch_id", F.lit(batch_id).cast("long")).repartition(num_partitions)


def delete_statement(table: str, batch_id: int) -> str:
    """Removes what an earlier attempt of this batch wrote."""
    if not re.fullmatch(r"[A-Za-z_][\w$]*(\.[A-Za-z_][\w$]*)*", table):
        raise ValueError(f"not a plain table name: {table!r}")
    return f"DELETE FROM {table} WHERE batch_id = {int(batch_id)}"


def run_statement(spark: SparkSession, url: str, statement: str, props: dict) -> None:
    """One statement over a connection of the driver."""
    jvm = spark.sparkContext._jvm
    p = jvm.java.util.Properties()
    for k, v in props.items():
        p.setProperty(k, str(v))
    if "driver" in props:
        jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(props["driver"])
    conn = jvm.java.sql.DriverManager.getConnection(url, p)
    try:
        st = conn.createStatement()
        try:
            st.executeUpdate(statement)
        finally:
            st.close()
    finally:
        conn.close()


def start_jdbc_sink(stats_stream: DataFrame, url: str, table: str, checkpoint: str,
                    properties: dict | None = None, trigger: str | None = "30 seconds",
                    num_partitions: int = 8, execute=run_statement) -> StreamingQuery:
    """The target table must exist, with a ``batch_id`` column."""
    props = dict(properties or {})

    def write(batch: DataFrame, batch_id: int) -> None:
        execute(batch.sparkSession, url, delete_statement(table, batch_id), props)
        (jdbc_batch_frame(batch, batch_id, num_partitions)
         .write.format("jdbc").option("url", url).option("dbtable", table)
         .options(**props).mode("append").save())

    w = stats_stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger in (None, "availableNow"):
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger)
    return w.start()
