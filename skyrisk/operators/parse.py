"""Wire records to typed events (works on batch and streaming frames)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyrisk.functions.timeparse import EVENT_TIME_FORMAT, parse_event_time
from skyrisk.schemas import EVENT_SCHEMA


def parse_events(records: DataFrame, schema: StructType = EVENT_SCHEMA,
                 value_col: str = "value", key_col: str | None = "key",
                 key_name: str = "event_id",
                 time_format: str = EVENT_TIME_FORMAT,
                 keep: list[str] | None = None) -> DataFrame:
    """``from_json`` with a fixed schema, fields expanded, time parsed.

    Broken or non-object JSON gives a row of nulls; a wrongly typed field
    gives null for that field only.  If ``key_col`` is given the record key
    is kept as ``key_name`` (a long); ``keep`` names further input columns.
    """
    cols = list(keep or [])
    if key_col:
        cols.append(F.expr(f"try_cast({key_col} AS BIGINT)").alias(key_name))
    # inline(array(struct)) is a generator: Catalyst cannot push the null
    # filters of the clean step below it, so each record is parsed exactly
    # once.  A plain select("data.*") lets the filter be pushed down with
    # from_json substituted into every null check - one parse per checked
    # column (measured: 2x slower on 100k records).
    cols.append(F.inline(F.array(F.from_json(F.col(value_col), schema))))
    parsed = records.select(*cols)
    if "timestamp" in schema.fieldNames():
        parsed = parsed.withColumn("timestamp", parse_event_time("timestamp", time_format))
    return parsed
