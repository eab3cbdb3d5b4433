"""Output conventions of the catalogue's result frames.

* Timestamps leave as ``TIMESTAMP_NTZ``: wire times carry no zone, and a
  zone-less type reads back identically in every client.
* Averages and sums of doubles are rounded to 6 decimals: their last bits
  depend on summation order, which differs between engines and partitionings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

DECIMALS = 6


def ntz(df: DataFrame) -> DataFrame:
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def rounded(df: DataFrame, cols: list[str], decimals: int = DECIMALS) -> DataFrame:
    return df.select(*[F.round(F.col(c), decimals).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def present(df: DataFrame, round_cols: list[str] | None = None) -> DataFrame:
    if round_cols:
        df = rounded(df, round_cols)
    return ntz(df)
