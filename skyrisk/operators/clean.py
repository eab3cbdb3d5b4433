"""Null rules.  The three jobs of the pipeline drop on different column sets
and must be kept apart: the processing stream on the six required columns,
training on the eight features, scoring on all ten."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyrisk.schemas import EVENT_COLUMNS, FEATURE_COLUMNS, REQUIRED_COLUMNS


def _keyed(df: DataFrame, cols: list[str]) -> list[str]:
    return [c for c in ("event_id", *cols, "source_file") if c in cols or c in df.columns]


def drop_incomplete(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows with null (or NaN, for doubles) in any of ``subset``."""
    return df.dropna(how="any", subset=subset)


def clean_required(parsed: DataFrame) -> DataFrame:
    """Processing-stream rule: six required columns, canonical projection."""
    return drop_incomplete(parsed, REQUIRED_COLUMNS).select(*_keyed(parsed, EVENT_COLUMNS))


def clean_strict(parsed: DataFrame) -> DataFrame:
    """Scoring rule: all ten event columns."""
    return drop_incomplete(parsed, EVENT_COLUMNS).select(*_keyed(parsed, EVENT_COLUMNS))


def clean_features(processed: DataFrame) -> DataFrame:
    """Training rule: the eight features (the vector assembler refuses nulls)."""
    return drop_incomplete(processed, FEATURE_COLUMNS)
