"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``out=source`` columns of ``df``, found by their exact names.

    Other columns are dropped, also those whose names differ only in case or
    stand twice (the first one counts).
    """
    names = df.columns
    flat = df.toDF(*[f"_{i}" for i in range(len(names))])
    return flat.select([flat[f"_{names.index(src)}"].alias(out) for out, src in columns.items()])


def whole_rows(df: DataFrame, run) -> DataFrame:
    """``run`` over record batches of all columns, which come out under the same names;
    inside they are known by position, as names may clash."""
    names = df.columns
    flat = df.toDF(*[f"_{i}" for i in range(len(names))])
    return flat.mapInArrow(run, flat.schema).toDF(*names)


def keyed_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` long (null stays null) and ``text`` (null: empty) of any table."""
    d = pick(df, doc_id=key, text=text)
    return d.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fold(key: Column | str) -> Column:
    """crc32 of the key as text, modulo 5; rows of fold 0 are held out."""
    return F.crc32(F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"),
                              F.lit("")).cast("binary")) % 5


def thin(df: DataFrame, key: str, limit: int) -> DataFrame:
    """Rows whose key hash is small enough that about ``limit`` of them are left, and a
    tenth more; so the sort that takes exactly ``limit`` sees few rows at any size."""
    n = df.count()
    if n <= limit:
        return df
    return df.where(key_hash(key) < int(1.1 * limit / n * (1 << 32)))


def key_hash(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << 32))


def training_labels(labels: DataFrame, label: str, limit: int | None = None) -> DataFrame:
    """The labelled (doc_id, label) rows outside the held-out fold, all of them or at most ``limit``.

    The rows with the smallest id hashes are taken, so the choice does not
    depend on the partitioning.  A document labelled twice counts once, with
    its larger label; rows without id or label do not count.
    """
    lab = pick(labels, doc_id="doc_id", label=label).where("doc_id is not null and label is not null")
    lab = lab.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")).where(fold("doc_id") != 0)
    if limit is None:
        return lab.groupBy("doc_id").agg(F.max("label").alias("label"))
    lab = thin(lab, "doc_id", limit).groupBy("doc_id").agg(F.max("label").alias("label"))
    return lab.orderBy(key_hash("doc_id"), "doc_id").limit(limit)


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(doc_id, text, label) of the labelled training rows; the label side is
    bounded by ``limit`` rows of 12 bytes, so it may be broadcast."""
    return keyed_text(docs).join(F.broadcast(training_labels(labels, label, limit)), "doc_id")


def slices(batches: Iterable[pa.RecordBatch], column: str = "text",
           size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts record batches into runs of rows with about ``size`` bytes of text."""
    for b in batches:
        n = np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0), dtype=np.int64)
        at, ends = 0, np.cumsum(n)
        while at < b.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield b.slice(at, to - at)
            pa.default_memory_pool().release_unused()  # else each worker keeps its largest slice's buffers
            at = to


def spread(flat: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenation of ``flat[first[i]:first[i] + count[i]]``."""
    total = int(count.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(count)
    at = np.repeat(first - (ends - count), count)
    at += np.arange(total, dtype=at.dtype)
    return flat[at]


def starts(count: np.ndarray) -> np.ndarray:
    """[0, c0, c0+c1, ...]: offsets of runs with these lengths."""
    out = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count, out=out[1:])
    return out
