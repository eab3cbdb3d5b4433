"""The corpus pipeline: quality rules, quality classifier, near-duplicates, secrets, packing.

Each stage reads what the one before kept and, but for the last, returns the
columns of ``documents``.  Labels come from the ``labels`` table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skyrisk.llm import packing, quality_gbt, quality_rules, secrets, simhash
from skyrisk.llm.common import table
from skyrisk.llm.queries import importable
from skyrisk.session import scratch_path


def quality_rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no anomaly."""
    importable(spark)
    return quality_rules.keep_passing(docs, table(spark, sf_dir, "labels"))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as good."""
    importable(spark)
    return quality_gbt.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each SimHash component."""
    importable(spark)
    return simhash.keep_one(docs, shingle=3, bits=3)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced."""
    importable(spark)
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    importable(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rule_stage), ("quality classifier", quality_classifier_stage), ("near duplicates", near_duplicate_stage),
          ("secrets", secret_stage), ("packing", packing_stage)]

ORACLE_SQL = None  # trees, SimHash and token ids are beyond SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
