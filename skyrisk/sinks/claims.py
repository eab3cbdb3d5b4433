"""Files that are created once, and the ledger of a producer's event counter.

A producer numbers its events without gaps over all its runs.  Every run claims the next
numbers with one small file, ``claims/<k>.json``: it appears whole under its name or not
at all, and only one writer can make it, so two runs at a time get different numbers.  A
run that is started again under its id finds its claim and sends the same numbers; one
that had ended (``done/<k>.json``) sends nothing.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

CLAIM_SCHEMA = "claim long, run string, first long, count long"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of ``path`` on whatever store it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Creates ``path`` with ``text`` unless it exists; whether it did.

    The content is written under a hidden name first.  A hard link (local and mounted
    folders) or a rename that refuses an existing target (HDFS, ABFS, GCS) then gives it
    its name in one step.  S3 has neither; a ledger belongs on one of the former."""
    fs, final = hadoop_path(spark, path)
    if fs.exists(final):
        return False
    fs.mkdirs(final.getParent())
    tmp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(final.getParent(), f"_{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            try:
                os.link(tmp.toUri().getPath(), final.toUri().getPath())
                return True
            except FileExistsError:
                return False
        return bool(fs.rename(tmp, final))
    finally:
        if fs.exists(tmp):
            fs.delete(tmp, False)


@dataclass(frozen=True)
class Claim:
    number: int
    first: int
    count: int
    done: bool


def claim(spark: SparkSession, ledger: str, run: str, count: int) -> Claim:
    """The numbers of ``run``: its own claim if it has one, else the next ``count``."""
    ledger = ledger.rstrip("/")
    while True:
        fs, folder = hadoop_path(spark, f"{ledger}/claims")
        fs.mkdirs(folder)
        claims = spark.read.schema(CLAIM_SCHEMA).json(f"{ledger}/claims")
        own = claims.where(F.col("run") == run).first()
        if own is not None:
            if own["count"] != count:
                raise ValueError(f"run {run} claimed {own['count']} events and now has {count}")
            done = hadoop_path(spark, f"{ledger}/done/{own['claim']:012d}.json")
            return Claim(own["claim"], own["first"], count, bool(done[0].exists(done[1])))
        last = claims.agg(F.max("claim").alias("claim"), F.max_by(F.col("first") + F.col("count"), "claim").alias("next")).first()
        k, first = (last["claim"] + 1, last["next"]) if last["claim"] is not None else (0, 0)
        if create_once(spark, f"{ledger}/claims/{k:012d}.json", json.dumps({"claim": k, "run": run, "first": first, "count": count}) + "\n"):
            return Claim(k, first, count, False)


def finish(spark: SparkSession, ledger: str, c: Claim) -> None:
    """Marks the claim's run as sent."""
    create_once(spark, f"{ledger.rstrip('/')}/done/{c.number:012d}.json", "{}\n")
