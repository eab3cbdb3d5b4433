"""Where a stream over a file topic begins.

"Latest" means: what the topic holds when the stream is first started does not count.
That moment is kept as a manifest beside the checkpoint: the newest modification time in
the topic, by the store's clock, and the files that carry exactly that time.  It is
written once, so a restart goes on from the first start and loses nothing that came in
between.  Spark applies the condition to the file listing, so old files are not opened.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from skyrisk.sinks.claims import create_once, hadoop_path
from skyrisk.sources.files import list_files

MANIFEST_SCHEMA = "newest_us long, files array<string>"


@dataclass(frozen=True)
class Start:
    newest_us: int | None      # None: everything counts
    files: tuple[str, ...]

    def condition(self, file: str = "_metadata.file_path", time: str = "_metadata.file_modification_time") -> Column | None:
        """Files that count, by their path and time; a file that a running job commits later
        counts by the time it was written."""
        if self.newest_us is None:
            return None
        at = F.timestamp_micros(F.lit(self.newest_us))
        return (F.col(time) > at) | ((F.col(time) == at) & ~F.col(file).isin(list(self.files)))


def _listed(spark: SparkSession, path: str) -> Start:
    files = list_files(spark, path)
    newest = files.agg(F.unix_micros(F.max("time")).alias("us")).first()["us"]
    if newest is None:
        return Start(None, ())
    same = files.where(F.col("time") == F.timestamp_micros(F.lit(newest))).select("file").collect()  # files of one instant
    return Start(newest, tuple(sorted(r["file"] for r in same)))


def read_start(spark: SparkSession, manifest: str) -> Start | None:
    """The start kept under ``manifest``, or None."""
    fs, p = hadoop_path(spark, f"{manifest.rstrip('/')}/start.json")
    if not fs.exists(p):
        return None
    row = spark.read.schema(MANIFEST_SCHEMA).json(p.toString()).first()
    return Start(row["newest_us"], tuple(row["files"] or ()))


def start_of(spark: SparkSession, path: str, manifest: str, checkpoints: tuple[str, ...] = ()) -> Start:
    """The kept start, made now if there is none.  A checkpoint that has batches already
    (of a version that kept no start) began at the first file."""
    found = read_start(spark, manifest)
    if found is not None:
        return found
    fs, folder = hadoop_path(spark, path)
    fs.mkdirs(folder)
    began = any(o[0].exists(o[1]) for o in (hadoop_path(spark, f"{c.rstrip('/')}/offsets/0") for c in checkpoints))
    new = Start(None, ()) if began else _listed(spark, path)
    create_once(spark, f"{manifest.rstrip('/')}/start.json", json.dumps({"newest_us": new.newest_us, "files": list(new.files)}) + "\n")
    return read_start(spark, manifest)  # another query of the job may have been first
