"""File-based sources: Parquet tables, metric CSVs, hourly documents, run
metrics JSON and the newest-files scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from skyrisk.schemas import (AGGREGATE_SCHEMA, HOURLY_DOC_SCHEMA, METRIC_SCHEMA,
                             PROCESSED_SCHEMA)


def _missing(exc: Exception) -> bool:
    text = str(exc)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text or \
        "UNABLE_TO_INFER_SCHEMA" in text


def scan_parquet(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
                 skip_corrupt: bool = False) -> DataFrame:
    """Parquet folder(s) with a declared schema; a missing folder is
    "no data" (an empty frame of that schema), not an error.

    Several paths are read as one scan (one file listing, one set of tasks)
    rather than a union of scans; ``skip_corrupt`` skips unreadable files.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if skip_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true")
    paths = [path] if isinstance(path, str) else list(path)
    try:
        df = reader.parquet(*paths)
        if schema is None:
            df.schema  # noqa: B018 - force resolution
        return df
    except Exception as exc:  # noqa: BLE001
        if schema is not None and _missing(exc):
            return spark.createDataFrame([], schema)
        raise


def _dated(spark: SparkSession, path: str, schema: StructType, date_col: str,
           since: str | None) -> DataFrame:
    full = StructType(schema.fields + [T.StructField(date_col, T.DateType(), True)])
    df = scan_parquet(spark, path, full)
    if since is not None:
        df = df.where(F.col(date_col) >= F.lit(since).cast("date"))   # partition filter
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def any_file(spark: SparkSession, path: str) -> bool:
    """Whether a folder's listing has a Parquet file (a stream's output: a committed one)."""
    return not list_files(spark, path, recursive=True).where("path like '%.parquet'").isEmpty()


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder (none if it is missing)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) \
        if fs.exists(p) else []


def is_dated(spark: SparkSession, path: str, date_col: str) -> bool:
    """Whether a folder is partitioned by ``date_col``."""
    return any(d.startswith(f"{date_col}=") for d in child_folders(spark, path))


def newest_days(spark: SparkSession, path: str, schema: StructType, date_col: str, n: int) -> DataFrame:
    """Rows of the newest days of a date-partitioned folder, as few days as hold ``n`` rows:
    from the newest day back, twice as many days each time.

    A row's time lies on its partition's day.  Rows without a time (the
    default partition) are only among them when all days together hold fewer."""
    days = [d.split("=", 1)[1] for d in child_folders(spark, path) if d.startswith(f"{date_col}=")]
    dated = sorted((d for d in days if not d.startswith("__")), reverse=True)
    rows, back = _dated(spark, path, schema, date_col, None), 1
    while back < len(dated):
        part = rows.where(F.col(date_col) >= F.lit(dated[back - 1]).cast("date"))
        if part.count() >= n:
            rows = part
            break
        back *= 2
    return rows.drop(date_col)


def newest_dated(spark: SparkSession, path: str, schema: StructType, date_col: str, n: int,
                 time_col: str, tie_cols: list[str]) -> DataFrame:
    """The newest ``n`` rows of a date-partitioned folder, reading only as many
    days as hold them; rows without a time count as oldest."""
    return newest_days(spark, path, schema, date_col, n) \
        .orderBy(F.col(time_col).desc(), *[F.col(c).desc() for c in tie_cols]).limit(n)


def read_processed(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Processed events of a date-partitioned folder, optionally from a day
    on (only those partitions are listed and read)."""
    return _dated(spark, path, PROCESSED_SCHEMA, "event_date", since)


def read_aggregates(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Window aggregates of a date-partitioned folder, optionally from a day on."""
    return _dated(spark, path, AGGREGATE_SCHEMA, "window_date", since)


def list_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(file, path, time) of a folder's files, none of them opened: ``file`` as the scan's own
    ``_metadata.file_path`` names it, ``path`` as readers take it.  For a stream's output
    these are the files of committed batches."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return listing.select(F.col("_metadata.file_path").alias("file"), "path", F.col("_metadata.file_modification_time").alias("time"))


def scan_recent_files(spark: SparkSession, path: str, k: int,
                      schema: StructType | None = None,
                      glob: str = "*.parquet") -> DataFrame:
    """A4: rows of the newest ``k`` files of a folder (modification time,
    then path).

    The folder is listed with the ``binaryFile`` source (its ``content``
    column pruned, so no file is opened): one row per file, ranked by
    TakeOrderedAndProject.  For a stream's sink that listing is the sink's commit
    log, so files of batches that were not committed do not count.  Only the k chosen paths (bounded by k) reach
    the driver, and only those files are scanned - O(files) listing work
    instead of reading every row's metadata.
    """
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", "true").load(path)
               .select("path", "modificationTime"))
    chosen = [r.path for r in listing.orderBy(F.col("modificationTime").desc(),
                                              F.col("path").desc()).limit(k).collect()]
    if not chosen:
        if schema is None:
            raise FileNotFoundError(f"no files under {path}")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*chosen)


def scan_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """A5: two-column ``metric,value`` CSV with header; missing -> empty."""
    try:
        return spark.read.schema(METRIC_SCHEMA).option("header", True).csv(path)
    except Exception as exc:  # noqa: BLE001
        if _missing(exc):
            return spark.createDataFrame([], METRIC_SCHEMA)
        raise


def scan_hourly_documents(spark: SparkSession, path: str,
                          schema: StructType = HOURLY_DOC_SCHEMA,
                          multiline: bool | None = None) -> DataFrame:
    """Stored source documents (struct of parallel arrays).

    A folder holds either one JSON object per line or pretty-printed files of
    one document (or array of documents) each; ``multiline`` says which, and
    by default the first line that is not blank tells: in the first form
    it is a whole object.  A document without ``doc_id`` gets its file's path and a hash
    of its content, so several in one file have an order of their own.
    """
    if multiline is None:
        line = spark.read.text(path).where(F.trim("value") != "").limit(1) \
            .select(F.json_object_keys("value").isNull().alias("cut")).first()
        multiline = line is not None and line["cut"]
    docs = spark.read.schema(schema).option("multiLine", multiline).json(path)
    content = F.hex(F.xxhash64(F.to_json(F.struct(*[c for c in docs.columns if c != "doc_id"]))))
    return docs.withColumn("doc_id", F.coalesce("doc_id", F.concat_ws("#", F.input_file_name(), content)))


def scan_json(spark: SparkSession, path: str, schema: StructType,
              multiline: bool = False) -> DataFrame:
    """Run-metric records (jobs, stages, executors) as JSON."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def scan_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Spark event logs as ``(log, Event, line)`` rows.

    ``log`` names one application's log: its rolled ``eventlog_v2_*`` folder, or
    its file.  Plain files and those that Spark's codecs know, ``.zstd`` (Spark's own
    name for them) and ``.zst`` included, are read as text, unpacked as a stream by
    the tasks.  On the driver: the paths, one per file of a log.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    paths = [r["path"] for r in files.select("path").collect()]
    if paths:
        lines = spark.read.text(paths).select(F.input_file_name().alias("file"), "value")
    else:
        lines = spark.createDataFrame([], "file string, value string")
    log = F.coalesce(F.regexp_extract("file", "^(.*/eventlog_v2_[^/]+)/[^/]*$", 1), F.lit(""))
    return lines.select(F.when(log != "", log).otherwise(F.col("file")).alias("log"),
                        F.get_json_object("value", "$.Event").alias("Event"),
                        F.col("value").alias("line"))


def unread_files(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """(file, path) under ``path`` that gave ``df`` (a scan of it) no row: the corrupt ones
    that ``skip_corrupt`` left out, and empty ones."""
    used = df.select(F.col("_metadata.file_path").alias("file")).distinct()
    return list_files(spark, path, recursive=True).select("file", "path").join(used, "file", "left_anti")


def skipped_files(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """(path, status, reason) of each file under ``path`` that the scan ``df`` got no row
    from: ``empty`` where a readable footer counts no rows, else ``corrupt``.

    Tasks read the footers of those files only, by range, side by side.  Files of no bytes
    are no files to Spark's scans and are not listed."""
    def footers(batches):
        from urllib.parse import quote

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        for b in batches:
            status, reason = [], []
            for p in b.column("path").to_pylist():
                try:
                    local = p.startswith("file:") or "://" not in p
                    store, name = (fs.LocalFileSystem(), "/" + p.removeprefix("file:").lstrip("/")) if local else \
                        fs.FileSystem.from_uri(quote(p, safe="/:=@+,;&$!*'()~"))
                    with store.open_input_file(name) as f:
                        n = pq.ParquetFile(f).metadata.num_rows
                    status.append("corrupt" if n else "empty")
                    reason.append(f"{n} rows by its footer" if n else None)
                except (OSError, pa.ArrowException) as e:
                    status.append("corrupt")
                    reason.append(str(e)[:200])
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(status, pa.string()), pa.array(reason, pa.string())],
                                             names=["path", "status", "reason"])
    return unread_files(spark, path, df).select("path").mapInArrow(footers, "path string, status string, reason string")
