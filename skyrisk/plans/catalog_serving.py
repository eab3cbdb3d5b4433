"""Catalogue entries: serving queries, file sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyrisk.operators import ml, serving as S
from skyrisk.operators.clean import clean_features
from skyrisk.plans.catalog import (WINDOW_ROUND, aggregates, labelled, processed, query,
                                   strict)
from skyrisk.plans.present import present
from skyrisk.schemas import (AGGREGATE_SCHEMA, EVENT_COLUMNS, FEATURE_COLUMNS, PREDICTION_VIEW,
                             PROCESSED_SCHEMA)
from skyrisk.session import scratch_path
from skyrisk.sinks import files as sink
from skyrisk.sources import files as src
from skyrisk.sources import fixture as fx
from skyrisk.functions.rules import prediction_text, risk_label

KPI_ROUND = ["avg_temperature", "avg_humidity", "total_precipitation"]
METRIC_NAMES = ["accuracy", "weightedPrecision", "weightedRecall", "f1"]


def predictions(spark, sf_dir):
    """Fixture predictions: ten-column clean rows + a temperature guess."""
    p = fx.fixture_predictions(strict(spark, sf_dir))
    return p.withColumn("risk_prediction", prediction_text("prediction"))


def kpi(spark, sf_dir):
    return S.kpi_summary(processed(spark, sf_dir))


def eval_table(spark, sf_dir):
    p = predictions(spark, sf_dir).withColumn("risk_label", risk_label())
    return ml.evaluate(p)


# ---------------------------------------------------------------- C2-C9
@query("kpi_summary")
def q_kpi(spark, sf_dir):
    """KPI row over the processed table."""
    return present(kpi(spark, sf_dir), KPI_ROUND)


@query("risk_distribution")
def q_risk_distribution(spark, sf_dir):
    """Rows per risk level."""
    return S.class_distribution(labelled(spark, sf_dir), "risk_level")


@query("risk_distribution_processed")
def q_risk_distribution_processed(spark, sf_dir):
    """C3, notebook form: rule labels over all processed rows (no
    feature null rule before labelling)."""
    from skyrisk.functions.rules import risk_level
    p = processed(spark, sf_dir).withColumn("risk_label", risk_label()) \
        .withColumn("risk_level", risk_level())
    return S.class_distribution(p, "risk_level")


@query("training_gates")
def q_training_gates(spark, sf_dir):
    """C4+C5+G5: counts and gate status in one pass."""
    return S.training_gates(processed(spark, sf_dir), FEATURE_COLUMNS)


@query("split_by_key")
def q_split_by_key(spark, sf_dir):
    """Key-based 80/20 split of the training rows."""
    return S.split_by_key(clean_features(processed(spark, sf_dir))).select("event_id", "split")


def keyless(spark, sf_dir):
    """Processed events of a topic of values only: the landing gives them their keys."""
    return S.with_key(processed(spark, sf_dir).withColumn("event_id", F.lit(None).cast("long")))


@query("split_sparse_keys")
def q_split_sparse_keys(spark, sf_dir):
    """G2 on ids that are multiples of 65,536: their low bits are all the same."""
    rows = clean_features(processed(spark, sf_dir)).withColumn("event_id", F.col("event_id") * 65536)
    return S.split_by_key(rows).select("event_id", "split")


@query("split_keyless")
def q_split_keyless(spark, sf_dir):
    """G2 on records without a key: the split follows the event itself."""
    return present(S.split_by_key(clean_features(keyless(spark, sf_dir)))
                   .select(*EVENT_COLUMNS, "split"))


@query("training_gates_keyless")
def q_training_gates_keyless(spark, sf_dir):
    """C5+G5 on records without a key."""
    return S.training_gates(keyless(spark, sf_dir), FEATURE_COLUMNS)


@query("prediction_text")
def q_prediction_text(spark, sf_dir):
    """Prediction number -> class text."""
    return predictions(spark, sf_dir).select("event_id", "prediction", "risk_prediction")


@query("prediction_distribution")
def q_prediction_distribution(spark, sf_dir):
    """Fixed class list, zero-filled."""
    return S.prediction_distribution(predictions(spark, sf_dir))


@query("confusion_matrix")
def q_confusion(spark, sf_dir):
    """(label, prediction) counts."""
    p = predictions(spark, sf_dir).withColumn("risk_label", risk_label())
    return ml.confusion(p)


@query("eval_metrics")
def q_eval_metrics(spark, sf_dir):
    """Accuracy, weighted precision / recall, f1 from the confusion table."""
    return present(eval_table(spark, sf_dir), METRIC_NAMES)


@query("summary_stats")
def q_summary_stats(spark, sf_dir):
    """Per-column statistics over the newest 1,000 windows."""
    return present(S.summary_stats(aggregates(spark, sf_dir)), S.SUMMARY_STATS)


@query("alert_flag")
def q_alert_flag(spark, sf_dir):
    """Critical data or prediction among the newest 50."""
    return S.alert_flag(processed(spark, sf_dir), predictions(spark, sf_dir))


# ---------------------------------------------------------------- D1-D5, B18
@query("latest_windows")
def q_latest_windows(spark, sf_dir):
    """Newest 10 windows."""
    return present(S.newest(aggregates(spark, sf_dir), 10, "window_start", ["city"]), WINDOW_ROUND)


@query("all_windows")
def q_all_windows(spark, sf_dir):
    """The newest 1,000 windows (the serving pool)."""
    return present(S.newest(aggregates(spark, sf_dir), 1000, "window_start", ["city"]),
                   WINDOW_ROUND)


@query("timeseries_tail")
def q_timeseries_tail(spark, sf_dir):
    """Newest 500 processed events, ascending (chart input)."""
    df = processed(spark, sf_dir).select("event_id", "timestamp", "temperature", "humidity",
                                         "precipitation", "wind_speed")
    return present(S.tail_ascending(df, 500, "timestamp", ["event_id"]))


@query("window_tail")
def q_window_tail(spark, sf_dir):
    """Newest 500 windows, ascending."""
    df = aggregates(spark, sf_dir).select("city", "window_start", "avg_temperature",
                                          "total_precipitation", "max_wind_speed")
    return present(S.tail_ascending(df, 500, "window_start", ["city"]),
                   ["avg_temperature", "total_precipitation"])


def _dated_folder(spark, df, time_col, date_col, name):
    path = scratch_path(spark, name)
    # few files a day, and a large day over several tasks
    df.withColumn(date_col, F.to_date(time_col)).hint("rebalance", date_col) \
        .write.partitionBy(date_col).parquet(path)
    return path


@query("latest_windows_dated")
def q_latest_windows_dated(spark, sf_dir):
    """D1 over a date-partitioned folder: only the newest days are read."""
    path = _dated_folder(spark, aggregates(spark, sf_dir), "window_start", "window_date", "agg-dated")
    return present(src.newest_dated(spark, path, AGGREGATE_SCHEMA, "window_date", 10,
                                    "window_start", ["city"]), WINDOW_ROUND)


@query("timeseries_tail_dated")
def q_timeseries_tail_dated(spark, sf_dir):
    """D2 over a date-partitioned folder: only the newest days are read."""
    path = _dated_folder(spark, processed(spark, sf_dir), "timestamp", "event_date", "events-dated")
    rows = src.newest_dated(spark, path, PROCESSED_SCHEMA, "event_date", 500, "timestamp", ["event_id"])
    return present(rows.select("event_id", "timestamp", "temperature", "humidity", "precipitation",
                               "wind_speed").orderBy("timestamp", "event_id"))


@query("latest_predictions")
def q_latest_predictions(spark, sf_dir):
    """D3+B19: newest 20 predictions, the wanted columns that exist."""
    p = predictions(spark, sf_dir).where(F.col("timestamp").isNotNull())
    top = S.newest(p, 20, "timestamp", ["event_id"])
    return present(S.present_columns(top, ["event_id"] + PREDICTION_VIEW))


@query("latest_row")
def q_latest_row(spark, sf_dir):
    """The single newest aggregate row."""
    return present(S.newest(aggregates(spark, sf_dir), 1, "window_start", ["city"]), WINDOW_ROUND)


@query("latest_per_city")
def q_latest_per_city(spark, sf_dir):
    """Newest aggregate row per city (max_by, map-side reduced)."""
    return present(S.latest_per_key(aggregates(spark, sf_dir), "city", "window_start"),
                   WINDOW_ROUND)


@query("bi_rows")
def q_bi_rows(spark, sf_dir):
    """BI row format (push time left out of the checked output)."""
    agg = present(aggregates(spark, sf_dir), WINDOW_ROUND)
    return S.bi_rows(agg, with_push_time=False)


@query("dataset_status")
def q_dataset_status(spark, sf_dir):
    """C14: row count and has-data flag per table."""
    tables = {"processed": processed(spark, sf_dir), "aggregates": aggregates(spark, sf_dir),
              "predictions": predictions(spark, sf_dir),
              "metrics": S.to_metric_rows(eval_table(spark, sf_dir))}
    return S.dataset_status(tables, spark)


# ---------------------------------------------------------------- A3-A5, E1, K7-K9
@query("scan_processed")
def q_scan_processed(spark, sf_dir):
    """A3: processed table written as Parquet, scanned with its schema."""
    path = sink.write_parquet(processed(spark, sf_dir), scratch_path(spark, "processed"))
    return present(src.scan_parquet(spark, path, PROCESSED_SCHEMA))


@query("scan_metrics_csv")
def q_scan_metrics_csv(spark, sf_dir):
    """A5: KPI row in long form through a metric CSV."""
    path = sink.write_metrics_csv(S.to_metric_rows(present(kpi(spark, sf_dir), KPI_ROUND)),
                                  scratch_path(spark, "kpi-csv"))
    return src.scan_metrics_csv(spark, path)


@query("sink_metrics_csv")
def q_sink_metrics_csv(spark, sf_dir):
    """K7: evaluation metrics written as metric CSV and read back."""
    rows = S.to_metric_rows(present(eval_table(spark, sf_dir), METRIC_NAMES))
    path = sink.write_metrics_csv(rows, scratch_path(spark, "metrics-csv"))
    return src.scan_metrics_csv(spark, path)


@query("export_csv")
def q_export_csv(spark, sf_dir):
    """K8: all windows exported as CSV, read back."""
    rows = present(aggregates(spark, sf_dir), WINDOW_ROUND)
    path = sink.export_csv(rows, scratch_path(spark, "export-csv"))
    schema = T.StructType([T.StructField(f.name, T.TimestampNTZType(), True)
                           if f.name.startswith("window_") else f
                           for f in AGGREGATE_SCHEMA.fields])
    return (spark.read.schema(schema).option("header", True)
            .option("timestampNTZFormat", sink.CSV_TIME_FORMAT).csv(path))


@query("export_json")
def q_export_json(spark, sf_dir):
    """K9: newest 10 windows as JSON with times as strings, read back."""
    top = present(S.newest(aggregates(spark, sf_dir), 10, "window_start", ["city"]),
                  WINDOW_ROUND)
    path = sink.export_json(top, scratch_path(spark, "export-json"))
    schema = T.StructType([T.StructField(f.name, T.StringType(), True)
                           if f.name.startswith("window_") else f
                           for f in AGGREGATE_SCHEMA.fields])
    return spark.read.schema(schema).json(path)


def files_per_part(spark) -> int:
    return max(2, spark.sparkContext.defaultParallelism)


def _write_parts(spark, sf_dir, name):
    """Aggregates written by three successive jobs into one folder, each job
    writing as many files as the session has cores (round-robin, so none is
    empty): the newest two thirds of the files are exactly the last two parts."""
    landed = scratch_path(spark, f"{name}-all")
    present(aggregates(spark, sf_dir), WINDOW_ROUND).write.parquet(landed)
    agg = spark.read.parquet(landed)
    path = scratch_path(spark, name)
    digit = F.substring("city", -1, 1).cast("int")
    for lo, hi in [(0, 3), (4, 6), (7, 9)]:
        agg.where(digit.between(lo, hi)).repartition(files_per_part(spark)) \
            .write.mode("append").parquet(path)
    return path


@query("union_parts")
def q_union_parts(spark, sf_dir):
    """One scan over part files written by three jobs, plus a corrupt
    file that the scan skips."""
    path = _write_parts(spark, sf_dir, "parts")
    spark.range(1).select(F.lit("not parquet").alias("value")).write.mode("append").text(path)
    schema = T.StructType([T.StructField(f.name, T.TimestampNTZType(), True)
                           if f.name.startswith("window_") else f
                           for f in AGGREGATE_SCHEMA.fields])
    return src.scan_parquet(spark, path, schema, skip_corrupt=True)


@query("union_parts_skipped")
def q_union_parts_skipped(spark, sf_dir):
    """What the scan over three jobs' part files read, and the files it left out: one
    of text, one without rows."""
    path = _write_parts(spark, sf_dir, "parts-skipped")
    cities = aggregates(spark, sf_dir).select("city").distinct().coalesce(1)
    cities.write.mode("append").text(path)
    spark.read.parquet(path + "/*.parquet").where("false").coalesce(1).write.mode("append").parquet(path)
    df = src.scan_parquet(spark, path, AGGREGATE_SCHEMA, skip_corrupt=True)
    left = src.skipped_files(spark, path, df).groupBy("status").agg(F.count(F.lit(1)).alias("files")) \
        .select("status", "files", F.lit(0).cast("long").alias("rows"))
    return left.unionByName(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("read").alias("status"), F.lit(None).cast("long").alias("files"), "rows"))


@query("dataset_status_landed")
def q_dataset_status_landed(spark, sf_dir):
    """C14 over landed folders: counts from the files' footers; one folder is missing."""
    folders = {n: scratch_path(spark, "status-" + n) for n in ("processed", "aggregates", "predictions", "nothing")}
    processed(spark, sf_dir).write.parquet(folders["processed"])
    aggregates(spark, sf_dir).write.parquet(folders["aggregates"])
    predictions(spark, sf_dir).write.parquet(folders["predictions"])
    return S.landed_status(spark, folders)


@query("scan_recent_files")
def q_scan_recent_files(spark, sf_dir):
    """A4: rows of the newest files of a folder (the last two of three
    writes: cities 4-9)."""
    path = _write_parts(spark, sf_dir, "recent")
    schema = T.StructType([T.StructField(f.name, T.TimestampNTZType(), True)
                           if f.name.startswith("window_") else f
                           for f in AGGREGATE_SCHEMA.fields])
    return src.scan_recent_files(spark, path, 2 * files_per_part(spark), schema)
