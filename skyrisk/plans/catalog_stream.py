"""Catalogue entries: topic source / sink and streaming semantics.

Every stream reads a file topic that Spark writes from the ``events``
table into the shared scratch folder, runs with ``availableNow`` into a
Parquet sink, and the entry returns the sink's content.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from skyrisk.operators.clean import clean_required
from skyrisk.operators.parse import parse_events
from skyrisk.operators.windows import window_statistics
from skyrisk.operators.serving import RECENT, alert_flag, newest, present_columns, tail_ascending
from skyrisk.plans.catalog import WINDOW_ROUND, aggregates, processed, query, weather
from skyrisk.plans.catalog_serving import predictions
from skyrisk.plans.present import present
from skyrisk.schemas import AGGREGATE_SCHEMA, EVENT_COLUMNS, PREDICTION_SCHEMA, PREDICTION_VIEW, PROCESSED_SCHEMA
from skyrisk.session import scratch_path
from skyrisk.sinks.topic import to_records, write_topic
from skyrisk.sources import fixture as fx
from skyrisk.sources.topic import Topic, read_topic_batch, read_topic_stream
from skyrisk.sources.zones import scan_newest, start_zones
from skyrisk.streaming import jobs
from skyrisk.streaming.backlog import events_behind, landed_events
from skyrisk.streaming.bi import pushed_rows, start_bi_push
from skyrisk.streaming.merged import merged_sink, read_merged
from skyrisk.streaming.state import open_windows

TIMEOUT_S = 600


def files_per_slice(spark) -> int:
    """Files of one slice, and so files of one micro-batch: as many as the session has cores."""
    return max(2, spark.sparkContext.defaultParallelism)


def _state_parts(spark) -> int:
    """State partitions for the catalogue's small test streams."""
    return spark.sparkContext.defaultParallelism


def slicer(spark, sf_dir, n: int = 3):
    """``f(timestamp column) -> slice 0..n-1``: equal spans of the events'
    time range, by integer arithmetic on epoch microseconds."""
    ev = fx.load_table(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    b = ev.agg(F.min(us).alias("lo"), F.max(us).alias("hi")).first()
    lo, hi = b["lo"], b["hi"]
    cut = [lo + (hi - lo) * k // n for k in range(1, n)]

    def of(ts_col):
        t = F.unix_micros(ts_col.cast("timestamp"))
        sl = F.lit(n - 1)
        for k in reversed(range(n - 1)):
            sl = F.when(t < cut[k], F.lit(k)).otherwise(sl)
        return sl
    return of


def time_slices(spark, sf_dir, n: int = 3):
    """Weather rows with their event-time slice (column ``slice``)."""
    of = slicer(spark, sf_dir, n)
    ev = fx.load_table(spark, sf_dir, "events")
    return fx.weather_events(ev.withColumn("slice", of(F.col("ts"))), keep=["slice"])


def file_topic(spark, sf_dir, name: str) -> Topic:
    """The producer: events keyed by id, hash-partitioned into one topic
    file per core (records are built after the shuffle, in parallel)."""
    topic = Topic(fmt="files", path=scratch_path(spark, name))
    keyed = weather(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism, "event_id")
    write_topic(fx.topic_records(keyed), topic)
    return topic


def write_slice(records, topic: Topic):
    write_topic(records.repartition(files_per_slice(records.sparkSession)), topic)


def sliced_topic(spark, sf_dir, name: str, late_copy: bool = False) -> Topic:
    """Topic files written slice by slice (so file order = time order).
    With ``late_copy`` every later slice also carries a copy of the earliest
    clean record (a late event)."""
    w = time_slices(spark, sf_dir)
    topic = Topic(fmt="files", path=scratch_path(spark, name))
    earliest = None
    if late_copy:
        first = clean_required(parse_events(fx.topic_records(w))).agg(
            F.min_by("event_id", F.struct("timestamp", "event_id")).alias("e")).first()["e"]
        earliest = fx.topic_records(w.where(F.col("event_id") == first))
    for k in range(3):
        recs = fx.topic_records(w.where(F.col("slice") == k))
        if earliest is not None and k > 0:
            recs = recs.unionByName(earliest)
        write_slice(recs, topic)
    return topic


def _read_aggregates(spark, path):
    return present(spark.read.schema(AGGREGATE_SCHEMA).parquet(path), WINDOW_ROUND)


# ---------------------------------------------------------------- A1, K6
@query("src_topic_stream")
def q_src_topic_stream(spark, sf_dir):
    """A1: topic scanned as a stream: per record its key, the number of
    top-level keys of the whole value (null when the value is not a JSON
    object) and its last character."""
    topic = file_topic(spark, sf_dir, "topic-src")
    out = scratch_path(spark, "topic-src-out")
    _land(spark, read_topic_stream(spark, topic, "earliest"), out)
    return spark.read.parquet(out)


def _land(spark, records, out):
    s = records.select(
        F.col("key").cast("long").alias("event_id"),
        F.array_size(F.json_object_keys("value")).alias("n_keys"),
        F.substring("value", -1, 1).alias("last_char"))
    q = jobs.parquet_sink(s, out, out + "-ckpt")
    jobs.await_all(spark, [q], TIMEOUT_S)


@query("src_topic_latest")
def q_src_topic_latest(spark, sf_dir):
    """A1 from "latest": the first third of the topic is there before the stream is
    first started and does not count; the second comes while it is stopped, the third
    after another start, and both do."""
    w = time_slices(spark, sf_dir)
    topic = Topic(fmt="files", path=scratch_path(spark, "topic-latest"))
    out = scratch_path(spark, "topic-latest-out")
    for k in range(3):
        write_slice(fx.topic_records(w.where(F.col("slice") == k)), topic)
        _land(spark, read_topic_stream(spark, topic, "latest", start=out + "-start"), out)
    return spark.read.parquet(out)


@query("sink_topic_json")
def q_sink_topic_json(spark, sf_dir):
    """K6: events written to a topic as JSON, read back and parsed."""
    topic = Topic(fmt="files", path=scratch_path(spark, "topic-sink"))
    write_topic(to_records(weather(spark, sf_dir), "event_id", EVENT_COLUMNS), topic)
    return present(parse_events(read_topic_batch(spark, topic)))


# ---------------------------------------------------------------- K1, K2, K5, F1-F6, F10
@query("stream_clean")
def q_stream_clean(spark, sf_dir):
    """K1: parse + clean as a stream into Parquet (append)."""
    topic = file_topic(spark, sf_dir, "topic-clean")
    out = scratch_path(spark, "processed")
    q = jobs.parquet_sink(jobs.clean_stream(spark, topic, "earliest"), out, out + "-ckpt")
    jobs.await_all(spark, [q], TIMEOUT_S)
    return present(spark.read.schema(PROCESSED_SCHEMA).parquet(out))


@query("stream_window_append")
def q_stream_window_append(spark, sf_dir):
    """K2+F1+F3: watermarked 1-minute windows, appended once closed."""
    topic = file_topic(spark, sf_dir, "topic-win")
    proc, agg = scratch_path(spark, "processed"), scratch_path(spark, "aggregates")
    qs = jobs.start_processing(spark, topic, proc, agg, scratch_path(spark, "ckpt"),
                               starting_offsets="earliest",
                               state_partitions=_state_parts(spark))
    jobs.await_all(spark, qs, TIMEOUT_S)
    return _read_aggregates(spark, agg)


@query("stream_window_complete")
def q_stream_window_complete(spark, sf_dir):
    """K5+F4: complete mode - every window, re-emitted in full."""
    topic = file_topic(spark, sf_dir, "topic-complete")
    stats = window_statistics(jobs.clean_stream(spark, topic, "earliest"))
    out = scratch_path(spark, "complete")
    with jobs.shuffle_partitions_for_start(spark, _state_parts(spark)):
        q = jobs.table_snapshot_sink(stats, out, out + "-ckpt")
    jobs.await_all(spark, [q], TIMEOUT_S)
    return present(jobs.read_snapshot(spark, out, AGGREGATE_SCHEMA), WINDOW_ROUND)


@query("stream_window_update")
def q_stream_window_update(spark, sf_dir):
    """F4/K5 in update mode: three micro-batches, each merging the windows it changed into
    their days; the table then is what complete mode gives."""
    topic = sliced_topic(spark, sf_dir, "topic-update")
    stats = window_statistics(jobs.clean_stream(spark, topic, "earliest", files_per_slice(spark)), watermark=jobs.WATERMARK_DELAY)
    out = scratch_path(spark, "merged")
    with jobs.shuffle_partitions_for_start(spark, _state_parts(spark)):
        q = merged_sink(stats, out, out + "-ckpt")
    jobs.await_all(spark, [q], TIMEOUT_S)
    return present(read_merged(spark, out, AGGREGATE_SCHEMA), WINDOW_ROUND)


@query("stream_open_windows")
def q_stream_open_windows(spark, sf_dir):
    """hourly windows that a stopped stream with a day's lateness has not emitted
    yet, read from its state."""
    topic = file_topic(spark, sf_dir, "topic-open")
    proc, agg, ckpt = (scratch_path(spark, n) for n in ("processed", "aggregates", "ckpt"))
    qs = jobs.start_processing(spark, topic, proc, agg, ckpt, starting_offsets="earliest", width="1 hour", watermark="1 day",
                               state_partitions=_state_parts(spark))
    jobs.await_all(spark, qs, TIMEOUT_S)
    return present(open_windows(spark, f"{ckpt}/aggregates"), WINDOW_ROUND)


@query("stream_fanout")
def q_stream_fanout(spark, sf_dir):
    """two queries over one source, own checkpoints, stopped together."""
    topic = file_topic(spark, sf_dir, "topic-fanout")
    proc, agg = scratch_path(spark, "processed"), scratch_path(spark, "aggregates")
    qs = jobs.start_processing(spark, topic, proc, agg, scratch_path(spark, "ckpt"),
                               starting_offsets="earliest",
                               state_partitions=_state_parts(spark))
    jobs.await_all(spark, qs, TIMEOUT_S)
    p = spark.read.parquet(proc).agg(F.count(F.lit(1)).alias("rows")) \
        .select(F.lit("processed").alias("sink"), "rows")
    a = spark.read.parquet(agg).agg(F.count(F.lit(1)).alias("rows")) \
        .select(F.lit("aggregates").alias("sink"), "rows")
    return p.unionByName(a)


@query("stream_restart")
def q_stream_restart(spark, sf_dir):
    """two availableNow runs on one checkpoint, data added in between;
    each closed window is written exactly once."""
    w = time_slices(spark, sf_dir, 2)
    topic = Topic(fmt="files", path=scratch_path(spark, "topic-restart"))
    proc, agg = scratch_path(spark, "processed"), scratch_path(spark, "aggregates")
    ckpt = scratch_path(spark, "ckpt")
    for k in range(2):
        write_slice(fx.topic_records(w.where(F.col("slice") == k)), topic)
        qs = jobs.start_processing(spark, topic, proc, agg, ckpt, starting_offsets="earliest",
                               state_partitions=_state_parts(spark))
        jobs.await_all(spark, qs, TIMEOUT_S)
    return _read_aggregates(spark, agg)


@query("stream_late_drop")
def q_stream_late_drop(spark, sf_dir):
    """three time-ordered micro-batches; batches 1 and 2 each carry a
    copy of the earliest event.  The copy in batch 1 still counts; the one
    in batch 2 is behind the watermark and dropped."""
    topic = sliced_topic(spark, sf_dir, "topic-late", late_copy=True)
    proc, agg = scratch_path(spark, "processed"), scratch_path(spark, "aggregates")
    qs = jobs.start_processing(spark, topic, proc, agg, scratch_path(spark, "ckpt"),
                               starting_offsets="earliest", max_per_trigger=files_per_slice(spark),
                               state_partitions=_state_parts(spark))
    jobs.await_all(spark, qs, TIMEOUT_S)
    return _read_aggregates(spark, agg)


# ---------------------------------------------------------------- F9, D1, D2
@query("topic_backlog")
def q_topic_backlog(spark, sf_dir):
    """events of the topic, per city, that a stopped stream has not landed: those of
    the last third, and none of a file that holds bad records only."""
    w = time_slices(spark, sf_dir)
    topic = Topic(fmt="files", path=scratch_path(spark, "topic-backlog"))
    proc = scratch_path(spark, "processed")
    for k in range(2):
        write_slice(fx.topic_records(w.where(F.col("slice") == k)), topic)
    bad = w.where(F.col("event_id") % fx.BROKEN_JSON_EVERY == 0)
    write_topic(fx.topic_records(bad).coalesce(1), topic)
    qs = jobs.start_processing(spark, topic, proc, scratch_path(spark, "aggregates"), scratch_path(spark, "ckpt"), starting_offsets="earliest",
                               state_partitions=_state_parts(spark), lineage=True)
    jobs.await_all(spark, qs, TIMEOUT_S)
    write_slice(fx.topic_records(w.where(F.col("slice") == 2)), topic)
    behind = events_behind(spark, topic, landed_events(spark, proc))
    return present(behind.groupBy("city").agg(F.count(F.lit(1)).alias("events_behind"), F.min("timestamp").alias("oldest"),
                                              F.max("timestamp").alias("newest")))


def zoned_table(spark, sf_dir, df, time_col, name):
    """``df`` landed by three jobs in time order, unpartitioned, and the zone map of the
    first two jobs' files."""
    of = slicer(spark, sf_dir)
    path, zones, landed = (scratch_path(spark, name + end) for end in ("", "-zones", "-all"))
    df.withColumn("slice", of(F.col(time_col))).write.parquet(landed)
    tagged = spark.read.parquet(landed)
    for k in range(3):
        tagged.where(F.col("slice") == k).drop("slice").repartition(files_per_slice(spark)).write.mode("append").parquet(path)
        if k < 2:
            jobs.await_all(spark, [start_zones(spark, path, time_col, zones, zones + "-ckpt")], TIMEOUT_S)
    return path, zones


@query("latest_windows_zoned")
def q_latest_windows_zoned(spark, sf_dir):
    """D1 over an unpartitioned folder: the zone map picks the files that can hold the
    newest ten windows; files it does not know yet are read too."""
    path, zones = zoned_table(spark, sf_dir, aggregates(spark, sf_dir), "window_start", "agg-zoned")
    rows = scan_newest(spark, path, zones, AGGREGATE_SCHEMA, 10)
    return present(newest(rows, 10, "window_start", ["city"]), WINDOW_ROUND)


@query("timeseries_tail_zoned")
def q_timeseries_tail_zoned(spark, sf_dir):
    """D2 over an unpartitioned folder through its zone map."""
    path, zones = zoned_table(spark, sf_dir, processed(spark, sf_dir), "timestamp", "events-zoned")
    rows = scan_newest(spark, path, zones, PROCESSED_SCHEMA, 500)
    return present(tail_ascending(rows.select("event_id", "timestamp", "temperature", "humidity", "precipitation", "wind_speed"),
                                  500, "timestamp", ["event_id"]))


@query("latest_predictions_zoned")
def q_latest_predictions_zoned(spark, sf_dir):
    """D3 over an unpartitioned folder through its zone map."""
    path, zones = zoned_table(spark, sf_dir, predictions(spark, sf_dir), "timestamp", "predictions-zoned")
    rows = scan_newest(spark, path, zones, PREDICTION_SCHEMA, 20).where(F.col("timestamp").isNotNull())
    return present(present_columns(newest(rows, 20, "timestamp", ["event_id"]), ["event_id"] + PREDICTION_VIEW))


@query("alert_flag_zoned")
def q_alert_flag_zoned(spark, sf_dir):
    """C8 over unpartitioned folders: both tables through their zone maps."""
    p, p_zones = zoned_table(spark, sf_dir, processed(spark, sf_dir), "timestamp", "alert-events")
    r, r_zones = zoned_table(spark, sf_dir, predictions(spark, sf_dir), "timestamp", "alert-predictions")
    return alert_flag(scan_newest(spark, p, p_zones, PROCESSED_SCHEMA, RECENT), scan_newest(spark, r, r_zones, PREDICTION_SCHEMA, RECENT))


# ---------------------------------------------------------------- F8
@query("bi_changed_rows")
def q_bi_changed_rows(spark, sf_dir):
    """F8: window rows arrive in three batches; per batch, the newest
    window of each city is pushed if it is newer than the last push."""
    agg = present(aggregates(spark, sf_dir), WINDOW_ROUND)
    of = slicer(spark, sf_dir)
    folder = scratch_path(spark, "agg-slices")
    tagged = agg.withColumn("slice", of(F.col("window_start")))
    landed = scratch_path(spark, "agg-tagged")
    tagged.write.parquet(landed)    # the windows are computed once, then dealt out
    tagged = spark.read.parquet(landed)
    for k in range(3):
        tagged.where(F.col("slice") == k).drop("slice").repartition(files_per_slice(spark)) \
            .write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_slice(spark))
              .parquet(folder))
    out = scratch_path(spark, "bi-pushed")
    q = start_bi_push(spark, stream, out, out + "-ckpt")
    jobs.await_all(spark, [q], TIMEOUT_S)
    out_df = pushed_rows(spark, out).drop("Timestamp")
    return out_df.withColumn("batch", F.col("batch").cast("long"))
