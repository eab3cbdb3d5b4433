"""Stream equals batch under the watermark rule; restart; rate source;
change push."""

import uuid

from pyspark.sql import functions as F

from skyrisk.operators.clean import clean_required
from skyrisk.operators.parse import parse_events
from skyrisk.operators.windows import closed_windows, window_statistics
from skyrisk.schemas import AGGREGATE_SCHEMA
from skyrisk.session import scratch_path
from skyrisk.sinks.topic import write_topic
from skyrisk.sources import fixture as fx
from skyrisk.sources.rate import rate_micro_batch
from skyrisk.sources.topic import Topic
from skyrisk.streaming import jobs
from skyrisk.streaming.bi import changed_rows


def _topic_in_time_order(spark, sf, parts):
    """Topic written as ``parts`` files, one write per event-time slice, so
    file order (modification time) is time order: in-order input."""
    from skyrisk.plans.catalog_stream import slicer
    of = slicer(spark, sf, parts)
    ev = fx.load_table(spark, sf, "events")
    w = fx.weather_events(ev.withColumn("slice", of(F.col("ts"))), keep=["slice"])
    topic = Topic(path=scratch_path(spark, "t"))
    for k in range(parts):
        write_topic(fx.topic_records(w.where(F.col("slice") == k)).coalesce(1), topic)
    return topic, w.drop("slice")


def _batch_expectation(spark, w):
    clean = clean_required(parse_events(fx.topic_records(w)))
    stats = window_statistics(clean)
    mx = clean.agg(F.max("timestamp")).first()[0]
    return closed_windows(stats, F.lit(mx), 120)


def _rows(df):
    return sorted((r.city, r.window_start, r.event_count, round(r.avg_temperature, 6))
                  for r in df.collect())


def test_stream_equals_batch_one_and_many_batches(spark, sf_small):
    topic, w = _topic_in_time_order(spark, sf_small, 4)
    expected = _rows(_batch_expectation(spark, w))
    for per_trigger in (None, 1):
        proc, agg = scratch_path(spark, "p"), scratch_path(spark, "a")
        qs = jobs.start_processing(spark, topic, proc, agg, scratch_path(spark, "c"),
                                   starting_offsets="earliest", max_per_trigger=per_trigger)
        jobs.await_all(spark, qs, 300)
        got = _rows(spark.read.schema(AGGREGATE_SCHEMA).parquet(agg))
        assert got == expected, per_trigger


def test_chained_processing_equals_direct(spark, sf_small):
    topic, w = _topic_in_time_order(spark, sf_small, 2)
    proc, agg = scratch_path(spark, "p"), scratch_path(spark, "a")
    qs = jobs.start_processing(spark, topic, proc, agg, scratch_path(spark, "c"),
                               starting_offsets="earliest", chain=True)
    jobs.await_all(spark, qs, 300)
    assert _rows(spark.read.schema(AGGREGATE_SCHEMA).parquet(agg)) == \
        _rows(_batch_expectation(spark, w))


def test_rate_micro_batch_source(spark):
    df = rate_micro_batch(spark, rows_per_batch=50, start_ms=0, advance_ms=1000)
    name = "rate_" + uuid.uuid4().hex[:8]
    q = df.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    try:
        q.awaitTermination(120)
    finally:
        q.stop()
    # availableNow on a generator source runs at least one batch
    rows = spark.sql(f"select * from {name}").collect()
    assert len(rows) % 50 == 0
    assert sorted(r.value for r in rows) == list(range(len(rows)))


def test_changed_rows_only_newer_windows(spark):
    agg = spark.createDataFrame(
        [("A", "2024-01-01 00:01:00", "2024-01-01 00:02:00", 1.0, 1),
         ("A", "2024-01-01 00:02:00", "2024-01-01 00:03:00", 2.0, 1),
         ("B", "2024-01-01 00:00:00", "2024-01-01 00:01:00", 3.0, 1)],
        "city string, window_start string, window_end string, avg_temperature double, "
        "event_count long").select("city", F.col("window_start").cast("timestamp"),
                                   F.col("window_end").cast("timestamp"), "avg_temperature",
                                   "event_count")
    first = changed_rows(agg, None).collect()
    assert sorted((r.City, r.WindowStart) for r in first) == [
        ("A", "2024-01-01T00:02:00"), ("B", "2024-01-01T00:00:00")]
    from skyrisk.streaming.bi import merge_state
    first_df = changed_rows(agg, None)
    pushed = merge_state(None, first_df)
    again = changed_rows(agg, pushed).collect()
    assert again == []


def test_console_sink_runs(spark, sf_small, capsys):
    """K4: console output of a bounded stream (debug sink)."""
    topic, _ = _topic_in_time_order(spark, sf_small, 1)
    clean = jobs.clean_stream(spark, topic, "earliest")
    q = jobs.console_sink(clean.select("city", "temperature"), trigger="availableNow", rows=3)
    jobs.await_all(spark, [q], 120)
    assert q.lastProgress is not None and q.lastProgress["numInputRows"] > 0


def test_await_all_raises_on_timeout(spark):
    df = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    q = df.writeStream.format("noop").start()
    import pytest
    with pytest.raises(TimeoutError):
        jobs.await_all(spark, [q], 2)
    assert not q.isActive


def test_date_partitioned_tables_prune(spark, sf_small):
    from skyrisk.sources.files import read_aggregates, read_processed
    topic, w = _topic_in_time_order(spark, sf_small, 2)
    proc, agg = scratch_path(spark, "p"), scratch_path(spark, "a")
    qs = jobs.start_processing(spark, topic, proc, agg, scratch_path(spark, "c"),
                               starting_offsets="earliest", partition_by_date=True)
    jobs.await_all(spark, qs, 300)
    assert _rows(read_aggregates(spark, agg)) == _rows(_batch_expectation(spark, w))
    recent = read_processed(spark, proc, since="2024-01-20")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-20" in plan
    n_all = read_processed(spark, proc).count()
    n_recent = recent.count()
    assert 0 < n_recent < n_all
    assert n_recent == read_processed(spark, proc).where(
        F.to_date("timestamp") >= F.lit("2024-01-20").cast("date")).count()


def test_progress_listener_table(spark, sf_small):
    """a StreamingQueryListener's progress events as a typed table."""
    from skyrisk.streaming.progress import ProgressCollector, throughput
    topic, _ = _topic_in_time_order(spark, sf_small, 6)
    collector = ProgressCollector(spark, scratch_path(spark, "progress"), every=3)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")   # a ring that loses batches
    spark.streams.addListener(collector)
    try:
        proc, agg = scratch_path(spark, "p"), scratch_path(spark, "a")
        qs = jobs.start_processing(spark, topic, proc, agg, scratch_path(spark, "c"),
                                   starting_offsets="earliest", max_per_trigger=1)
        jobs.await_all(spark, qs, 300)
        table = collector.finished([str(q.runId) for q in qs])
    finally:
        spark.streams.removeListener(collector)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    rows = table.collect()
    assert len(rows) >= 12 and not collector.events
    assert all(len(q.recentProgress) <= 2 for q in qs)
    assert sum(r.numInputRows for r in rows) >= 2 * spark.read.parquet(proc).count()
    assert any(r.watermark is not None for r in rows)
    t = throughput(table).collect()
    assert all(r.rate_ev_s >= 0 for r in t)


def test_processing_with_console_sinks_terminates(spark, sf_small):
    topic, _ = _topic_in_time_order(spark, sf_small, 1)
    qs = jobs.start_processing(spark, topic, scratch_path(spark, "p"), scratch_path(spark, "a"),
                               scratch_path(spark, "c"), starting_offsets="earliest",
                               console=True)
    assert len(qs) == 4
    jobs.await_all(spark, qs, 300)


def test_jdbc_batch_frame(spark):
    from skyrisk.streaming.jdbc import jdbc_batch_frame
    df = spark.range(0, 100, numPartitions=16).withColumnRenamed("id", "x")
    out = jdbc_batch_frame(df, 7, num_partitions=4)
    assert out.rdd.getNumPartitions() == 4
    assert "REPARTITION" in out._jdf.queryExecution().executedPlan().toString()
    assert out.columns == ["x", "batch_id"]
    assert {r.batch_id for r in out.select("batch_id").distinct().collect()} == {7}


def test_jdbc_batch_replaces_its_earlier_attempt(spark, tmp_path):
    """Statements only: the delete names the batch, and comes before the insert."""
    import pytest
    from skyrisk.streaming.jdbc import delete_statement, start_jdbc_sink
    assert delete_statement("s.windows", 7) == "DELETE FROM s.windows WHERE batch_id = 7"
    with pytest.raises(ValueError):
        delete_statement("windows; DROP TABLE x", 1)
    said = []
    stream = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    q = start_jdbc_sink(stream, "jdbc:none:x", "windows", str(tmp_path / "c"),
                        trigger="1 second", execute=lambda s, url, st, p: said.append(st))
    with pytest.raises(Exception):
        q.awaitTermination(60)
    assert said and said[0] == "DELETE FROM windows WHERE batch_id = 0"


def test_snapshots_are_whole(spark, tmp_path):
    import pytest
    path = str(tmp_path / "snap")
    with pytest.raises(FileNotFoundError):
        jobs.read_snapshot(spark, path)
    spark.range(3).write.parquet(f"{path}/batch=4")
    spark.range(9).write.parquet(f"{path}/batch=5")
    (tmp_path / "snap" / "batch=5" / "_SUCCESS").unlink()          # still being written
    assert jobs.read_snapshot(spark, path).count() == 3


def test_newest_rows_read_only_their_days(spark, tmp_path):
    from pyspark.sql import types as T
    from skyrisk.sources.files import newest_dated
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.TimestampType())])
    df = spark.range(0, 30 * 24).select("id", (F.lit("2024-01-01 00:00:00").cast("timestamp")
                                               + F.make_interval(hours=F.col("id").cast("int"))).alias("t"))
    path = str(tmp_path / "d")
    df.withColumn("day", F.to_date("t")).write.partitionBy("day").parquet(path)
    got = newest_dated(spark, path, schema, "day", 30, "t", ["id"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-29" in plan
    assert [r.id for r in got.collect()] == list(range(719, 689, -1))
    assert newest_dated(spark, path, schema, "day", 5000, "t", ["id"]).count() == 720


def test_recent_files_of_a_stream_sink_are_committed_ones(spark, tmp_path):
    from skyrisk.sources.files import scan_recent_files
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).coalesce(1).write.parquet(src)
    q = jobs.parquet_sink(spark.readStream.schema("id long").parquet(src), out, str(tmp_path / "c"))
    jobs.await_all(spark, [q], 120)
    spark.range(100, 103).coalesce(1).write.mode("append").parquet(str(tmp_path / "left"))
    for f in (tmp_path / "left").glob("*.parquet"):
        f.rename(tmp_path / "out" / f"part-99999-{f.name}")        # left by an attempt that failed
    got = scan_recent_files(spark, out, 5)
    assert sorted(r.id for r in got.collect()) == [0, 1, 2, 3, 4]


def test_latest_per_key_is_one_pass(spark, sf_small):
    from skyrisk.operators.serving import latest_per_key
    from skyrisk.plans.catalog import aggregates
    plan = latest_per_key(aggregates(spark, sf_small), "city", "window_start") \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "SortAggregate" not in plan and "Join" not in plan


def test_latest_per_key_takes_whole_rows(spark):
    from skyrisk.operators.serving import latest_per_key
    rows = [("a", 10, 1.0, 9), ("a", 20, 5.0, 1), ("a", 20, 2.0, 7), ("a", 20, None, 8), ("a", None, 99.0, 99), ("b", -5, 1.0, 2), ("b", -5, 1.0, 2)]
    df = spark.createDataFrame(rows, "city string, s long, x double, n long").select(
        "city", F.timestamp_seconds("s").alias("window_start"), "x", "n")
    for parts in (1, 5):
        got = {r.city: (r.x, r.n) for r in latest_per_key(df.repartition(parts), "city", "window_start").collect()}
        assert got["a"] in [(5.0, 1), (2.0, 7), (None, 8)] and got["b"] == (1.0, 2)
        first = got if parts == 1 else first
        assert got == first


def test_bi_state_that_cannot_be_read_stops_the_batch(spark, tmp_path):
    import pytest
    from skyrisk.streaming.bi import _last_state, drop_old_states
    root = tmp_path / "_state"
    assert _last_state(spark, str(root), 3) is None
    state = spark.createDataFrame([("X", "2024-01-01T00:00:00")], "City string, last_start string")
    for b in (0, 1, 2):
        state.write.parquet(str(root / f"batch={b}"))
    drop_old_states(spark, str(root), 3)
    assert sorted(p.name for p in root.iterdir()) == ["batch=2"]
    assert _last_state(spark, str(root), 3).count() == 1
    assert _last_state(spark, str(root), 7).count() == 1           # a gap: the newest there is
    for f in (root / "batch=2").glob("*.parquet"):
        f.write_bytes(b"damaged")
    with pytest.raises(Exception):
        _last_state(spark, str(root), 3).collect()


def test_one_failing_query_stops_the_group(spark):
    """any query ending in error stops the others and raises."""
    import pytest
    ok = spark.readStream.format("rate").option("rowsPerSecond", 5).load() \
        .writeStream.format("noop").start()

    def boom(batch, batch_id):
        raise ValueError("sink failed")

    bad = spark.readStream.format("rate").option("rowsPerSecond", 5).load() \
        .writeStream.foreachBatch(boom).start()
    with pytest.raises(RuntimeError, match="streaming query failed"):
        jobs.await_all(spark, [bad, ok], 120)
    assert not ok.isActive and not bad.isActive


def test_bi_push_resumes_from_checkpoint(spark, sf_small):
    """F8 + F10: a second run on the same checkpoint pushes only the new
    batch and finds the last pushed state of the previous run."""
    from skyrisk.plans.catalog import aggregates
    from skyrisk.plans.catalog_stream import slicer
    from skyrisk.streaming.bi import pushed_rows, start_bi_push
    agg = aggregates(spark, sf_small)
    of = slicer(spark, sf_small, 3)
    tagged = agg.withColumn("slice", of(F.col("window_start")))
    folder, out = scratch_path(spark, "agg-in"), scratch_path(spark, "bi-out")
    ckpt = out + "-ckpt"
    schema = None
    for k in range(3):
        tagged.where(F.col("slice") == k).drop("slice").coalesce(1) \
            .write.mode("append").parquet(folder)
        if schema is None:
            schema = spark.read.parquet(folder).schema
        if k >= 1:
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
                .parquet(folder)
            jobs.await_all(spark, [start_bi_push(spark, stream, out, ckpt)], 300)
    rows = pushed_rows(spark, out).collect()
    assert sorted({r.batch for r in rows}) == [0, 1, 2]
    cities = {r.city for r in agg.select("city").collect()}
    for b in (0, 1, 2):
        batch_rows = [r for r in rows if r.batch == b]
        assert len({r.City for r in batch_rows}) == len(batch_rows) <= len(cities)
    # every pushed window is newer than the one pushed for that city before it
    last = {}
    for r in sorted(rows, key=lambda r: r.batch):
        assert r.City not in last or r.WindowStart > last[r.City]
        last[r.City] = r.WindowStart
