"""Start positions, the producer's counter, zone maps, backlog, throughput by the clock."""

import json
import random
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyrisk.operators import runstats
from skyrisk.operators.serving import newest
from skyrisk.schemas import AGGREGATE_SCHEMA, TOPIC_SCHEMA
from skyrisk.session import scratch_path
from skyrisk.sinks.claims import claim, create_once, finish
from skyrisk.sources.files import scan_event_log
from skyrisk.sources.start import Start, read_start, start_of
from skyrisk.sources.topic import Topic, read_topic_stream
from skyrisk.sources.zones import files_of_newest, read_zones, scan_newest, start_zones
from skyrisk.streaming import jobs
from skyrisk.streaming.progress import progress_frame, throughput, throughput_wall


def _put(spark, path, *keys):
    spark.createDataFrame([(k, "{}") for k in keys], TOPIC_SCHEMA).coalesce(1).write.mode("append").json(path)


def _drain(spark, topic, out, **kw):
    q = jobs.parquet_sink(read_topic_stream(spark, topic, **kw), out, out + "-ckpt")
    jobs.await_all(spark, [q], 120)
    return sorted(r["key"] for r in spark.read.schema(TOPIC_SCHEMA).parquet(out).collect())


# ---------------------------------------------------------------- start position
def test_latest_leaves_out_what_was_there_and_keeps_its_start(spark):
    topic, out = Topic(path=scratch_path(spark, "t")), scratch_path(spark, "o")
    _put(spark, topic.path, "old1", "old2")
    _put(spark, topic.path, "old3")
    assert _drain(spark, topic, out, start=out + "-s") == []
    kept = read_start(spark, out + "-s")
    _put(spark, topic.path, "new1")
    assert _drain(spark, topic, out, start=out + "-s") == ["new1"]
    _put(spark, topic.path, "new2")
    assert _drain(spark, topic, out, start=out + "-s") == ["new1", "new2"]
    assert read_start(spark, out + "-s") == kept and kept.newest_us
    assert _drain(spark, topic, scratch_path(spark, "o2"), starting_offsets="earliest") == ["new1", "new2", "old1", "old2", "old3"]


def test_latest_of_an_empty_topic_counts_everything(spark):
    topic, out = Topic(path=scratch_path(spark, "t")), scratch_path(spark, "o")
    assert _drain(spark, topic, out, start=out + "-s") == []
    _put(spark, topic.path, "a")
    assert _drain(spark, topic, out, start=out + "-s") == ["a"]


def test_files_of_the_start_s_own_instant(spark):
    """Equal times: listed files are old, others new."""
    at = datetime(2024, 1, 1)
    rows = spark.createDataFrame([("a", at), ("b", at), ("c", at + timedelta(seconds=1)), ("d", at - timedelta(days=1))], "file string, time timestamp")
    us = int(rows.select(F.unix_micros("time")).first()[0])
    assert sorted(r["file"] for r in rows.where(Start(us, ("a",)).condition("file", "time")).collect()) == ["b", "c"]
    assert Start(None, ()).condition() is None


def test_a_checkpoint_without_a_start_began_at_the_first_file(spark):
    topic, out = Topic(path=scratch_path(spark, "t")), scratch_path(spark, "o")
    _put(spark, topic.path, "a")
    assert _drain(spark, topic, out, starting_offsets="earliest") == ["a"]
    assert start_of(spark, topic.path, out + "-s", (out + "-ckpt",)).newest_us is None
    _put(spark, topic.path, "b")
    assert _drain(spark, topic, out, start=out + "-s") == ["a", "b"]


def test_latest_needs_a_folder_and_a_known_offset(spark):
    for kw in ({}, {"starting_offsets": "12"}):
        with pytest.raises(ValueError):
            read_topic_stream(spark, Topic(path=scratch_path(spark, "t")), **kw)


def test_old_files_are_not_listed_for_the_scan(spark):
    """The condition works on the listing: the batch reader of the same rows opens new files only."""
    path = scratch_path(spark, "t")
    _put(spark, path, "old")
    start = start_of(spark, path, path + "-s")
    _put(spark, path, "new")
    df = spark.read.schema(TOPIC_SCHEMA).json(path).where(start.condition()).select("key")
    assert [r["key"] for r in df.collect()] == ["new"]
    plan = df._jdf.queryExecution().executedPlan()
    scan = plan if plan.children().isEmpty() else plan.collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1


# ---------------------------------------------------------------- counter
def test_a_file_is_created_once(spark):
    path = scratch_path(spark, "once") + "/x.json"
    got = []
    threads = [threading.Thread(target=lambda i=i: got.append((create_once(spark, path, str(i)), i))) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    winners = [i for made, i in got if made]
    assert len(winners) == 1 and spark.read.text(path).first()[0] == str(winners[0])
    assert not create_once(spark, path, "later")


def test_claims_have_no_gap_and_no_overlap(spark):
    ledger, got = scratch_path(spark, "ledger"), []
    counts = [5, 0, 7, 1, 9, 3]
    threads = [threading.Thread(target=lambda i=i, n=n: got.append(claim(spark, ledger, f"r{i}", n))) for i, n in enumerate(counts)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    got.sort(key=lambda c: c.number)
    assert [c.number for c in got] == list(range(6)) and sorted(c.count for c in got) == sorted(counts)
    assert all(b.first == a.first + a.count for a, b in zip(got, got[1:])) and got[0].first == 0
    assert all(c == claim(spark, ledger, f"r{counts.index(c.count)}", c.count) for c in got)   # started again: the same
    finish(spark, ledger, got[2])
    assert claim(spark, ledger, f"r{counts.index(got[2].count)}", got[2].count).done
    with pytest.raises(ValueError):
        claim(spark, ledger, "r0", 6)


# ---------------------------------------------------------------- zones
def _windows(spark, lo, hi):
    base = spark.range(lo, hi).select((F.col("id") % 3).cast("string").alias("city"),
                                      F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("window_start"))
    return base.select(*[F.col(f.name) if f.name in base.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in AGGREGATE_SCHEMA.fields
                         if f.name != "event_count"], F.col("window_start").cast("long").alias("event_count"))


def _zones(spark, path):
    jobs.await_all(spark, [start_zones(spark, path, "window_start", path + "-z", path + "-c")], 120)


def test_files_read_do_not_grow_with_the_table(spark):
    path, read = scratch_path(spark, "w"), []
    for k in range(8):
        _windows(spark, 100 * k, 100 * (k + 1)).repartitionByRange(2, "window_start").write.mode("append").parquet(path)
        if k < 7:
            _zones(spark, path)
        if k > 1:
            rows = scan_newest(spark, path, path + "-z", AGGREGATE_SCHEMA, 20)
            read.append(len(rows.inputFiles()))
            want = [(r.city, r.window_start) for r in newest(spark.read.parquet(path), 20, "window_start", ["city"]).collect()]
            assert [(r.city, r.window_start) for r in newest(rows, 20, "window_start", ["city"]).collect()] == want
    assert read[:-1] == [1] * 5 and read[-1] == 3     # the last job's two files are not in the map


def test_zones_of_missing_times_overlaps_and_small_tables(spark):
    path = scratch_path(spark, "w")
    assert scan_newest(spark, path, path + "-z", AGGREGATE_SCHEMA, 5).count() == 0
    _windows(spark, 0, 10).withColumn("window_start", F.lit(None).cast("timestamp")).coalesce(1).write.parquet(path)
    rng = random.Random(1)
    for _ in range(5):
        lo = rng.randrange(300)
        _windows(spark, lo, lo + 150).repartition(2).write.mode("append").parquet(path)
    _zones(spark, path)
    _zones(spark, path)
    assert read_zones(spark, path + "-z").count() == 11 and files_of_newest(spark, path, path + "-z", 751) is None
    whole = spark.read.parquet(path)
    for n in (1, 40, 700, 755):
        rows = scan_newest(spark, path, path + "-z", AGGREGATE_SCHEMA, n)
        got, want = ([(r.window_start, r.event_count) for r in newest(d, n, "window_start", ["event_count"]).collect()] for d in (rows, whole))
        assert sorted(got, key=str) == sorted(want, key=str)
    spark.read.parquet(path).limit(3).write.mode("overwrite").parquet(path + "-new")


# ---------------------------------------------------------------- throughput
def _lines(spark, batches):
    rows = [json.dumps({"runId": run, "name": name, "timestamp": at.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z", "batchId": i, "numInputRows": n,
                        "durationMs": {"triggerExecution": ms}}) for run, name, i, at, ms, n in batches]
    return progress_frame(spark.createDataFrame([(r,) for r in rows], "value string"))


def test_wall_clock_against_a_sweep(spark):
    rng, t0, batches = random.Random(3), datetime(2024, 1, 1), []
    for run in ("a", "b", None):
        for i in range(120):
            batches.append((run, "q", i, t0 + timedelta(milliseconds=rng.randrange(20_000_000)), rng.choice([0, 10, 1000, 400_000, 9_000_000 if i == 3 else 5]),
                            rng.randrange(50)))
    got = {r["runId"]: r for r in throughput_wall(_lines(spark, batches + batches[:7])).collect()}
    for run in ("a", "b", None):
        own = sorted(((b[3] - t0) // timedelta(milliseconds=1), (b[3] - t0) // timedelta(milliseconds=1) + b[4]) for b in batches if b[0] == run)
        busy, far, pauses = 0, None, 0
        for f, t in own:
            pauses += far is not None and f > far
            busy += max(0, t - (f if far is None else max(f, far)))
            far = t if far is None else max(far, t)
        r, sent = got[run], sum(b[5] for b in batches if b[0] == run)
        wall = (far - own[0][0]) / 1000
        assert (r["sent"], r["batches"], r["pauses"], r["busy_s"], r["wall_s"]) == (sent, 120, pauses, busy / 1000, wall)
        assert abs(r["rate_ev_s"] - sent / wall) < 1e-9


def test_runs_and_queries_are_told_apart(spark):
    at = datetime(2024, 1, 1)
    rows = [("r1", "processed", 0, at, 1000, 10), ("r1", "aggregates", 0, at, 1000, 10), ("r2", "processed", 0, at, 1000, 5)]
    assert sorted((r["runId"], r["name"], r["sent"]) for r in throughput(_lines(spark, rows)).collect()) == \
        [("r1", "aggregates", 10), ("r1", "processed", 10), ("r2", "processed", 5)]
    assert _lines(spark, rows).where("offsets_behind_latest is not null").count() == 0
    assert throughput_wall(_lines(spark, rows[:1]).limit(0)).count() == 0


# ---------------------------------------------------------------- executors
def test_executors_of_cut_logs_and_resubmitted_tasks(spark, tmp_path):
    def end(executor, reason, metrics=True):
        line = {"Event": "SparkListenerTaskEnd", "Stage ID": 1, "Stage Attempt ID": 0, "Task End Reason": {"Reason": reason},
                "Task Info": {"Executor ID": executor, "Launch Time": 100, "Finish Time": 350}}
        return line | ({"Task Metrics": {"Executor Run Time": 200, "JVM GC Time": 7}} if metrics else {})
    lines = [{"Event": "SparkListenerExecutorAdded", "Timestamp": 5, "Executor ID": "1", "Executor Info": {"Host": "h", "Total Cores": 4}},
             {"Event": "SparkListenerBlockManagerAdded", "Block Manager ID": {"Executor ID": "1"}, "Maximum Memory": 1000, "Timestamp": 6},
             end("1", "Success"), end("1", "Resubmitted"), end("1", "FetchFailed"), end("1", "TaskKilled", False), end("2", "Success"),
             {"Event": "SparkListenerExecutorRemoved", "Timestamp": 900, "Executor ID": "1", "Removed Reason": "x"}, {"Event": "Other"}]
    (tmp_path / "log").write_text("\n".join(json.dumps(x) for x in lines) + "\nnot json\n")
    log = scan_event_log(spark, str(tmp_path))
    got = {r["id"]: r for r in runstats.executors_from_event_log(log).collect()}
    one = got["1"]
    assert (one["totalCores"], one["maxMemory"], one["completedTasks"], one["failedTasks"], one["killedTasks"]) == (4, 1000, 1, 1, 1)
    assert (one["totalDuration"], one["totalGCTime"], one["addedMs"], one["removedMs"]) == (750, 14, 5, 900)
    assert got["2"]["totalCores"] is None and got["2"]["completedTasks"] == 1
    report = {r["id"]: r for r in runstats.executor_report(runstats.executors_from_event_log(log), ["log"]).collect()}
    assert report["1"]["run_s"] == 0.75 and report["2"]["memory_mb"] == 0
    a = runstats.attempts_from_event_log(log).collect()
    assert len(a) == 1 and (a[0]["completedTasks"], a[0]["failedTasks"], a[0]["killedTasks"], a[0]["executorRunMs"]) == (2, 1, 1, 600)
