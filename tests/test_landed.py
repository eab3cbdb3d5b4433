"""Merged day tables, open windows, counts from footers, skipped files, model numbers."""

import pathlib
import threading

import pytest
from pyspark.sql import functions as F

from skyrisk.operators import ml, serving as S
from skyrisk.operators.windows import window_statistics
from skyrisk.schemas import AGGREGATE_SCHEMA, PROCESSED_SCHEMA
from skyrisk.session import scratch_path
from skyrisk.sources.files import child_folders, scan_parquet, skipped_files
from skyrisk.sources.topic import Topic
from skyrisk.streaming import jobs
from skyrisk.streaming.merged import merged_sink, read_merged
from skyrisk.streaming.state import open_windows

DAY = 86_400


def _events(spark, path, *rows):
    """rows: (key, city, seconds since the epoch, temperature)."""
    df = spark.createDataFrame(list(rows), "key string, city string, s long, temperature double")
    event = F.struct("city", F.date_format(F.timestamp_seconds("s"), "yyyy-MM-dd'T'HH:mm").alias("timestamp"), "temperature",
                     F.lit(50.0).alias("humidity"), F.lit(0.0).alias("precipitation"), F.lit(5.0).alias("wind_speed"))
    df.select("key", F.to_json(event).alias("value")).coalesce(1).write.mode("append").json(path)


def _merge(spark, topic, out, ckpt):
    stats = window_statistics(jobs.clean_stream(spark, topic, "earliest", 1), "1 hour", "10 days")
    jobs.await_all(spark, [merged_sink(stats, out, ckpt)], 120)
    return sorted((r.city, r.window_start.day, r.event_count, r.max_temperature) for r in read_merged(spark, out, AGGREGATE_SCHEMA).collect())


def _written(spark, out):
    return {f: [d for d in child_folders(spark, f"{out}/{f}")] for f in child_folders(spark, out)}


def test_batches_write_only_the_days_they_touch(spark):
    topic, out = Topic(path=scratch_path(spark, "t")), scratch_path(spark, "m")
    _events(spark, topic.path, *[(str(i), "a", i * DAY, 10.0) for i in range(5)])
    assert len(_merge(spark, topic, out, out + "-c")) == 5
    _events(spark, topic.path, ("9", "a", 4 * DAY, 20.0), ("10", "b", 4 * DAY, 1.0))
    got = _merge(spark, topic, out, out + "-c")
    assert got == [("a", 1, 1, 10.0), ("a", 2, 1, 10.0), ("a", 3, 1, 10.0), ("a", 4, 1, 10.0), ("a", 5, 2, 20.0), ("b", 5, 1, 1.0)]
    days = {f: d for f, d in _written(spark, out).items() if f != "batch=0"}
    assert [d for ds in days.values() for d in ds] == ["window_date=1970-01-05"]
    since = read_merged(spark, out, AGGREGATE_SCHEMA, since="1970-01-05")
    assert since.count() == 2 and len(since.inputFiles()) <= 2


def test_old_versions_go_and_a_half_written_one_does_not_count(spark):
    topic, out = Topic(path=scratch_path(spark, "t")), scratch_path(spark, "m")
    for i in range(6):
        _events(spark, topic.path, (str(i), "a", 60 * i, float(i)))
    assert _merge(spark, topic, out, out + "-c") == [("a", 1, 6, 5.0)]
    assert sum(len(d) for d in _written(spark, out).values()) == 2
    read_merged(spark, out, AGGREGATE_SCHEMA).limit(0).write.parquet(f"{out}/batch=99/window_date=1970-01-01")  # no _SUCCESS beside it
    assert read_merged(spark, out, AGGREGATE_SCHEMA).count() == 1


def test_a_retried_batch_writes_the_same(spark):
    """The batch function run twice for one id, as after a failure between write and commit."""
    topic, out = Topic(path=scratch_path(spark, "t")), scratch_path(spark, "m")
    _events(spark, topic.path, ("1", "a", 0, 1.0))
    _events(spark, topic.path, ("2", "a", 0, 2.0))
    want = _merge(spark, topic, out, out + "-c")
    commits = pathlib.Path(out + "-c") / "commits"
    last = max(int(c.name) for c in commits.iterdir() if c.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)
    assert _merge(spark, topic, out, out + "-c") == want == [("a", 1, 2, 2.0)]


def test_a_new_checkpoint_begins_anew(spark):
    topic, out = Topic(path=scratch_path(spark, "t")), scratch_path(spark, "m")
    for i in range(3):
        _events(spark, topic.path, (str(i), "a", i * DAY, float(i)))
    assert len(_merge(spark, topic, out, out + "-c")) == 3
    other = Topic(path=scratch_path(spark, "t"))
    _events(spark, other.path, ("1", "b", 0, 7.0))
    assert _merge(spark, other, out, out + "-c2") == [("b", 1, 1, 7.0)]
    assert read_merged(spark, scratch_path(spark, "none"), AGGREGATE_SCHEMA).count() == 0


def test_a_new_checkpoint_s_snapshot_replaces_the_old_run_s(spark):
    topic, out = Topic(path=scratch_path(spark, "t")), scratch_path(spark, "snap")
    for i in range(3):
        _events(spark, topic.path, (str(i), "a", i * 3600, 1.0))

    def run(t, ckpt):
        stats = window_statistics(jobs.clean_stream(spark, t, "earliest", 1), "1 hour")
        jobs.await_all(spark, [jobs.table_snapshot_sink(stats, out, ckpt)], 120)
        return jobs.read_snapshot(spark, out, AGGREGATE_SCHEMA).count()
    assert run(topic, out + "-c") == 3
    other = Topic(path=scratch_path(spark, "t"))
    _events(spark, other.path, ("1", "b", 0, 7.0))
    assert run(other, out + "-c2") == 1


def test_open_windows_are_what_append_mode_holds_back(spark):
    topic = Topic(path=scratch_path(spark, "t"))
    d = {k: scratch_path(spark, k) for k in ("p", "a", "c")}
    _events(spark, topic.path, *[(str(i), "ab"[i % 2], 600 * i, float(i)) for i in range(40)])

    def run():
        qs = jobs.start_processing(spark, topic, d["p"], d["a"], d["c"], starting_offsets="earliest", width="1 hour", watermark="2 hours")
        jobs.await_all(spark, qs, 120)
        return {(r.city, r.window_start): (r.event_count, r.avg_temperature, r.max_temperature) for r in open_windows(spark, d["c"] + "/aggregates").collect()}

    def check(open_now):
        whole = {(r.city, r.window_start): (r.event_count, r.avg_temperature, r.max_temperature)
                 for r in window_statistics(spark.read.schema(PROCESSED_SCHEMA).parquet(d["p"]), "1 hour").collect()}
        closed = {(r.city, r.window_start) for r in spark.read.schema(AGGREGATE_SCHEMA).parquet(d["a"]).collect()}
        assert open_now == {k: v for k, v in whole.items() if k not in closed} and open_now and closed
    assert open_windows(spark, d["c"] + "/aggregates").count() == 0        # never started
    check(run())
    _events(spark, topic.path, ("50", "a", 600 * 39, 99.0), ("51", "b", 600 * 60, 5.0))
    check(run())


def test_counts_come_from_footers(spark):
    path = scratch_path(spark, "n")
    spark.range(1000).repartition(3).write.parquet(path)
    df = S.landed_status(spark, {"n": path, "none": path + "-x"})
    assert sorted(map(tuple, df.collect())) == [("n", 1000, True), ("none", 0, False)]
    assert "PushedAggregation: [COUNT(*)]" in df._jdf.queryExecution().toString()
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_skipped_files_are_told_apart(spark, tmp_path):
    path = str(tmp_path / "parts with blank")
    spark.range(5).coalesce(1).write.parquet(path)
    spark.range(0).coalesce(1).write.mode("append").parquet(path)
    good = next((tmp_path / "parts with blank").glob("*.parquet"))
    (tmp_path / "parts with blank" / "text.parquet").write_text("no parquet")
    (tmp_path / "parts with blank" / "nothing.parquet").write_bytes(b"")
    (tmp_path / "parts with blank" / "cut.parquet").write_bytes(good.read_bytes()[:-20])
    df = scan_parquet(spark, path, spark.range(1).schema, skip_corrupt=True)
    got = {r.path.rsplit("/", 1)[1]: (r.status, r.reason is not None) for r in skipped_files(spark, path, df).collect()}
    assert df.count() == 5 and {k: v for k, v in got.items() if not k.startswith("part-")} == \
        {"text.parquet": ("corrupt", True), "cut.parquet": ("corrupt", True)}
    assert [v for k, v in got.items() if k.startswith("part-")] == [("empty", False)]


@pytest.fixture(scope="module")
def forests(spark):
    base = spark.range(0, 60).select(
        *[F.col("id").cast("double").alias(c) for c in ml.FEATURE_COLUMNS], (F.col("id") % 2).alias("risk_label"))
    return {n: ml.train(base, num_trees=n) for n in (2, 3)}


def test_the_later_claim_wins_whatever_the_clocks_say(spark, forests, monkeypatch):
    root = scratch_path(spark, "m")
    ml.save_versioned(forests[2], spark, root, "a")
    monkeypatch.setattr(ml.time, "time_ns", lambda: 1)      # a clock far behind
    ml.save_versioned(forests[3], spark, root, "b")
    assert ml.load_latest(spark, root).stages[-1].getNumTrees == 3


def test_a_version_is_never_written_twice(spark, forests):
    root = scratch_path(spark, "m")
    ml.save_versioned(forests[2], spark, root, "a")
    with pytest.raises(FileExistsError):
        ml.save_versioned(forests[3], spark, root, "a")
    assert ml.load_latest(spark, root).stages[-1].getNumTrees == 2
    old = scratch_path(spark, "m")
    forests[2].write().save(f"{old}/v=a")                     # saved before claims were kept
    with pytest.raises(Exception):
        ml.save_versioned(forests[3], spark, old, "a")


def test_two_trainers_at_a_time(spark, forests):
    root, paths = scratch_path(spark, "m"), []
    threads = [threading.Thread(target=lambda n=n: paths.append(ml.save_versioned(forests[n], spark, root))) for n in (2, 3, 2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(p.rsplit("/", 1)[1] for p in paths) == ["v=v1", "v=v2", "v=v3"]
    newest = spark.read.schema(ml.POINTER_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{root}/latest").orderBy(F.desc("number")).first()
    assert newest["number"] == 3 and newest["version"] == "v3"
    ml.load_latest(spark, root)


