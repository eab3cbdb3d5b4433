import json

from skyrisk.operators import runstats
from skyrisk.schemas import PROCESSED_SCHEMA
from skyrisk.session import scratch_path
from skyrisk.sources import files as src


def test_missing_folders_are_empty(spark):
    missing = scratch_path(spark, "nothing-here")
    df = src.scan_parquet(spark, missing, PROCESSED_SCHEMA)
    assert df.count() == 0 and df.schema == PROCESSED_SCHEMA
    assert src.scan_metrics_csv(spark, missing).count() == 0


def test_recent_files_by_modification_time(spark):
    path = scratch_path(spark, "recent")
    for i in range(3):
        spark.range(i * 10, i * 10 + 5).coalesce(1).write.mode("append").parquet(path)
    got = sorted(r.id for r in src.scan_recent_files(spark, path, 2).collect())
    assert got == list(range(10, 15)) + list(range(20, 25))


def test_event_log_jobs_and_stages(spark):
    lines = [
        {"Event": "SparkListenerJobStart", "Job ID": 0, "Submission Time": 1000},
        {"Event": "SparkListenerJobEnd", "Job ID": 0, "Completion Time": 3500},
        {"Event": "SparkListenerJobStart", "Job ID": 1, "Submission Time": 4000},
        {"Event": "SparkListenerStageCompleted", "Stage Info": {"Stage ID": 3, "Accumulables": [
            {"Name": "internal.metrics.shuffle.write.bytesWritten", "Value": "100"},
            {"Name": "internal.metrics.jvmGCTime", "Value": "7"}]}},
    ]
    path = scratch_path(spark, "eventlog")
    spark.createDataFrame([(json.dumps(x),) for x in lines], "value string") \
        .coalesce(1).write.text(path)    # a log is one file
    log = src.scan_event_log(spark, path)
    stats = runstats.job_duration_stats(runstats.jobs_from_event_log(log)).first()
    assert stats.jobs == 1 and stats.avg_s == 2.5
    st = runstats.stage_totals(runstats.stages_from_event_log(log)).first()
    assert (st.shuffle_read_bytes, st.shuffle_write_bytes, st.gc_ms) == (0, 100, 7)


def test_event_logs_of_two_applications(spark, tmp_path):
    """Three jobs of 0.5 s in each of two logs with the same ids, one rolled and
    packed with zstd, one a plain file."""
    import json

    import zstandard
    from skyrisk.operators.runstats import job_duration_stats, jobs_from_event_log
    from skyrisk.sources.files import scan_event_log

    def lines(t0):
        out = []
        for j in range(3):
            out.append(json.dumps({"Event": "SparkListenerJobStart", "Job ID": j, "Submission Time": t0 + j * 1000}))
            out.append(json.dumps({"Event": "SparkListenerJobEnd", "Job ID": j, "Completion Time": t0 + j * 1000 + 500}))
        return out
    rolled = tmp_path / "eventlog_v2_app-1"
    rolled.mkdir()
    a = lines(1_700_000_000_000)
    for i, part in enumerate((a[:3], a[3:])):
        (rolled / f"events_{i + 1}_app-1.zstd").write_bytes(zstandard.compress(("\n".join(part) + "\n").encode()))
    (tmp_path / "app-2").write_text("\n".join(lines(1_700_000_100_000)) + "\n")
    log = scan_event_log(spark, str(tmp_path))
    assert log.select("log").distinct().count() == 2
    s = job_duration_stats(jobs_from_event_log(log)).first()
    assert (s.jobs, s.min_s, s.max_s) == (6, 0.5, 0.5)


def test_skipped_files_are_named(spark, tmp_path):
    from skyrisk.sources.files import scan_parquet, unread_files
    from pyspark.sql.types import LongType, StructField, StructType
    path = str(tmp_path / "t")
    spark.range(5).coalesce(1).write.parquet(path)
    (tmp_path / "t" / "bad.parquet").write_bytes(b"not parquet")
    df = scan_parquet(spark, path, StructType([StructField("id", LongType())]), skip_corrupt=True)
    assert df.count() == 5
    assert [r.path.rsplit("/", 1)[1] for r in unread_files(spark, path, df).collect()] == ["bad.parquet"]


def test_packed_event_logs_are_streamed(spark, tmp_path):
    """Logs of several zstd frames, under both names, are read line by line: no file becomes one value."""
    import zstandard
    lines = [json.dumps({"Event": f"e{i}"}) + "\n" for i in range(5000)]
    packed = b"".join(zstandard.compress("".join(lines[i:i + 700]).encode()) for i in range(0, 5000, 700))
    (tmp_path / "app-1.zstd").write_bytes(packed)
    (tmp_path / "app-2.zst").write_bytes(packed)
    (tmp_path / "app-3").write_text("".join(lines))
    log = src.scan_event_log(spark, str(tmp_path))
    assert sorted(r["count"] for r in log.groupBy("log").count().collect()) == [5000] * 3
    assert log.select("line").distinct().count() == 5000 and log.where("Event = 'e4999'").count() == 3
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "MapInArrow" not in plan
