"""The job command line end to end on a file topic (in-process)."""

import shutil

import pytest
from pyspark.sql import functions as F

from skyrisk.cli import GateError, SERVING, main
from skyrisk.session import scratch_path
from skyrisk.sinks.topic import write_topic
from skyrisk.sources import fixture as fx
from skyrisk.sources.topic import Topic


def test_process_train_predict_query(spark, sf_small):
    topic = Topic(path=scratch_path(spark, "cli-topic"))
    write_topic(fx.topic_records(fx.load_weather(spark, sf_small)), topic, partitions=2)
    d = {k: scratch_path(spark, k) for k in ("proc", "agg", "ckpt", "models", "metrics", "pred")}
    main(["process", "--topic-path", topic.path, "--processed", d["proc"], "--aggregates",
          d["agg"], "--checkpoints", d["ckpt"], "--chain", "--starting-offsets", "earliest", "--timeout", "300"], spark)
    from skyrisk.operators.clean import clean_required
    from skyrisk.operators.parse import parse_events
    expected = clean_required(parse_events(fx.topic_records(fx.load_weather(spark, sf_small))))
    assert spark.read.parquet(d["proc"]).count() == expected.count()
    out = main(["train", "--processed", d["proc"], "--models", d["models"], "--metrics",
                d["metrics"], "--version", "v1"], spark)
    assert 0.5 < out["accuracy"] <= 1.0
    metrics = {r.metric: r.value for r in
               spark.read.option("header", True).csv(d["metrics"]).collect()}
    assert set(metrics) >= {"accuracy", "weightedPrecision", "weightedRecall", "f1",
                            "total_rows", "clean_rows", "train_time_s"}
    main(["predict", "--topic-path", topic.path, "--models", d["models"], "--predictions",
          d["pred"], "--checkpoints", d["ckpt"] + "-p", "--starting-offsets", "earliest", "--timeout", "300",
          "--zones", d["pred"] + "-zones"], spark)
    preds = spark.read.parquet(d["pred"])
    assert preds.count() > 0 and preds.where(F.col("risk_prediction") == "unknown").count() == 0
    for name in SERVING:
        o = scratch_path(spark, "q-" + name)
        main(["query", name, "--processed", d["proc"], "--aggregates", d["agg"],
              "--predictions", d["pred"], "--out", o], spark)
        assert spark.read.json(o).count() >= 1, name
        if name == "status":
            rows = {r["dataset"]: r["rows"] for r in spark.read.json(o).collect()}
            assert rows == {"processed": expected.count(), "aggregates": spark.read.parquet(d["agg"]).count(), "predictions": preds.count()}
        if name in ("latest-predictions", "alerts"):        # predict's zone map gives the same answers
            z = scratch_path(spark, "z-" + name)
            main(["query", name, "--processed", d["proc"], "--predictions", d["pred"], "--zones", d["pred"] + "-zones", "--out", z], spark)
            assert sorted(map(str, spark.read.json(z).collect())) == sorted(map(str, spark.read.json(o).collect()))
    from skyrisk.sources.zones import read_zones
    assert read_zones(spark, d["pred"] + "-zones/predictions").agg(F.sum("rows")).first()[0] == preds.where("timestamp is not null").count()


def test_train_gate_on_missing_data(spark):
    with pytest.raises(GateError):
        main(["train", "--processed", scratch_path(spark, "none"), "--models",
              scratch_path(spark, "m"), "--metrics", scratch_path(spark, "x")], spark)


def test_produce_documents_demo_and_synthetic(spark, sf_small):
    from skyrisk.operators.parse import parse_events
    from skyrisk.sources.topic import read_topic_batch
    docs = scratch_path(spark, "docs")
    fx.hourly_documents(fx.load_weather(spark, sf_small)).write.json(docs)
    t1 = scratch_path(spark, "prod-docs")
    main(["produce", "--documents", docs, "--topic-path", t1, "--demo", "--partitions", "2"],
         spark)
    ev = parse_events(read_topic_batch(spark, Topic(path=t1))).collect()
    n_obs = spark.read.json(docs).select(F.explode("hourly.time")).count()
    assert len(ev) == n_obs
    by_seq = {r.event_id: r for r in ev}
    assert sorted(by_seq) == list(range(n_obs))
    assert by_seq[15].temperature == 36.5 and by_seq[25].precipitation == 55.0
    assert by_seq[40].wind_speed == 70.0
    t2 = scratch_path(spark, "prod-syn")
    main(["produce", "--synthetic", "3000", "--topic-path", t2], spark)
    syn = parse_events(read_topic_batch(spark, Topic(path=t2)))
    assert syn.count() == 3000 and syn.where(F.col("timestamp").isNull()).count() == 0


def test_query_output_formats(spark, sf_small):
    from skyrisk.plans.catalog import aggregates, processed
    proc, agg = scratch_path(spark, "fmt-proc"), scratch_path(spark, "fmt-agg")
    processed(spark, sf_small).write.parquet(proc)
    aggregates(spark, sf_small).write.parquet(agg)
    csv_out, pq_out = scratch_path(spark, "fmt-csv"), scratch_path(spark, "fmt-pq")
    main(["query", "kpi", "--processed", proc, "--out", csv_out, "--format", "csv"], spark)
    row = spark.read.option("header", True).csv(csv_out).first()
    assert int(row.total_events) == spark.read.parquet(proc).count()
    main(["query", "latest", "--aggregates", agg, "--limit", "5", "--out", pq_out,
          "--format", "parquet"], spark)
    got = spark.read.parquet(pq_out).orderBy(F.col("window_start").desc(),
                                             F.col("city").desc()).collect()
    want = spark.read.parquet(agg).orderBy(F.col("window_start").desc(),
                                           F.col("city").desc()).limit(5).collect()
    assert [(r.city, r.window_start) for r in got] == [(r.city, r.window_start) for r in want]


def test_keyless_documents_end_to_end(spark, sf_small):
    """Values only, documents without a city: produce, process, train, predict, look."""
    docs = scratch_path(spark, "docs-unnamed")
    w = fx.load_weather(spark, sf_small).withColumn("wind_speed", F.col("wind_speed"))
    rows = fx.hourly_documents(w, named=False)
    # the fixture leaves wind out; the pipeline's required columns need it
    hourly = F.col("hourly").withField("wind_speed_10m", F.transform("hourly.time", lambda t: F.lit(12.0)))
    rows.withColumn("hourly", hourly).write.json(docs)
    d = {k: scratch_path(spark, k) for k in ("t", "proc", "agg", "ckpt", "models", "metrics", "pred", "bi", "prog")}
    main(["produce", "--documents", docs, "--topic-path", d["t"], "--no-key", "--demo"], spark)
    main(["process", "--topic-path", d["t"], "--processed", d["proc"], "--aggregates", d["agg"], "--checkpoints", d["ckpt"],
          "--partition-by-date", "--width", "1 hour", "--state-partitions", "2", "--progress", d["prog"], "--starting-offsets", "earliest", "--timeout", "300"], spark)
    proc = spark.read.parquet(d["proc"])
    assert proc.count() > 100 and proc.where("event_id is null or city <> 'Mexico City'").count() == 0 and proc.select("event_id").distinct().count() > 100
    out = main(["train", "--processed", d["proc"], "--models", d["models"], "--metrics", d["metrics"]], spark)
    assert 0.5 < out["accuracy"] <= 1.0
    q = scratch_path(spark, "q")
    main(["query", "prediction-distribution", "--predictions", d["pred"], "--out", q], spark)   # none yet
    assert sorted(r["count"] for r in spark.read.json(q).collect()) == [0, 0, 0]
    main(["predict", "--topic-path", d["t"], "--models", d["models"], "--predictions", d["pred"], "--checkpoints", d["ckpt"] + "-p",
          "--starting-offsets", "earliest", "--timeout", "300"], spark)
    assert spark.read.parquet(d["pred"]).count() > 0
    for name, more in (("alerts", []), ("timeseries", ["--limit", "7"]), ("all", []), ("kpi", ["--since", "2024-01-01"])):
        o = scratch_path(spark, "q-" + name)
        main(["query", name, "--processed", d["proc"], "--aggregates", d["agg"], "--predictions", d["pred"], "--out", o, *more], spark)
        n = spark.read.json(o).count()
        assert n == {"timeseries": 7, "all": spark.read.parquet(d["agg"]).count()}.get(name, 1)
    main(["bi-push", "--aggregates", d["agg"], "--out", d["bi"], "--checkpoints", d["ckpt"] + "-bi", "--timeout", "300"], spark)
    assert spark.read.parquet(d["bi"] + "/rows").count() == 1
    o = scratch_path(spark, "rate")
    main(["run-stats", "throughput", "--progress", d["prog"], "--out", o], spark)
    rates = {r["name"]: r["sent"] for r in spark.read.json(o).collect()}
    assert set(rates) == {"processed", "aggregates"} and len(set(rates.values())) == 1 and min(rates.values()) > 0
    o = scratch_path(spark, "wall")
    main(["run-stats", "wall-clock", "--progress", d["prog"], "--out", o], spark)
    assert {r["name"]: r["sent"] for r in spark.read.json(o).collect()} == rates


def scan_count(spark, path, column):
    from skyrisk.schemas import AGGREGATE_SCHEMA
    from skyrisk.sources.files import scan_parquet
    return scan_parquet(spark, path, AGGREGATE_SCHEMA).agg(F.sum(column)).first()[0] or 0


def test_latest_zones_backlog_and_counter(spark, sf_small):
    """A job from "latest" over two producer runs, its zone maps, and what it is behind."""
    import json

    d = {k: scratch_path(spark, k) for k in ("t", "proc", "agg", "ckpt", "zones", "plain")}
    process = ["process", "--topic-path", d["t"], "--processed", d["proc"], "--aggregates", d["agg"], "--checkpoints", d["ckpt"],
               "--lineage", "--zones", d["zones"], "--timeout", "300"]

    def ids(path):
        return sorted(r["event_id"] for r in spark.read.parquet(path).select("event_id").collect())

    def behind():
        o = scratch_path(spark, "behind")
        main(["run-stats", "backlog", "--topic-path", d["t"], "--processed", d["proc"], "--checkpoints", d["ckpt"], "--out", o], spark)
        return [(r["files_behind"], r["events_behind"]) for r in spark.read.json(o).collect()]
    first = main(["produce", "--synthetic", "300", "--topic-path", d["t"], "--run-id", "a", "--partitions", "2"], spark)
    main(process, spark)                                      # nothing since the start
    assert first["first"] == 0 and behind() == [(0, 0)]
    second = main(["produce", "--synthetic", "500", "--topic-path", d["t"], "--run-id", "b", "--partitions", "2"], spark)
    assert second["first"] == 300 and behind() == [(2, 500)]
    again = main(["produce", "--synthetic", "500", "--topic-path", d["t"], "--run-id", "b", "--partitions", "2"], spark)
    assert again["again"] and again["first"] == 300 and behind() == [(2, 500)]
    main(process, spark)
    assert ids(d["proc"]) == list(range(300, 800)) and behind() == [(0, 0)]
    third = main(["produce", "--synthetic", "10", "--topic-path", d["t"]], spark)
    assert third["first"] == 800
    o = scratch_path(spark, "open")
    main(["run-stats", "open-windows", "--checkpoints", d["ckpt"], "--out", o], spark)
    closed = scan_count(spark, d["agg"], "event_count")
    assert closed + (spark.read.json(o).agg(F.sum("event_count")).first()[0] or 0) == 500
    spark.createDataFrame([("x",)], "value string").coalesce(1).write.text(d["plain"] + "-bad")
    bad = spark.read.format("binaryFile").load(d["plain"] + "-bad").first()["path"].removeprefix("file:")
    spark.read.parquet(d["proc"]).write.parquet(d["plain"] + "-proc")
    shutil.copy(bad, d["plain"] + "-proc/bad.parquet")
    o = scratch_path(spark, "skipped")
    main(["run-stats", "skipped", "--processed", d["plain"] + "-proc", "--out", o], spark)
    assert [r["status"] for r in spark.read.json(o).collect()] == ["corrupt"]
    answers = {}
    for name in ("latest", "timeseries", "window-tail", "alerts", "summary", "all"):
        for more in ([], ["--zones", d["zones"]]):
            o = scratch_path(spark, "q")
            main(["query", name, "--processed", d["proc"], "--aggregates", d["agg"], "--limit", "7", "--out", o, *more], spark)
            answers.setdefault(name, []).append(sorted(json.dumps(r.asDict(), default=str, sort_keys=True) for r in spark.read.json(o).collect()))
    for name, (plain, zoned) in answers.items():
        assert plain == zoned, name
    with pytest.raises(ValueError, match="lineage"):
        spark.read.parquet(d["proc"]).drop("source_file").write.parquet(d["plain"])
        main(["run-stats", "backlog", "--topic-path", d["t"], "--processed", d["plain"], "--out", d["plain"] + "-o"], spark)
