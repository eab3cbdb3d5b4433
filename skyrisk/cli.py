"""Command line for the pipeline's jobs.

    python -m skyrisk produce  --documents D | --synthetic N  --topic-path T [--demo]
    python -m skyrisk process  --topic-path T --processed P --aggregates A --checkpoints C
    python -m skyrisk train    --processed P --models M --metrics CSV
    python -m skyrisk predict  --topic-path T --models M --predictions R --checkpoints C
    python -m skyrisk bi-push  --aggregates A --out O --checkpoints C
    python -m skyrisk run-stats KIND --event-log L | --progress P | --topic-path T --processed P  --out O
    python -m skyrisk query    NAME --processed P --aggregates A --predictions R --out O

``--topic-format kafka --bootstrap host:port --topic-name weather_stream``
selects a Kafka topic instead of a file topic.  Streams default to
``--trigger availableNow`` (drain and stop); give an interval such as
``"5 seconds"`` to keep running.  All paths may be on any Hadoop file system.
"""

from __future__ import annotations

import argparse
import sys
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk.schemas import (AGGREGATE_SCHEMA, FEATURE_COLUMNS, PREDICTION_SCHEMA, PREDICTION_VIEW,
                             PROCESSED_SCHEMA)

SERVING = ["kpi", "alerts", "latest", "all", "summary", "risk-distribution",
           "prediction-distribution", "status", "bi-rows", "latest-predictions",
           "timeseries", "window-tail"]


class GateError(RuntimeError):
    """Training refused by a gate (no data, too few rows, empty split)."""


def _topic(a):
    from skyrisk.sources.topic import Topic
    return Topic(name=a.topic_name, fmt=a.topic_format, path=a.topic_path,
                 bootstrap=a.bootstrap)


def _common_topic(p):
    p.add_argument("--topic-format", default="files", choices=["files", "kafka"])
    p.add_argument("--topic-path")
    p.add_argument("--topic-name", default="weather_stream")
    p.add_argument("--bootstrap")
    p.add_argument("--starting-offsets", default="latest", help="earliest, or latest: what comes after the first start")
    p.add_argument("--max-per-trigger", type=int)
    p.add_argument("--trigger", default="availableNow")
    p.add_argument("--checkpoints", required=True)


def cmd_produce(spark: SparkSession, a) -> dict:
    """Events to the topic, from stored hourly documents or synthetic.

    Documents: exploded to events; the global ordinal over (time, document,
    position) is the record key (the producer's event counter), and with
    ``--demo`` the anomaly rules apply by that ordinal.  Synthetic: the
    Gaussian load-test generator, N ids spaced at ``--rate`` per second from now.
    The counter goes on from run to run by a ledger (a file topic keeps one inside its
    folder); a run started again under its ``--run-id`` sends the same keys, or nothing
    if it had ended.
    """
    from skyrisk.functions.timeparse import parse_event_time
    from skyrisk.operators import observations as O
    from skyrisk.sinks.producer import ledger_of, send_events, send_synthetic
    from skyrisk.sources.files import scan_hourly_documents

    topic, run = _topic(a), a.run_id or uuid.uuid4().hex
    ledger = a.ledger or ledger_of(topic)
    if a.documents:
        docs = scan_hourly_documents(spark, a.documents, multiline=True if a.multiline else None)
        events = O.build_event(O.explode_hourly(docs), a.city).withColumn("at", parse_event_time("timestamp"))
        sent = send_events(events, topic, run, "at", ["doc_id", "pos"], ledger, a.demo, not a.no_key, a.partitions)
    elif a.synthetic:
        sent = send_synthetic(spark, a.synthetic, topic, run, a.rate, a.seed, a.city or O.DEFAULT_CITY, ledger,
                              not a.no_key, a.partitions)
    else:
        raise ValueError("give --documents or --synthetic")
    return {"topic": a.topic_path or a.topic_name, "run": run, "first": sent.first, "count": sent.count, "again": sent.done}


def _start_zones(spark: SparkSession, a, *landed: tuple[str, str, str]) -> list:
    """Streams that keep the zone maps of (name, path, time column) tables up to date."""
    from skyrisk.sources.zones import start_zones
    from skyrisk.streaming import jobs
    for _, path, _ in landed:
        jobs.ensure_dir(spark, path)
    return [start_zones(spark, path, time_col, f"{a.zones}/{name}", f"{a.checkpoints}/zones-{name}", a.trigger, name=f"zones-{name}")
            for name, path, time_col in landed]


def cmd_process(spark: SparkSession, a) -> dict:
    from skyrisk.streaming import jobs
    listener = None
    if a.progress:
        from skyrisk.streaming.progress import ProgressCollector
        listener = ProgressCollector(spark, a.progress)
        spark.streams.addListener(listener)

    def zones():
        return _start_zones(spark, a, ("processed", a.processed, "timestamp"), ("aggregates", a.aggregates, "window_start"))
    try:
        qs = jobs.start_processing(spark, _topic(a), a.processed, a.aggregates, a.checkpoints,
                                   trigger=a.trigger, starting_offsets=a.starting_offsets,
                                   max_per_trigger=a.max_per_trigger, console=a.console,
                                   chain=a.chain or not (a.unchained or a.partition_by_date),
                                   partition_by_date=a.partition_by_date,
                                   width=a.width, watermark=a.watermark,
                                   state_partitions=a.state_partitions, timeout_s=a.timeout,
                                   lineage=a.lineage, named=True)
        drained = a.trigger in (None, "availableNow")
        if a.zones and not drained:
            qs += zones()
        jobs.await_all(spark, qs, a.timeout)
        if a.zones and drained:
            more = zones()
            qs += more
            jobs.await_all(spark, more, a.timeout)
        if listener:
            listener.finished([str(q.runId) for q in qs])
    finally:
        if listener:
            listener.close()
    return {"queries": len(qs)}


def cmd_train(spark: SparkSession, a) -> dict:
    """Gates -> label -> key split -> fit -> evaluate -> versioned model ->
    metric CSV.  A gate that fails raises GateError; one class only warns."""
    from skyrisk.functions.rules import risk_label, risk_level
    from skyrisk.operators import ml, serving as S
    from skyrisk.operators.clean import clean_features
    from skyrisk.sinks.files import write_metrics_csv
    from skyrisk.sources.files import scan_parquet

    processed = S.keyed(scan_parquet(spark, a.processed, PROCESSED_SCHEMA), a.key)
    gates = S.training_gates(processed, FEATURE_COLUMNS, a.key, train_fraction=a.train_fraction,
                             seed=a.seed).first()
    if not gates["can_train"]:
        raise GateError(f"training refused: {gates['status']} ({gates.asDict()})")
    if gates["status"] == "one_class":
        print("warning: only one risk class present; the model cannot discriminate",
              file=sys.stderr)
    rows = S.split_by_key(clean_features(processed).withColumn("risk_label", risk_label())
                          .withColumn("risk_level", risk_level()), a.key, a.train_fraction,
                          a.seed)
    t0 = time.perf_counter()
    model = ml.train(rows.where(F.col("split") == "train"))
    train_s = time.perf_counter() - t0
    metrics = ml.evaluate(ml.score(model, rows.where(F.col("split") == "test"),
                                   carry=["risk_label"]))
    version = a.version or time.strftime("%Y%m%d_%H%M%S")
    path = ml.save_versioned(model, spark, a.models, version)
    wide = metrics.select("*", F.lit(train_s).alias("train_time_s"),
                          F.lit(gates["total_rows"]).alias("total_rows"),
                          F.lit(gates["clean_rows"]).alias("clean_rows"))
    write_metrics_csv(S.to_metric_rows(wide), a.metrics)
    return {"model": path, **metrics.first().asDict()}


def cmd_predict(spark: SparkSession, a) -> dict:
    from skyrisk.operators.ml import load_latest
    from skyrisk.streaming import jobs
    model = load_latest(spark, a.models)
    checkpoint = f"{a.checkpoints}/predictions"
    scored = jobs.scoring_stream(spark, _topic(a), model, a.starting_offsets, a.max_per_trigger,
                                 f"{a.checkpoints}/start-predictions", (checkpoint,))
    qs = [jobs.parquet_sink(scored, a.predictions, checkpoint, "append", a.trigger)]
    if a.console:
        qs.append(jobs.console_sink(scored, trigger=a.trigger))
    drained, landed = a.trigger in (None, "availableNow"), ("predictions", a.predictions, "timestamp")
    if a.zones and not drained:
        qs += _start_zones(spark, a, landed)
    jobs.await_all(spark, qs, a.timeout)
    if a.zones and drained:
        more = _start_zones(spark, a, landed)
        qs += more
        jobs.await_all(spark, more, a.timeout)
    return {"queries": len(qs)}


def serving_query(spark: SparkSession, name: str, processed: str | None,
                  aggregates: str | None, predictions: str | None, limit: int | None = None,
                  pool: int = 1000, since: str | None = None, zones: str | None = None) -> DataFrame:
    """The read-side questions over the landed tables.

    The newest-N questions read only what can hold those rows: the newest days of a
    folder partitioned by date, or the files that the zone map under ``zones`` names.

    ``limit``: rows of the newest-N questions (by default 10 windows, 20
    predictions, 500 points of a series; ``all`` gives all windows).  ``since``: a
    day; tables partitioned by date are read from there on."""
    from skyrisk.operators import serving as S
    from skyrisk.functions.rules import risk_label, risk_level
    from skyrisk.operators.clean import clean_features
    from skyrisk.sources.files import is_dated, newest_days, read_aggregates, read_processed, scan_parquet
    from skyrisk.sources.zones import scan_newest

    def recent(whole, path, schema, date_col, table, n):
        """Rows that the newest ``n`` of a landed table are among."""
        if since:
            return whole()
        if is_dated(spark, path, date_col):
            return newest_days(spark, path, schema, date_col, n)
        return scan_newest(spark, path, f"{zones}/{table}", schema, n) if zones else whole()

    def P_newest(n):
        return recent(P, processed, PROCESSED_SCHEMA, "event_date", "processed", n)

    def A_newest(n):
        return recent(A, aggregates, AGGREGATE_SCHEMA, "window_date", "aggregates", n)

    def P():
        if since:
            return read_processed(spark, processed, since).drop("event_date")
        return scan_parquet(spark, processed, PROCESSED_SCHEMA)

    def A():
        if since:
            return read_aggregates(spark, aggregates, since).drop("window_date")
        return scan_parquet(spark, aggregates, AGGREGATE_SCHEMA)

    def R():
        return scan_parquet(spark, predictions, PREDICTION_SCHEMA)

    def R_newest(n):
        return scan_newest(spark, predictions, f"{zones}/predictions", PREDICTION_SCHEMA, n) if zones else R()

    def by_key(df, n, asc=False):
        df = S.keyed(df)
        rows = df.withColumn("__key", S.row_key(df))
        return (S.tail_ascending if asc else S.newest)(rows, n, "timestamp", ["__key"]).drop("__key")

    if name == "kpi":
        return S.kpi_summary(P())
    if name == "alerts":
        return S.alert_flag(S.keyed(P_newest(S.RECENT)), S.keyed(R_newest(S.RECENT)) if predictions else None)
    if name == "latest":
        return S.newest(A_newest(limit or 10), limit or 10, "window_start", ["city"])
    if name == "all":
        return S.newest(A_newest(limit), limit, "window_start", ["city"]) if limit else A()
    if name == "summary":
        return S.summary_stats(A_newest(pool), pool)
    if name == "risk-distribution":
        return S.class_distribution(clean_features(P()).withColumn("risk_label", risk_label())
                                    .withColumn("risk_level", risk_level()))
    if name == "prediction-distribution":
        return S.prediction_distribution(R())
    if name == "status":
        folders = {"processed": processed, "aggregates": aggregates} | ({"predictions": predictions} if predictions else {})
        if not since:
            return S.landed_status(spark, folders)
        return S.dataset_status({"processed": P(), "aggregates": A()} | ({"predictions": R()} if predictions else {}), spark)
    if name == "bi-rows":
        return S.bi_rows(S.latest_per_key(A(), "city", "window_start"))
    if name == "latest-predictions":
        return S.present_columns(by_key(R_newest(limit or 20).where(F.col("timestamp").isNotNull()), limit or 20),
                                 PREDICTION_VIEW)
    if name == "timeseries":
        return by_key(P_newest(limit or 500), limit or 500, asc=True)
    if name == "window-tail":
        return S.tail_ascending(A_newest(limit or 500), limit or 500, "window_start", ["city"])
    raise ValueError(f"unknown query {name}; one of {SERVING}")


def cmd_query(spark: SparkSession, a) -> dict:
    from skyrisk.sinks import files as sink
    df = serving_query(spark, a.name, a.processed, a.aggregates, a.predictions, a.limit,
                       a.pool, a.since, a.zones)
    if a.format == "csv":
        sink.export_csv(df, a.out)
    elif a.format == "json":
        sink.export_json(df, a.out)
    else:
        sink.write_parquet(df, a.out)
    return {"out": a.out}


def cmd_bi_push(spark: SparkSession, a) -> dict:
    from skyrisk.streaming import jobs
    from skyrisk.streaming.bi import start_bi_push
    stream = spark.readStream.schema(AGGREGATE_SCHEMA).parquet(a.aggregates)
    q = start_bi_push(spark, stream, a.out, f"{a.checkpoints}/bi", a.trigger)
    jobs.await_all(spark, [q], a.timeout)
    return {"out": a.out}


def cmd_run_stats(spark: SparkSession, a) -> dict:
    """Statistics per application log, rows and rates per run of a streaming query, what a
    file topic holds that the stream has not landed, windows that a stopped stream has not
    emitted, or files of a landed folder that a scan skips."""
    from skyrisk.operators import runstats
    from skyrisk.sinks import files as sink
    from skyrisk.sources.files import scan_event_log, scan_parquet, skipped_files
    from skyrisk.streaming import backlog as B
    from skyrisk.streaming.progress import progress_frame, throughput, throughput_wall
    from skyrisk.streaming.state import open_windows

    def progress():
        return progress_frame(spark.read.schema("value string").text(a.progress))

    def log():
        return scan_event_log(spark, a.event_log)
    df = {"throughput": lambda: throughput(progress()),
          "wall-clock": lambda: throughput_wall(progress()),
          "backlog": lambda: B.backlog(B.events_behind(spark, _topic(a), B.landed_events(spark, a.processed),
                                                       f"{a.checkpoints}/start" if a.checkpoints else None)),
          "open-windows": lambda: open_windows(spark, f"{a.checkpoints}/aggregates"),
          "skipped": lambda: skipped_files(spark, a.processed, scan_parquet(spark, a.processed, PROCESSED_SCHEMA, skip_corrupt=True)),
          "jobs": lambda: runstats.job_duration_stats(runstats.jobs_from_event_log(log())),
          "stages": lambda: runstats.stage_totals(runstats.stages_from_event_log(log())),
          "executors": lambda: runstats.executor_report(runstats.executors_from_event_log(log()), ["log", "failedTasks", "killedTasks"]),
          "attempts": lambda: runstats.attempts_from_event_log(log())}[a.kind]()
    sink.export_json(df, a.out)
    return {"out": a.out}


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="skyrisk")
    ap.add_argument("--master")
    sub = ap.add_subparsers(dest="cmd", required=True)

    g = sub.add_parser("produce", help="events (documents or synthetic) -> topic")
    g.add_argument("--topic-format", default="files", choices=["files", "kafka"])
    g.add_argument("--topic-path")
    g.add_argument("--topic-name", default="weather_stream")
    g.add_argument("--bootstrap")
    g.add_argument("--documents")
    g.add_argument("--synthetic", type=int)
    g.add_argument("--rate", type=int, default=5000)
    g.add_argument("--seed", type=int, default=42)
    g.add_argument("--city")
    g.add_argument("--demo", action="store_true")
    g.add_argument("--multiline", action="store_true", help="documents are pretty-printed")
    g.add_argument("--no-key", action="store_true", help="send values only")
    g.add_argument("--partitions", type=int, help="topic files (file topic only)")
    g.add_argument("--run-id", help="name of this run, to start it again")
    g.add_argument("--ledger", help="folder of the event counter (file topics have their own)")

    p = sub.add_parser("process", help="topic -> processed + window aggregates")
    _common_topic(p)
    p.add_argument("--processed", required=True)
    p.add_argument("--aggregates", required=True)
    p.add_argument("--console", action="store_true")
    p.add_argument("--chain", action="store_true", help="parse once: windows read processed "
                   "(the default, unless partitioned by date)")
    p.add_argument("--unchained", action="store_true", help="windows read the topic again")
    p.add_argument("--partition-by-date", action="store_true")
    p.add_argument("--width", default="1 minute")
    p.add_argument("--watermark", default="2 minutes")
    p.add_argument("--state-partitions", type=int)
    p.add_argument("--progress", help="folder for the progress of all batches")
    p.add_argument("--lineage", action="store_true", help="land each event's topic file (for run-stats backlog)")
    p.add_argument("--zones", help="folder for zone maps of both tables (for query --zones)")
    p.add_argument("--timeout", type=float)

    t = sub.add_parser("train", help="train, evaluate and store the risk model")
    t.add_argument("--processed", required=True)
    t.add_argument("--models", required=True)
    t.add_argument("--metrics", required=True)
    t.add_argument("--version")
    t.add_argument("--key", default="event_id")
    t.add_argument("--train-fraction", type=float, default=0.8)
    t.add_argument("--seed", type=int, default=42)

    r = sub.add_parser("predict", help="score the topic with the latest model")
    _common_topic(r)
    r.add_argument("--models", required=True)
    r.add_argument("--predictions", required=True)
    r.add_argument("--console", action="store_true")
    r.add_argument("--zones", help="folder for the zone map of predictions (for query --zones)")
    r.add_argument("--timeout", type=float)

    q = sub.add_parser("query", help="a read-side query written to a file")
    q.add_argument("name", choices=SERVING)
    q.add_argument("--processed")
    q.add_argument("--aggregates")
    q.add_argument("--predictions")
    q.add_argument("--limit", type=int)
    q.add_argument("--pool", type=int, default=1000, help="windows that summary looks at")
    q.add_argument("--since", help="first day to read of tables partitioned by date")
    q.add_argument("--zones", help="zone maps that process and predict wrote")
    q.add_argument("--out", required=True)
    q.add_argument("--format", default="json", choices=["json", "csv", "parquet"])

    b = sub.add_parser("bi-push", help="newest window per city, pushed when it changed")
    b.add_argument("--aggregates", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--checkpoints", required=True)
    b.add_argument("--trigger", default="availableNow")
    b.add_argument("--timeout", type=float)

    s = sub.add_parser("run-stats", help="statistics of past runs")
    s.add_argument("kind", choices=["jobs", "stages", "executors", "attempts", "throughput", "wall-clock", "backlog", "open-windows", "skipped"])
    s.add_argument("--event-log", help="event log file or folder")
    s.add_argument("--progress", help="progress folder of process")
    s.add_argument("--topic-format", default="files", choices=["files"])
    s.add_argument("--topic-path", help="topic (backlog)")
    s.add_argument("--topic-name", default="weather_stream")
    s.add_argument("--bootstrap")
    s.add_argument("--processed", help="landed events (backlog, skipped)")
    s.add_argument("--checkpoints", help="checkpoints of process (backlog, open-windows)")
    s.add_argument("--out", required=True)
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = parser().parse_args(argv)
    if spark is None:
        from skyrisk.session import build_session
        spark = build_session(a.master, app=f"skyrisk-{a.cmd}")
    return {"produce": cmd_produce, "process": cmd_process, "train": cmd_train,
            "predict": cmd_predict, "query": cmd_query, "bi-push": cmd_bi_push,
            "run-stats": cmd_run_stats}[a.cmd](spark, a)
