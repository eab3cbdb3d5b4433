"""Producer runs: events numbered over all runs, then sent to the topic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk.operators.observations import apply_anomalies
from skyrisk.operators.ordinal import with_ordinal
from skyrisk.schemas import EVENT_COLUMNS
from skyrisk.sinks.claims import Claim, claim, finish
from skyrisk.sinks.topic import to_records, write_topic
from skyrisk.sources.topic import Topic


def ledger_of(topic: Topic) -> str | None:
    """Where a file topic keeps its ledger: a folder inside it that readers skip."""
    return f"{topic.path.rstrip('/')}/_ledger" if topic.fmt == "files" and topic.path else None


def _send(spark: SparkSession, topic: Topic, ledger: str | None, run: str, count: int, events: Callable[[int], DataFrame], keyed: bool,
          partitions: int | None) -> Claim:
    c = claim(spark, ledger, run, count) if ledger else Claim(0, 0, count, False)
    if not c.done:
        write_topic(to_records(events(c.first), "seq" if keyed else None, EVENT_COLUMNS), topic, partitions=partitions)
        if ledger:
            finish(spark, ledger, c)
    return c


def send_events(events: DataFrame, topic: Topic, run: str, order: str, tie: list[str], ledger: str | None = None, demo: bool = False,
                keyed: bool = True, partitions: int | None = None) -> Claim:
    """One run's events, numbered in (``order``, ``tie``) order after those of all runs
    before it; the number is the record key and, with ``demo``, what the anomaly rules go by.

    Without a ledger numbers begin at 0.  A run that failed before its end was marked sends
    the same records under the same keys when started again."""
    spark = events.sparkSession
    rows = with_ordinal(events, order, name="seq", tie=tie)

    def numbered(first: int) -> DataFrame:
        out = rows.withColumn("seq", F.col("seq") + F.lit(first))
        return apply_anomalies(out, "seq") if demo else out
    return _send(spark, topic, ledger, run, rows.count(), numbered, keyed, partitions)


def send_synthetic(spark: SparkSession, count: int, topic: Topic, run: str, rate: int, seed: int, city: str, ledger: str | None = None,
                   keyed: bool = True, partitions: int | None = None) -> Claim:
    """``count`` Gaussian events after those of all runs before, from now on at ``rate`` a second."""
    from skyrisk.operators.observations import synth_gauss

    def numbered(first: int) -> DataFrame:
        ids = spark.range(first, first + count).withColumnRenamed("id", "seq")
        start = F.current_timestamp() - F.make_interval(secs=F.lit(first / rate))
        return synth_gauss(ids, "seq", start, rate, seed, city)
    return _send(spark, topic, ledger, run, count, numbered, keyed, partitions)
