"""The values FIXTURES.md states for sf0.01, reproduced by the catalogue."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q():
    return E.queries()


def test_clean_counts(spark, q):
    assert q["clean_required"](spark, SF).count() == 9486
    assert q["clean_strict"](spark, SF).count() == 8929


def test_risk_labels_over_processed(spark, q):
    got = {r.risk_level: r["count"] for r in q["risk_distribution_processed"](spark, SF).collect()}
    assert got == {"normal": 2685, "moderate": 3658, "critical": 3143}


def test_window_counts(spark, q):
    assert q["window_stats_1m"](spark, SF).count() == 9377
    assert q["window_stats_1h"](spark, SF).count() == 5282
    assert q["stream_window_append"](spark, SF).count() == 9376


def test_run_statistics(spark, q):
    j = q["run_job_stats"](spark, SF).first()
    assert (j.jobs, j.avg_s, j.min_s, j.max_s) == (9800, 18.381939, 0.0, 39.0)
    s = q["run_stage_stats"](spark, SF).first()
    assert (s.shuffle_read_bytes, s.shuffle_write_bytes, s.gc_ms) == (22725915, 24995000, 144073)
    assert q["run_executor_stats"](spark, SF).count() == 8


def test_fixture_prediction_metrics(spark, q):
    m = q["eval_metrics"](spark, SF).first()
    assert (m.accuracy, m.weightedPrecision, m.weightedRecall, m.f1) == \
        (0.584836, 0.763077, 0.584836, 0.579122)
