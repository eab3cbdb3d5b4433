"""Property tests: operators against plain-Python statements of the rules."""

import math

from hypothesis import HealthCheck, given, settings, strategies as st

from skyrisk.functions.rules import risk_label
from skyrisk.operators import ml
from skyrisk.operators.observations import explode_hourly
from skyrisk.operators.ordinal import with_ordinal
from skyrisk.schemas import HOURLY_DOC_SCHEMA

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
measure = st.one_of(st.none(), st.floats(min_value=-10, max_value=120, allow_nan=False),
                    st.sampled_from([20.0, 30.0, 35.0, 40.0, 50.0, 60.0]))


def label_py(t, p, w):
    def gt(x, v):
        return x is not None and x > v

    def inside(x, lo, hi):
        return x is not None and lo <= x <= hi
    if gt(t, 35) or gt(w, 60) or gt(p, 50):
        return 2
    if inside(t, 30, 35) or inside(p, 20, 50) or inside(w, 40, 60):
        return 1
    return 0


@SETTINGS
@given(st.lists(st.tuples(measure, measure, measure), min_size=1, max_size=30))
def test_risk_label_matches_rule(spark, rows):
    df = spark.createDataFrame(rows, "temperature double, precipitation double, wind_speed double")
    got = [r[0] for r in df.select(risk_label()).collect()]
    assert got == [label_py(*r) for r in rows]


@SETTINGS
@given(st.integers(1, 6), st.lists(st.integers(0, 8), min_size=8, max_size=8))
def test_explode_positions_and_nulls(spark, n_time, lengths):
    hourly = {"time": [f"t{i}" for i in range(n_time)]}
    names = [f.name for f in HOURLY_DOC_SCHEMA["hourly"].dataType.fields][1:]
    for name, ln in zip(names, lengths):
        hourly[name] = None if ln == 0 else (
            [i for i in range(ln)] if name == "weather_code" else [float(i) for i in range(ln)])
    df = spark.createDataFrame([{"doc_id": "d", "city": "c", "hourly": hourly}], HOURLY_DOC_SCHEMA)
    rows = explode_hourly(df).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(n_time))
    for r in rows:
        for name in names:
            arr = hourly[name]
            want = arr[r.pos] if arr is not None and r.pos < len(arr) else None
            assert r[name] == want


@SETTINGS
@given(st.sets(st.integers(-10**12, 10**12), min_size=1, max_size=300), st.integers(1, 9))
def test_ordinal_is_rank(spark, keys, buckets):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = sorted((r.k, r.ordinal) for r in with_ordinal(df, "k", buckets=buckets).collect())
    assert got == list(zip(sorted(keys), range(len(keys))))


def metrics_py(pairs):
    n = len(pairs)
    labels = sorted({l for l, _ in pairs})
    acc = sum(1 for l, p in pairs if l == p) / n
    wp = wr = wf = 0.0
    for c in labels:
        tp = sum(1 for l, p in pairs if l == c and p == c)
        pred = sum(1 for _, p in pairs if p == c)
        act = sum(1 for l, _ in pairs if l == c)
        prec = tp / pred if pred else 0.0
        rec = tp / act
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        wp, wr, wf = wp + prec * act / n, wr + rec * act / n, wf + f1 * act / n
    return acc, wp, wr, wf


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3)), min_size=1, max_size=80))
def test_metrics_match_definition(spark, pairs):
    df = spark.createDataFrame([(l, float(p)) for l, p in pairs],
                               "risk_label int, prediction double")
    got = ml.evaluate(df).first()
    want = metrics_py(pairs)
    for g, w in zip((got.accuracy, got.weightedPrecision, got.weightedRecall, got.f1), want):
        assert math.isclose(g, w, abs_tol=1e-12)
