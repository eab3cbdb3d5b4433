from pyspark.sql import functions as F

from skyrisk.operators.observations import (apply_anomalies, build_event, explode_hourly,
                                            inject_anomalies, synth_gauss, synth_uniform)
from skyrisk.operators.ordinal import with_ordinal
from skyrisk.schemas import HOURLY_DOC_SCHEMA


def test_explode_short_missing_long_arrays(spark):
    doc = {"doc_id": "d", "city": "X", "hourly": {
        "time": ["t0", "t1", "t2"],
        "temperature_2m": [1.0, 2.0, 3.0],
        "relative_humidity_2m": [10.0],                 # shorter
        "precipitation": [0.0, 0.1, 0.2, 0.3, 0.4],     # longer: extra ignored
        "wind_gusts_10m": None,                         # missing
        "surface_pressure": [1.0, 1.0, 1.0],
        "apparent_temperature": [1.0, 2.0, 3.0],
        "weather_code": [0, 1, 2],
        "wind_speed_10m": [5.0, 5.0, 5.0]}}
    df = spark.createDataFrame([doc], HOURLY_DOC_SCHEMA)
    rows = explode_hourly(df).orderBy("pos").collect()
    assert [r.time for r in rows] == ["t0", "t1", "t2"]
    assert [r.relative_humidity_2m for r in rows] == [10.0, None, None]
    assert [r.precipitation for r in rows] == [0.0, 0.1, 0.2]
    assert all(r.wind_gusts_10m is None for r in rows)
    ev = build_event(explode_hourly(df)).collect()
    assert ev[0]["city"] == "X" and ev[0]["timestamp"] == "t0" and ev[0]["humidity"] == 10.0


def test_anomaly_rules_by_ordinal(spark):
    ords = [0, 15, 25, 40, 75, 600, 7]
    df = spark.createDataFrame([(o, 20.0, 1.0, 5.0) for o in ords],
                               "ordinal long, temperature double, precipitation double, "
                               "wind_speed double")
    out = {r.ordinal: r for r in apply_anomalies(df).collect()}
    assert (out[0].temperature, out[0].precipitation, out[0].wind_speed) == (20.0, 1.0, 5.0)
    assert out[15].temperature == 36.5 and out[15].precipitation == 1.0
    assert out[25].precipitation == 55.0 and out[25].temperature == 20.0
    assert out[40].wind_speed == 70.0
    assert out[75].temperature == 36.5 and out[75].precipitation == 55.0
    assert (out[600].temperature, out[600].precipitation, out[600].wind_speed) == (36.5, 55.0, 70.0)
    assert out[7].temperature == 20.0


def test_ordinal_equals_row_number_on_skewed_keys(spark):
    # a third of the keys packed in a narrow range, the rest spread out
    keys = list(range(0, 3000)) + [10_000 + 97 * i for i in range(6000)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    got = sorted((r.k, r.ordinal) for r in with_ordinal(df, "k", buckets=5).collect())
    assert got == list(zip(sorted(keys), range(len(keys))))


def test_inject_anomalies_global_order(spark):
    df = spark.range(0, 200).select((F.col("id") * 3).alias("eid"),
                                    F.lit(20.0).alias("temperature"),
                                    F.lit(1.0).alias("precipitation"),
                                    F.lit(5.0).alias("wind_speed"))
    out = {r.eid: r for r in inject_anomalies(df, "eid").collect()}
    assert out[45].temperature == 36.5       # ordinal 15
    assert out[0].temperature == 20.0        # ordinal 0
    assert out[75].precipitation == 55.0     # ordinal 25


def test_synth_gauss_ranges_and_determinism(spark):
    ids = spark.range(0, 20000).withColumnRenamed("id", "eid")
    a = synth_gauss(ids, "eid", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    s = a.agg(F.min("humidity"), F.max("humidity"), F.min("precipitation"), F.min("wind_speed"),
              F.avg("surface_pressure"), F.count_if(F.col("temperature") > 35).alias("heat"),
              F.count_if(F.col("precipitation") > 50).alias("rain"),
              F.count_if(F.col("wind_speed") > 60).alias("wind")).first()
    assert 0.0 <= s[0] and s[1] <= 100.0 and s[2] >= 0.0 and s[3] >= 0.0
    assert abs(s[4] - 1015.0) < 0.2
    share = (s["rain"] + s["wind"] + s["heat"]) / 20000
    assert 0.035 < share < 0.07
    b = synth_gauss(ids.repartition(5), "eid", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert sorted(a.collect()) == sorted(b.collect())
    times = {r.timestamp for r in a.select("timestamp").distinct().collect()}
    assert times == {"2024-01-01T00:00"}     # 20,000 ids at 5,000/s = 4 s


def test_synth_uniform_bands(spark):
    rate = spark.range(0, 20000).select(F.col("id").alias("value"),
                                        F.lit("2024-01-01 00:00:00").cast("timestamp")
                                        .alias("timestamp"))
    out = synth_uniform(rate)
    s = out.agg(F.count_if(F.col("temperature") >= 35).alias("h"),
                F.count_if(F.col("wind_speed") >= 60).alias("w"),
                F.count_if(F.col("precipitation") >= 50).alias("r"),
                F.count_if((F.col("temperature") >= 35) & (F.col("wind_speed") >= 60)).alias("hw")
                ).first()
    for c in ("h", "w", "r"):
        assert 700 < s[c] < 1300
    assert s["hw"] == 0


def test_ordinal_key_types(spark):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 1, 0, 0, i), dt.date(2024, 1, 1 + i)) for i in range(20)]
    df = spark.createDataFrame(rows, "t timestamp, d date")
    got = sorted((r.t, r.ordinal) for r in with_ordinal(df, "t", buckets=3).collect())
    assert [o for _, o in got] == list(range(20))
    got = sorted((r.d, r.ordinal) for r in with_ordinal(df, "d", buckets=3).collect())
    assert [o for _, o in got] == list(range(20))
    names = spark.createDataFrame([(f"{i:02d}",) for i in range(20)], "s string")
    got = sorted((r.s, r.ordinal) for r in with_ordinal(names, "s", buckets=3).collect())
    assert [o for _, o in got] == list(range(20))


def test_ordinal_spreads_a_hot_key(spark):
    """Half of the rows share one key: the ties spread them over the ranges."""
    from skyrisk.operators.ordinal import ranged
    df = spark.range(0, 8000).select(
        F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id") % 100).alias("k"),
        F.col("id").alias("t")).repartition(4)
    sizes = [r["count"] for r in ranged(df, "k", 8, ["t"]).groupBy("__part").count().collect()]
    assert len(sizes) >= 7 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    out = with_ordinal(df, "k", buckets=8, tie=["t"]).collect()
    assert [(r.k, r.t) for r in sorted(out, key=lambda r: r.ordinal)] == sorted((r.k, r.t) for r in out)


def test_draws_do_not_repeat_past_31_bits(spark):
    from skyrisk.functions.randomness import with_uniforms
    ids = [5, 5 * 2**31, 2**31 + 4, 4 * 2**31 + 1, 7 + 2**40, 2**61 + 3]
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    rows = with_uniforms(df, "k", 42, [1, 2, 3, 4]).collect()
    assert len({tuple(r)[1:] for r in rows}) == len(ids)
    big = spark.range(0, 20000).select((F.col("id") * (2**31 + 17)).alias("k"))
    u = with_uniforms(big, "k", 1, [1]).agg(F.avg("__u1").alias("m"), F.countDistinct("__u1").alias("n")).first()
    assert abs(u["m"] - 0.5) < 0.02 and u["n"] > 19900


def test_city_defaults_where_the_document_names_none(spark, tmp_path):
    from skyrisk.operators.observations import build_event, explode_hourly
    from skyrisk.sources.files import scan_hourly_documents
    hourly = '{"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, 2.5]}'
    lines, pretty = tmp_path / "lines", tmp_path / "pretty"
    lines.mkdir()
    pretty.mkdir()
    (lines / "a.json").write_text('{"hourly": %s}\n{"city": "X", "doc_id": "d", "hourly": %s}\n' % (hourly, hourly))
    (pretty / "b.json").write_text('\n{\n  "hourly": {\n    "time": ["2024-01-01T00:00"],\n    "temperature_2m": [3.0]\n  }\n}\n')
    rows = build_event(explode_hourly(scan_hourly_documents(spark, str(lines)))).collect()
    assert sorted(r.city for r in rows) == ["Mexico City"] * 2 + ["X"] * 2
    assert all(r.doc_id for r in rows)
    one = build_event(explode_hourly(scan_hourly_documents(spark, str(pretty)))).collect()
    assert [(r.city, r.temperature) for r in one] == [("Mexico City", 3.0)]


def test_ordinal_null_keys_and_ties(spark):
    rows = [(None, "b"), (None, "a"), (5, "z"), (5, "y"), (1, "q"), (9, "c")] + \
        [(100 + i, "x") for i in range(50)]
    df = spark.createDataFrame(rows, "k long, t string").repartition(3)
    out = with_ordinal(df, "k", buckets=4, tie=["t"]).collect()
    assert len(out) == len(rows)                      # no row lost
    order = [(r.k, r.t) for r in sorted(out, key=lambda r: r.ordinal)]
    assert order[:6] == [(None, "a"), (None, "b"), (1, "q"), (5, "y"), (5, "z"), (9, "c")]
    assert sorted(r.ordinal for r in out) == list(range(len(rows)))
