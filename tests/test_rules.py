import math

from skyrisk.functions.rules import prediction_text, risk_label, risk_level

# (temperature, precipitation, wind_speed, expected label)
BOUNDARY = [
    (29.99, 0.0, 0.0, 0), (30.0, 0.0, 0.0, 1), (35.0, 0.0, 0.0, 1), (35.01, 0.0, 0.0, 2),
    (10.0, 19.99, 0.0, 0), (10.0, 20.0, 0.0, 1), (10.0, 50.0, 0.0, 1), (10.0, 50.01, 0.0, 2),
    (10.0, 0.0, 39.99, 0), (10.0, 0.0, 40.0, 1), (10.0, 0.0, 60.0, 1), (10.0, 0.0, 60.01, 2),
    (31.0, 0.0, 61.0, 2), (None, 0.0, 0.0, 0), (math.nan, 0.0, 0.0, 2),
]


def test_risk_label_boundaries(spark):
    df = spark.createDataFrame(BOUNDARY, "temperature double, precipitation double, "
                                         "wind_speed double, expected int")
    out = df.withColumn("risk_label", risk_label()).withColumn("risk_level", risk_level())
    rows = out.collect()
    for r in rows:
        assert r["risk_label"] == r["expected"], r
    names = {0: "normal", 1: "moderate", 2: "critical"}
    assert all(r["risk_level"] == names[r["risk_label"]] for r in rows)


def test_prediction_text_unknown(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,), (None,)], "prediction double")
    got = [r[0] for r in df.select(prediction_text()).collect()]
    assert got == ["normal", "moderate", "critical", "unknown", "unknown"]
