from skyrisk.operators.clean import clean_features, clean_required, clean_strict
from skyrisk.operators.parse import parse_events

GOOD = ('{"city":"A","timestamp":"2024-01-15T12:00","temperature":22.5,"humidity":65.0,'
        '"precipitation":0.0,"wind_speed":8.5,"wind_gusts":15.2,"surface_pressure":1013.5,'
        '"apparent_temperature":21.0,"weather_code":0}')


def _records(spark, values):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)],
                                 "key string, value string")


def test_parse_good_and_wrong_types(spark):
    rows = [
        GOOD,
        GOOD.replace('"temperature":22.5', '"temperature":22'),          # int for double
        GOOD.replace('"temperature":22.5', '"temperature":"22.5"'),      # string for double
        GOOD.replace('"weather_code":0', '"weather_code":1.0'),          # double for int
        GOOD.replace('"weather_code":0', '"weather_code":"7"'),          # string for int
    ]
    out = {r["event_id"]: r for r in parse_events(_records(spark, rows)).collect()}
    assert out[0]["temperature"] == 22.5 and out[0]["weather_code"] == 0
    assert str(out[0]["timestamp"]) == "2024-01-15 12:00:00"
    assert out[1]["temperature"] == 22.0
    assert out[2]["temperature"] is None and out[2]["city"] == "A"
    assert out[3]["weather_code"] is None
    assert out[4]["weather_code"] is None


def test_broken_records_give_null_rows(spark):
    rows = ["not json", GOOD[:20], "[" + GOOD + "]", ""]
    out = parse_events(_records(spark, rows)).collect()
    assert len(out) == 4
    for r in out:
        assert all(r[c] is None for c in ("city", "timestamp", "temperature"))


def test_bad_times_are_null(spark):
    rows = [GOOD.replace("2024-01-15T12:00", t) for t in
            ["2024-01-15T12:00:30", "2024-01-15 12:00", "bad"]]
    rows.append(GOOD.replace('"timestamp":"2024-01-15T12:00",', ""))
    out = parse_events(_records(spark, rows)).collect()
    assert [r["timestamp"] for r in out] == [None] * 4


def test_three_null_rules(spark):
    rows = [
        GOOD,
        GOOD.replace('"wind_gusts":15.2', '"wind_gusts":null'),       # ok for 6, not 8/10
        GOOD.replace('"humidity":65.0', '"humidity":NaN'),            # NaN counts as null
        GOOD.replace('"city":"A"', '"city":null'),                    # fails 6 and 10 only
    ]
    parsed = parse_events(_records(spark, rows))
    assert sorted(r.event_id for r in clean_required(parsed).collect()) == [0, 1]
    assert sorted(r.event_id for r in clean_strict(parsed).collect()) == [0]
    assert sorted(r.event_id for r in clean_features(parsed).collect()) == [0, 3]
