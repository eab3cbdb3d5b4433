from skyrisk.schemas import (EVENT_COLUMNS, EVENT_SCHEMA, FEATURE_COLUMNS, REQUIRED_COLUMNS,
                             AGGREGATE_SCHEMA, AGGREGATE_COLUMNS)


def test_event_schema_has_ten_nullable_fields_in_order():
    assert EVENT_SCHEMA.fieldNames() == EVENT_COLUMNS
    assert len(EVENT_COLUMNS) == 10
    assert all(f.nullable for f in EVENT_SCHEMA.fields)
    types = {f.name: f.dataType.simpleString() for f in EVENT_SCHEMA.fields}
    assert types["timestamp"] == "string" and types["weather_code"] == "int"
    assert types["temperature"] == "double"


def test_features_are_event_minus_city_and_time_in_order():
    assert FEATURE_COLUMNS == [c for c in EVENT_COLUMNS if c not in ("city", "timestamp")]


def test_required_columns():
    assert REQUIRED_COLUMNS == ["city", "timestamp", "temperature", "humidity",
                                "precipitation", "wind_speed"]
    assert set(REQUIRED_COLUMNS) <= set(EVENT_COLUMNS)


def test_aggregate_columns():
    assert AGGREGATE_SCHEMA.fieldNames() == AGGREGATE_COLUMNS
    assert len(AGGREGATE_COLUMNS) == 13
