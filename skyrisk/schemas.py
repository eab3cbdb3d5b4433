"""Fixed schemas and column sets shared by all jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference's: wire event fields in order,
# the eight feature columns in vector order, and the six required columns.
EVENT_COLUMNS = [
    "city", "timestamp", "temperature", "humidity", "precipitation",
    "wind_speed", "wind_gusts", "surface_pressure", "apparent_temperature",
    "weather_code",
]
FEATURE_COLUMNS = [
    "temperature", "humidity", "precipitation", "wind_speed", "wind_gusts",
    "surface_pressure", "apparent_temperature", "weather_code",
]
REQUIRED_COLUMNS = [
    "city", "timestamp", "temperature", "humidity", "precipitation",
    "wind_speed",
]
# Source observation variables (hourly document arrays) and the event
# column each one becomes; fixed values.
HOURLY_TO_EVENT = [
    ("temperature_2m", "temperature"),
    ("relative_humidity_2m", "humidity"),
    ("precipitation", "precipitation"),
    ("wind_speed_10m", "wind_speed"),
    ("wind_gusts_10m", "wind_gusts"),
    ("surface_pressure", "surface_pressure"),
    ("apparent_temperature", "apparent_temperature"),
    ("weather_code", "weather_code"),
]
DEFAULT_CITY = "Mexico City"    # fixed value: default city name
# Risk classes: label value -> text; fixed values.
RISK_CLASSES = [(0, "normal"), (1, "moderate"), (2, "critical")]

EVENT_SCHEMA = T.StructType([
    T.StructField("city", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("temperature", T.DoubleType(), True),
    T.StructField("humidity", T.DoubleType(), True),
    T.StructField("precipitation", T.DoubleType(), True),
    T.StructField("wind_speed", T.DoubleType(), True),
    T.StructField("wind_gusts", T.DoubleType(), True),
    T.StructField("surface_pressure", T.DoubleType(), True),
    T.StructField("apparent_temperature", T.DoubleType(), True),
    T.StructField("weather_code", T.IntegerType(), True),
])

# Clean event (processed table): timestamp parsed.
PROCESSED_SCHEMA = T.StructType(
    [T.StructField("event_id", T.LongType(), True)]
    + [T.StructField(f.name, T.TimestampType() if f.name == "timestamp" else f.dataType, True)
       for f in EVENT_SCHEMA.fields])

AGGREGATE_COLUMNS = [
    "city", "window_start", "window_end", "avg_temperature",
    "max_temperature", "min_temperature", "avg_humidity",
    "total_precipitation", "max_wind_speed", "max_wind_gusts",
    "avg_surface_pressure", "avg_apparent_temperature", "event_count",
]
AGGREGATE_SCHEMA = T.StructType(
    [T.StructField("city", T.StringType(), True),
     T.StructField("window_start", T.TimestampType(), True),
     T.StructField("window_end", T.TimestampType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in AGGREGATE_COLUMNS[3:-1]]
    + [T.StructField("event_count", T.LongType(), False)])

PREDICTION_COLUMNS = EVENT_COLUMNS + ["prediction", "risk_prediction"]
# The columns that a list of predictions shows.
PREDICTION_VIEW = ["timestamp", "temperature", "precipitation", "wind_speed", "prediction",
                   "risk_prediction"]

PREDICTION_SCHEMA = T.StructType(
    PROCESSED_SCHEMA.fields + [T.StructField("prediction", T.DoubleType(), True),
                               T.StructField("risk_prediction", T.StringType(), True)])

METRIC_SCHEMA = T.StructType([
    T.StructField("metric", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
])

# Topic record: Kafka-shaped key/value strings.
TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])

# Hourly source document: struct of parallel arrays.
HOURLY_DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()), True)]
        + [T.StructField(src, T.ArrayType(
            T.IntegerType() if src == "weather_code" else T.DoubleType()), True)
           for src, _ in HOURLY_TO_EVENT]), True),
])

# Run-metric records (jobs / stages / executors JSON).
JOB_SCHEMA = T.StructType([
    T.StructField("jobId", T.LongType(), True),
    T.StructField("submissionTime", T.StringType(), True),
    T.StructField("completionTime", T.StringType(), True),
])
STAGE_SCHEMA = T.StructType([
    T.StructField("stageId", T.LongType(), True),
    T.StructField("shuffleReadBytes", T.LongType(), True),
    T.StructField("shuffleWriteBytes", T.LongType(), True),
    T.StructField("jvmGcTime", T.LongType(), True),
])
EXECUTOR_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("totalCores", T.IntegerType(), True),
    T.StructField("maxMemory", T.LongType(), True),
    T.StructField("completedTasks", T.LongType(), True),
    T.StructField("totalDuration", T.LongType(), True),
    T.StructField("totalGCTime", T.LongType(), True),
])
