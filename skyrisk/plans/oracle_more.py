"""SQL twins: serving queries, file sources and sinks."""

from __future__ import annotations

from skyrisk.plans.oracle import (AGG_1M, BASE, CLEAN6, CLEAN8, CLEAN10, DOUBLES, EVENT_COLS,
                                  FEATURES, LABELLED, ORACLE, PARSED, WEATHER, _not_null,
                                  window_sql, with_)

AGG_COLS = ["avg_temperature", "max_temperature", "min_temperature", "avg_humidity",
            "total_precipitation", "max_wind_speed", "max_wind_gusts", "avg_surface_pressure",
            "avg_apparent_temperature", "event_count"]

PRED = """pred AS (
  SELECT *,
         CAST(CASE WHEN temperature > 35 THEN 2.0 WHEN temperature >= 30 THEN 1.0 ELSE 0.0 END
              AS DOUBLE) AS prediction
  FROM strict
), predictions AS (
  SELECT *,
         CASE prediction WHEN 0.0 THEN 'normal' WHEN 1.0 THEN 'moderate'
                         WHEN 2.0 THEN 'critical' ELSE 'unknown' END AS risk_prediction,
         CASE WHEN temperature > 35 OR wind_speed > 60 OR precipitation > 50 THEN 2
              WHEN (temperature BETWEEN 30 AND 35) OR (precipitation BETWEEN 20 AND 50)
                   OR (wind_speed BETWEEN 40 AND 60) THEN 1
              ELSE 0 END AS risk_label
  FROM pred
)"""
PBASE = with_(WEATHER, PARSED, CLEAN10, PRED)
ABASE = with_(WEATHER, PARSED, CLEAN6, AGG_1M)

def _bucket(key: str) -> str:
    return f"CAST('0x' || substr(md5('42:' || CAST({key} AS VARCHAR)), 1, 4) AS INTEGER)"


KPI = """SELECT ROUND(avg(temperature), 6) AS avg_temperature,
       ROUND(avg(humidity), 6) AS avg_humidity,
       ROUND(sum(precipitation), 6) AS total_precipitation,
       max(wind_speed) AS max_wind_speed,
       count(*) AS total_events
FROM processed"""

CONF = """conf AS (
  SELECT CAST(risk_label AS DOUBLE) AS label, prediction, count(*) AS count
  FROM predictions GROUP BY 1, 2
)"""
METRICS = """metrics AS (
  WITH pl AS (SELECT label, sum(count) AS label_n,
                     sum(CASE WHEN label = prediction THEN count ELSE 0 END) AS tp
              FROM conf GROUP BY label),
       pp AS (SELECT prediction, sum(count) AS pred_n FROM conf GROUP BY prediction),
       c AS (SELECT label_n, tp,
                    CASE WHEN coalesce(pred_n, 0) > 0 THEN tp / pred_n ELSE 0.0 END AS p,
                    tp / label_n AS r
             FROM pl LEFT JOIN pp ON pl.label = pp.prediction),
       c2 AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1 FROM c)
  SELECT ROUND(sum(tp) / sum(label_n), 6) AS accuracy,
         ROUND(sum(p * label_n) / sum(label_n), 6) AS weightedPrecision,
         ROUND(sum(r * label_n) / sum(label_n), 6) AS weightedRecall,
         ROUND(sum(f1 * label_n) / sum(label_n), 6) AS f1
  FROM c2
)"""
METRIC_LONG = """SELECT 'accuracy' AS metric, CAST(accuracy AS DOUBLE) AS value FROM metrics
UNION ALL SELECT 'weightedPrecision', weightedPrecision FROM metrics
UNION ALL SELECT 'weightedRecall', weightedRecall FROM metrics
UNION ALL SELECT 'f1', f1 FROM metrics"""


def _top(n: int, cols: str = "*") -> str:
    return f"SELECT {cols} FROM aggregates ORDER BY window_start DESC, city DESC LIMIT {n}"


def _summary() -> str:
    parts = []
    for c in AGG_COLS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS "column", count(*) AS rows,
       ROUND(max(CASE WHEN rn = 1 THEN {x} END), 6) AS current,
       ROUND(max(CASE WHEN rn = n THEN {x} END), 6) AS oldest,
       ROUND(avg({x}), 6) AS avg, ROUND(min({x}), 6) AS min,
       ROUND(max({x}), 6) AS max, ROUND(stddev_samp({x}), 6) AS std
FROM top""")
    top = ("top AS (SELECT *, row_number() OVER (ORDER BY window_start DESC, city DESC) AS rn, "
           "count(*) OVER () AS n FROM (" + _top(1000) + ") t)")
    return with_(WEATHER, PARSED, CLEAN6, AGG_1M, top) + "\nUNION ALL\n".join(parts)


def _bi() -> str:
    names = [("AvgTemperature", "avg_temperature"), ("MaxTemperature", "max_temperature"),
             ("MinTemperature", "min_temperature"), ("AvgHumidity", "avg_humidity"),
             ("TotalPrecipitation", "total_precipitation"), ("MaxWindSpeed", "max_wind_speed"),
             ("MaxWindGusts", "max_wind_gusts"), ("AvgSurfacePressure", "avg_surface_pressure"),
             ("AvgApparentTemperature", "avg_apparent_temperature")]
    cols = ",\n       ".join(f"coalesce(CAST({s} AS DOUBLE), 0.0) AS {d}" for d, s in names)
    return ABASE + f"""SELECT strftime(window_start, '%Y-%m-%dT%H:%M:%S') AS WindowStart,
       strftime(window_end, '%Y-%m-%dT%H:%M:%S') AS WindowEnd,
       coalesce(city, 'Mexico City') AS City,
       {cols},
       CAST(coalesce(event_count, 0) AS INTEGER) AS EventCount
FROM aggregates"""


PARTS_OF = "CAST(right(city, 1) AS INTEGER)"

ORACLE.update({
    "kpi_summary": BASE + KPI,
    "risk_distribution": with_(WEATHER, PARSED, CLEAN6, CLEAN8, LABELLED) + """SELECT
       CASE risk_label WHEN 2 THEN 'critical' WHEN 1 THEN 'moderate' ELSE 'normal' END
         AS risk_level, count(*) AS count
FROM labelled GROUP BY 1""",
    "risk_distribution_processed": BASE + """SELECT
       CASE WHEN temperature > 35 OR wind_speed > 60 OR precipitation > 50 THEN 'critical'
            WHEN (temperature BETWEEN 30 AND 35) OR (precipitation BETWEEN 20 AND 50)
                 OR (wind_speed BETWEEN 40 AND 60) THEN 'moderate'
            ELSE 'normal' END AS risk_level,
       count(*) AS count
FROM processed GROUP BY 1""",
    "training_gates": with_(WEATHER, PARSED, CLEAN6) + f"""SELECT *,
       CASE WHEN total_rows = 0 THEN 'no_data' WHEN clean_rows < 20 THEN 'too_few_rows'
            WHEN train_rows = 0 OR test_rows = 0 THEN 'empty_split'
            WHEN n_classes < 2 THEN 'one_class' ELSE 'ok' END AS status,
       (CASE WHEN total_rows = 0 THEN 'no_data' WHEN clean_rows < 20 THEN 'too_few_rows'
            WHEN train_rows = 0 OR test_rows = 0 THEN 'empty_split'
            WHEN n_classes < 2 THEN 'one_class' ELSE 'ok' END) IN ('ok', 'one_class') AS can_train
FROM (
  SELECT count(*) AS total_rows,
         count(*) FILTER (WHERE clean) AS clean_rows,
         CAST(count(DISTINCT CASE WHEN clean THEN lbl END) AS INTEGER) AS n_classes,
         count(*) FILTER (WHERE clean AND h < 52428) AS train_rows,
         count(*) FILTER (WHERE clean AND h >= 52428) AS test_rows
  FROM (SELECT ({_not_null(FEATURES)}) AS clean,
               {_bucket('event_id')} AS h,
               CASE WHEN temperature > 35 OR wind_speed > 60 OR precipitation > 50 THEN 2
                    WHEN (temperature BETWEEN 30 AND 35) OR (precipitation BETWEEN 20 AND 50)
                         OR (wind_speed BETWEEN 40 AND 60) THEN 1 ELSE 0 END AS lbl
        FROM processed) x
) g""",
    "split_by_key": with_(WEATHER, PARSED, CLEAN6, CLEAN8) + f"""SELECT event_id,
       CASE WHEN {_bucket('event_id')} < 52428 THEN 'train' ELSE 'test' END AS split
FROM features""",
    "split_sparse_keys": with_(WEATHER, PARSED, CLEAN6, CLEAN8) + f"""SELECT event_id * 65536 AS event_id,
       CASE WHEN {_bucket('event_id * 65536')} < 52428 THEN 'train' ELSE 'test' END AS split
FROM features""",
    "prediction_text": PBASE + "SELECT event_id, prediction, risk_prediction FROM predictions",
    "prediction_distribution": PBASE + """SELECT c.risk_prediction, coalesce(n, 0) AS count
FROM (VALUES (0, 'normal'), (1, 'moderate'), (2, 'critical')) c(o, risk_prediction)
LEFT JOIN (SELECT risk_prediction, count(*) AS n FROM predictions GROUP BY 1) p
  USING (risk_prediction)""",
    "confusion_matrix": with_(WEATHER, PARSED, CLEAN10, PRED, CONF) + "SELECT * FROM conf",
    "eval_metrics": with_(WEATHER, PARSED, CLEAN10, PRED, CONF, METRICS) + "SELECT * FROM metrics",
    "summary_stats": _summary(),
    "alert_flag": with_(WEATHER, PARSED, CLEAN6, CLEAN10, PRED) + """SELECT d AS critical_in_data,
       p AS critical_in_pred, d OR p AS alert
FROM (SELECT coalesce(bool_or(temperature > 35 OR wind_speed > 60 OR precipitation > 50), false) AS d
      FROM (SELECT * FROM processed ORDER BY timestamp DESC, event_id DESC LIMIT 50)) a,
     (SELECT coalesce(bool_or(risk_prediction = 'critical'), false) AS p
      FROM (SELECT * FROM predictions ORDER BY timestamp DESC, event_id DESC LIMIT 50)) b""",
    "latest_windows": ABASE + _top(10),
    "all_windows": ABASE + _top(1000),
    "timeseries_tail": BASE + """SELECT event_id, timestamp, temperature, humidity, precipitation,
       wind_speed
FROM processed WHERE timestamp IS NOT NULL
ORDER BY timestamp DESC, event_id DESC LIMIT 500""",
    "window_tail": ABASE + """SELECT city, window_start, avg_temperature, total_precipitation,
       max_wind_speed
FROM aggregates ORDER BY window_start DESC, city DESC LIMIT 500""",
    "latest_predictions": PBASE + """SELECT event_id, timestamp, temperature, precipitation,
       wind_speed, prediction, risk_prediction
FROM predictions WHERE timestamp IS NOT NULL
ORDER BY timestamp DESC, event_id DESC LIMIT 20""",
    "latest_row": ABASE + _top(1),
    "latest_per_city": ABASE + """SELECT * FROM aggregates
QUALIFY row_number() OVER (PARTITION BY city ORDER BY window_start DESC) = 1""",
    "bi_rows": _bi(),
    "dataset_status": with_(WEATHER, PARSED, CLEAN6, CLEAN10, PRED, AGG_1M) + """SELECT dataset, rows,
       rows > 0 AS has_data
FROM (SELECT 'processed' AS dataset, count(*) AS rows FROM processed
      UNION ALL SELECT 'aggregates', count(*) FROM aggregates
      UNION ALL SELECT 'predictions', count(*) FROM predictions
      UNION ALL SELECT 'metrics', 4) s""",
    "scan_processed": BASE + "SELECT * FROM processed",
    "scan_metrics_csv": BASE + """SELECT * FROM (UNPIVOT (SELECT CAST(avg_temperature AS DOUBLE)
       AS avg_temperature, CAST(avg_humidity AS DOUBLE) AS avg_humidity,
       CAST(total_precipitation AS DOUBLE) AS total_precipitation,
       CAST(max_wind_speed AS DOUBLE) AS max_wind_speed,
       CAST(total_events AS DOUBLE) AS total_events FROM (""" + KPI + """))
  ON COLUMNS(*) INTO NAME metric VALUE value)""",
    "sink_metrics_csv": with_(WEATHER, PARSED, CLEAN10, PRED, CONF, METRICS) + METRIC_LONG,
    "export_csv": ABASE + "SELECT * FROM aggregates",
    "export_json": ABASE + f"""SELECT city, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, {', '.join(AGG_COLS)}
FROM ({_top(10)}) t""",
    "union_parts": ABASE + "SELECT * FROM aggregates",
    "scan_recent_files": ABASE + f"SELECT * FROM aggregates WHERE {PARTS_OF} BETWEEN 4 AND 9",
})

# ---------------------------------------------------------------- streams
CLOSED = "window_end <= (SELECT max(timestamp) FROM processed) - INTERVAL 2 MINUTE"


def _slice(ts: str, n: int) -> str:
    cases = " ".join(f"WHEN epoch_us({ts}) < lo + (hi - lo) * {k} // {n} THEN {k - 1}"
                     for k in range(1, n))
    return f"CASE {cases} ELSE {n - 1} END"


BOUNDS = "bounds AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events)"

LATE = with_(WEATHER, PARSED, CLEAN6, BOUNDS) + f""", tagged AS (
  SELECT p.*, {_slice('e.ts', 3)} AS slice
  FROM processed p JOIN events e USING (event_id), bounds
), first_row AS (
  SELECT * FROM tagged ORDER BY timestamp, event_id LIMIT 1
), m0 AS (
  SELECT max(timestamp) AS m0 FROM tagged WHERE slice = 0
), rows AS (
  SELECT * FROM tagged
  UNION ALL SELECT * FROM first_row
  UNION ALL SELECT f.* FROM first_row f, m0
            WHERE date_trunc('minute', f.timestamp) + INTERVAL 1 MINUTE > m0 - INTERVAL 2 MINUTE
), aggregates AS ({window_sql('minute', 'rows')})
SELECT * FROM aggregates
WHERE window_end <= (SELECT max(timestamp) FROM rows) - INTERVAL 2 MINUTE"""

BI_CHANGED = with_(WEATHER, PARSED, CLEAN6, AGG_1M, BOUNDS) + f""", sl AS (
  SELECT a.*, {_slice('a.window_start', 3)} AS batch FROM aggregates a, bounds
), newest AS (
  SELECT * FROM sl QUALIFY row_number() OVER (PARTITION BY batch, city
                                              ORDER BY window_start DESC) = 1
), pushed AS (
  SELECT n.* FROM newest n
  WHERE n.window_start > coalesce((SELECT max(o.window_start) FROM newest o
                                   WHERE o.city = n.city AND o.batch < n.batch),
                                  TIMESTAMP '0001-01-01')
)
SELECT strftime(window_start, '%Y-%m-%dT%H:%M:%S') AS WindowStart,
       strftime(window_end, '%Y-%m-%dT%H:%M:%S') AS WindowEnd,
       coalesce(city, 'Mexico City') AS City,
       coalesce(avg_temperature, 0.0) AS AvgTemperature,
       coalesce(max_temperature, 0.0) AS MaxTemperature,
       coalesce(min_temperature, 0.0) AS MinTemperature,
       coalesce(avg_humidity, 0.0) AS AvgHumidity,
       coalesce(total_precipitation, 0.0) AS TotalPrecipitation,
       coalesce(max_wind_speed, 0.0) AS MaxWindSpeed,
       coalesce(max_wind_gusts, 0.0) AS MaxWindGusts,
       coalesce(avg_surface_pressure, 0.0) AS AvgSurfacePressure,
       coalesce(avg_apparent_temperature, 0.0) AS AvgApparentTemperature,
       CAST(event_count AS INTEGER) AS EventCount,
       CAST(batch AS BIGINT) AS batch
FROM pushed"""

ORACLE.update({
    "src_topic_stream": with_(WEATHER) + """SELECT event_id,
       CASE WHEN event_id % 97 = 0 THEN NULL
            ELSE 10 - CAST(humidity IS NULL AS INTEGER) - CAST(wind_gusts IS NULL AS INTEGER)
       END AS n_keys,
       '}' AS last_char
FROM weather""",
    "src_topic_latest": with_(WEATHER, BOUNDS) + f"""SELECT w.event_id,
       CASE WHEN w.event_id % 97 = 0 THEN NULL
            ELSE 10 - CAST(w.humidity IS NULL AS INTEGER) - CAST(w.wind_gusts IS NULL AS INTEGER)
       END AS n_keys,
       '}}' AS last_char
FROM weather w JOIN events e ON e.event_id = w.event_id, bounds WHERE {_slice('e.ts', 3)} > 0""",
    "sink_topic_json": with_(WEATHER) + """SELECT event_id, city,
       strptime(timestamp, '%Y-%m-%dT%H:%M') AS timestamp, temperature, humidity,
       precipitation, wind_speed, wind_gusts, surface_pressure, apparent_temperature,
       weather_code
FROM weather""",
    "stream_clean": BASE + "SELECT * FROM processed",
    "stream_window_append": ABASE + f"SELECT * FROM aggregates WHERE {CLOSED}",
    "stream_window_complete": ABASE + "SELECT * FROM aggregates",
    "stream_fanout": ABASE + f"""SELECT 'processed' AS sink, count(*) AS rows FROM processed
UNION ALL SELECT 'aggregates', count(*) FROM aggregates WHERE {CLOSED}""",
    "stream_restart": ABASE + f"SELECT * FROM aggregates WHERE {CLOSED}",
    "stream_late_drop": LATE,
    "bi_changed_rows": BI_CHANGED,
})

# ---------------------------------------------------------------- observations, runs
HOURLY = with_(WEATHER) + """, hourly AS (
  SELECT city || '-' || CAST(event_id // 1680 AS VARCHAR) AS doc_id, city,
         CAST(row_number() OVER (PARTITION BY city, event_id // 1680 ORDER BY event_id) - 1
              AS INTEGER) AS pos,
         count(*) OVER (PARTITION BY city, event_id // 1680) AS n_hours,
         timestamp AS time, temperature AS temperature_2m,
         humidity AS relative_humidity_2m, precipitation, CAST(NULL AS DOUBLE) AS wind_speed_10m,
         wind_gusts AS wind_gusts_10m, surface_pressure, apparent_temperature, weather_code
  FROM weather
), hourly_cut AS (
  SELECT * EXCLUDE (n_hours)
         REPLACE (CASE WHEN pos < n_hours - 1 THEN precipitation END AS precipitation) FROM hourly
)
"""

ORACLE.update({
    "explode_hourly": HOURLY + "SELECT * FROM hourly_cut",
    "build_event": HOURLY + """SELECT doc_id, pos, city, time AS timestamp,
       temperature_2m AS temperature, relative_humidity_2m AS humidity, precipitation,
       wind_speed_10m AS wind_speed, wind_gusts_10m AS wind_gusts, surface_pressure,
       apparent_temperature, weather_code
FROM hourly_cut""",
    "inject_anomalies": with_(WEATHER) + """SELECT event_id,
       CASE WHEN o > 0 AND o % 15 = 0 THEN 36.5 ELSE temperature END AS temperature,
       CASE WHEN o > 0 AND o % 25 = 0 THEN 55.0 ELSE precipitation END AS precipitation,
       CASE WHEN o > 0 AND o % 40 = 0 THEN 70.0 ELSE wind_speed END AS wind_speed,
       o AS ordinal
FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS o FROM weather) w""",
    "run_job_stats": """SELECT count(*) AS jobs, ROUND(avg(d), 6) AS avg_s, min(d) AS min_s,
       max(d) AS max_s
FROM (SELECT CASE WHEN event_id % 50 = 0 THEN NULL
                  ELSE CAST(user_id % 40 AS DOUBLE) END AS d FROM events) j
WHERE d IS NOT NULL""",
    "run_stage_stats": """SELECT CAST(sum(CASE WHEN event_id % 11 = 0 THEN 0
                    ELSE event_id * 13 % 5000 END) AS BIGINT) AS shuffle_read_bytes,
       CAST(sum(event_id * 17 % 5000) AS BIGINT) AS shuffle_write_bytes,
       CAST(sum(user_id % 30) AS BIGINT) AS gc_ms
FROM events""",
    "run_executor_stats": """SELECT CAST(user_id % 8 AS VARCHAR) AS id, 2 AS cores,
       455501414 / 1e6 AS memory_mb, count(*) AS tasks,
       sum(user_id) / 1000.0 AS run_s, sum(user_id % 30) / 1000.0 AS gc_s
FROM events GROUP BY user_id % 8""",
    "assemble_features": with_(WEATHER, PARSED, CLEAN6, CLEAN8) + """SELECT event_id,
       temperature AS f0_temperature, humidity AS f1_humidity,
       precipitation AS f2_precipitation, wind_speed AS f3_wind_speed,
       wind_gusts AS f4_wind_gusts, surface_pressure AS f5_surface_pressure,
       apparent_temperature AS f6_apparent_temperature,
       CAST(weather_code AS DOUBLE) AS f7_weather_code
FROM features""",
})


# ---------------------------------------------------------------- generators
M31, MIX31 = 2147483647, 73244475


def _stream_const(seed: int, stream: int) -> int:
    return (seed * 1640531527 + stream * 1013904223) & M31


def _uniform_ctes(src: str, key: str, carry: list[str], seed: int, streams: list[int]) -> str:
    """CTEs h0..h3 and ``uni``: uniforms u{s} in [0, 1) keyed by ``key``."""
    keep = ", ".join(carry)
    c0 = ", ".join(f"xor({key} & {M31}, {_stream_const(seed, s)}) AS u{s}" for s in streams)
    rnd = ", ".join(f"(xor(u{s}, u{s} >> 16) * {MIX31}) & {M31} AS u{s}" for s in streams)
    half = ", ".join(f"xor((xor(u{s}, u{s} >> 16) * {MIX31}) & {M31}, ({key} >> 31) & {M31}) AS u{s}"
                     for s in streams)
    fin = ", ".join(f"CAST(xor(u{s}, u{s} >> 16) AS DOUBLE) / 2147483648.0 AS u{s}"
                    for s in streams)
    return (f"h0 AS (SELECT {keep}, {c0} FROM {src}),\n"
            f"h1 AS (SELECT {keep}, {half} FROM h0),\n"
            f"h2 AS (SELECT {keep}, {rnd} FROM h1),\n"
            f"h3 AS (SELECT {keep}, {rnd} FROM h2),\n"
            f"uni AS (SELECT {keep}, {fin} FROM h3)")


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _g(mean: float, sd: float, a: int, b: int) -> str:
    z = f"(sqrt({_d(-2.0)} * ln({_d(1.0)} - u{a})) * cos({_d(6.283185307179586)} * u{b}))"
    return f"({_d(mean)} + {_d(sd)} * {z})"


_GAUSS_STREAMS = list(range(1, 15)) + [20, 21, 22, 23, 24, 25]
SYNTH_GAUSS = "WITH ids AS (SELECT event_id FROM events),\n" + _uniform_ctes(
    "ids", "event_id", ["event_id"], 42, _GAUSS_STREAMS) + f""",
t AS (SELECT min(ts) AS t0 FROM events),
parts AS (
  SELECT event_id,
         {_g(22.0, 4.0, 1, 2)} AS temp,
         greatest({_d(0.0)}, least({_d(100.0)}, {_g(60.0, 15.0, 3, 4)})) AS hum,
         greatest({_d(0.0)}, {_g(0.5, 1.5, 5, 6)}) AS precip,
         greatest({_d(0.0)}, {_g(12.0, 5.0, 7, 8)}) AS wind,
         greatest({_d(0.0)}, {_g(5.0, 3.0, 9, 10)}) AS gust_extra,
         {_g(1015.0, 4.0, 11, 12)} AS press,
         {_g(0.0, 1.5, 13, 14)} AS app_delta,
         [0, 1, 2, 3, 45, 61, 63, 80][CAST(floor(u20 * 8) AS INTEGER) + 1] AS code,
         u21 < {_d(0.05)} AS anomalous,
         ['heat', 'rain', 'wind'][CAST(floor(u22 * 3) AS INTEGER) + 1] AS kind,
         {_d(35.5)} + u23 * {_d(6.5)} AS a_temp,
         {_d(50.5)} + u24 * {_d(39.5)} AS a_rain,
         {_d(60.5)} + u25 * {_d(34.5)} AS a_wind
  FROM uni
), flags AS (
  SELECT *, anomalous AND kind = 'heat' AS heat, anomalous AND kind = 'rain' AS rain,
         anomalous AND kind = 'wind' AS windy
  FROM parts
)
SELECT event_id, 'Mexico City' AS city,
       strftime(t0 + to_microseconds(event_id * 200), '%Y-%m-%dT%H:%M') AS timestamp,
       round(CASE WHEN heat THEN a_temp ELSE temp END, 2) AS temperature,
       round(hum, 2) AS humidity,
       round(CASE WHEN rain THEN a_rain ELSE precip END, 2) AS precipitation,
       round(CASE WHEN windy THEN a_wind ELSE wind END, 2) AS wind_speed,
       round(CASE WHEN windy THEN a_wind + {_d(10.0)} ELSE wind + gust_extra END, 2) AS wind_gusts,
       round(press, 2) AS surface_pressure,
       round(CASE WHEN heat THEN a_temp + {_d(2.0)} ELSE temp + app_delta END, 2)
         AS apparent_temperature,
       CAST(CASE WHEN rain THEN 65 ELSE code END AS INTEGER) AS weather_code
FROM flags, t"""

SYNTH_UNIFORM = "WITH rate AS (SELECT ts AS timestamp, event_id AS value FROM events),\n" + \
    _uniform_ctes("rate", "value", ["timestamp", "value"], 7, list(range(1, 11))) + f""",
parts AS (
  SELECT timestamp,
         CASE WHEN u1 < {_d(0.05)} THEN {_d(35.0)} + u2 * {_d(7.0)}
              ELSE {_d(22.0)} + (u3 - {_d(0.5)}) * {_d(12.0)} END AS temp,
         CASE WHEN u1 > {_d(0.05)} AND u1 < {_d(0.1)} THEN {_d(60.0)} + u2 * {_d(30.0)}
              ELSE {_d(12.0)} + (u5 - {_d(0.5)}) * {_d(8.0)} END AS wind,
         u1, u2, u4, u6, u7, u8, u9, u10
  FROM uni
)
SELECT 'Mexico City' AS city, timestamp, temp AS temperature,
       {_d(60.0)} + (u4 - {_d(0.5)}) * {_d(50.0)} AS humidity,
       CASE WHEN u1 > {_d(0.95)} THEN {_d(50.0)} + u2 * {_d(40.0)} ELSE u6 * {_d(3.0)} END
         AS precipitation,
       wind AS wind_speed,
       wind + u7 * {_d(8.0)} AS wind_gusts,
       {_d(1015.0)} + (u8 - {_d(0.5)}) * {_d(8.0)} AS surface_pressure,
       temp + (u9 - {_d(0.5)}) * {_d(3.0)} AS apparent_temperature,
       CAST(trunc(u10 * 65) AS INTEGER) AS weather_code
FROM parts"""

ORACLE.update({"synth_gauss": SYNTH_GAUSS, "synth_uniform_stream": SYNTH_UNIFORM})


# ---------------------------------------------------------------- keyless records
def _hash_text(c: str) -> str:
    if c == "timestamp":
        v = "epoch_us(timestamp)"
    elif c in DOUBLES:
        v = f"CAST(floor({c} * CAST(1e6 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT)"
    else:
        v = c
    return f"coalesce(CAST({v} AS VARCHAR), '')"


EVENT_HASH = "CAST('0x' || substr(md5(concat_ws('|', " + ", ".join(map(_hash_text, EVENT_COLS)) + ")), 1, 15) AS BIGINT)"
BUCKET = _bucket('h')
STATUS = """CASE WHEN total_rows = 0 THEN 'no_data' WHEN clean_rows < 20 THEN 'too_few_rows'
            WHEN train_rows = 0 OR test_rows = 0 THEN 'empty_split'
            WHEN n_classes < 2 THEN 'one_class' ELSE 'ok' END"""
LABEL = """CASE WHEN temperature > 35 OR wind_speed > 60 OR precipitation > 50 THEN 2
              WHEN (temperature BETWEEN 30 AND 35) OR (precipitation BETWEEN 20 AND 50)
                   OR (wind_speed BETWEEN 40 AND 60) THEN 1 ELSE 0 END"""
SPLIT = _bucket('event_id') + " < 52428"
TEST_ROWS = with_(WEATHER, PARSED, CLEAN6, CLEAN8, LABELLED) + f""", test AS (
  SELECT * FROM labelled WHERE NOT ({SPLIT})
)
"""
SLICES = with_(WEATHER, BOUNDS) + f""", s AS (
  SELECT {_slice('ts', 3)} AS slice, count(*) AS n FROM events, bounds GROUP BY 1
), q AS (SELECT unnest(['processed', 'aggregates']) AS name)
"""
LOG_TIME = "strftime({}, '%Y-%m-%dT%H:%M:%S.%g') || 'GMT'"

ORACLE.update({
    "split_keyless": with_(WEATHER, PARSED, CLEAN6, CLEAN8) + f"""SELECT {', '.join(EVENT_COLS)},
       CASE WHEN {BUCKET} < 52428 THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, {EVENT_HASH} AS h FROM features) x""",
    "training_gates_keyless": with_(WEATHER, PARSED, CLEAN6) + f"""SELECT *, {STATUS} AS status,
       ({STATUS}) IN ('ok', 'one_class') AS can_train
FROM (
  SELECT count(*) AS total_rows,
         count(*) FILTER (WHERE clean) AS clean_rows,
         CAST(count(DISTINCT CASE WHEN clean THEN lbl END) AS INTEGER) AS n_classes,
         count(*) FILTER (WHERE clean AND {BUCKET} < 52428) AS train_rows,
         count(*) FILTER (WHERE clean AND {BUCKET} >= 52428) AS test_rows
  FROM (SELECT ({_not_null(FEATURES)}) AS clean, {EVENT_HASH} AS h, {LABEL} AS lbl
        FROM processed) x
) g""",
    "build_event_default_city": HOURLY + """SELECT pos, 'Mexico City' AS city, time AS timestamp,
       temperature_2m AS temperature, relative_humidity_2m AS humidity, precipitation,
       wind_speed_10m AS wind_speed, wind_gusts_10m AS wind_gusts, surface_pressure,
       apparent_temperature, weather_code
FROM hourly_cut""",
    "ordinal_by_hour": """SELECT event_id, date_trunc('hour', ts) AS hour,
       row_number() OVER (ORDER BY date_trunc('hour', ts), event_id) - 1 AS ordinal
FROM events""",
    "latest_windows_dated": ABASE + _top(10),
    "timeseries_tail_dated": ORACLE["timeseries_tail"],
    "event_log_jobs": f"""SELECT CAST(event_id % 2 AS INTEGER) AS app, event_id // 2 AS jobId,
       {LOG_TIME.format('ts')} AS submissionTime,
       CASE WHEN event_id % 50 <> 0 THEN {LOG_TIME.format('ts + to_seconds(user_id % 40)')} END AS completionTime
FROM events""",
    "event_log_stages": """SELECT CAST(event_id % 2 AS INTEGER) AS app, event_id // 2 AS stageId,
       event_id * 13 % 5000 AS shuffleReadBytes, event_id * 17 % 5000 AS shuffleWriteBytes,
       user_id % 30 AS jvmGcTime
FROM events""",
    "ml_train_check": TEST_ROWS + """SELECT CAST(sum(n) AS BIGINT) AS test_rows, max(n) AS largest_class, true AS better
FROM (SELECT risk_label, count(*) AS n FROM test GROUP BY 1) c""",
    "ml_score_sample_rows": TEST_ROWS + f"""SELECT event_id, {', '.join(EVENT_COLS)}, true AS scored
FROM test ORDER BY event_id LIMIT 10""",
    "ml_roundtrip_equal": TEST_ROWS + "SELECT event_id, true AS equal FROM test",
    "ml_score_stream_rows": with_(WEATHER, PARSED, CLEAN10) + f"""SELECT event_id, {', '.join(EVENT_COLS)},
       true AS scored
FROM strict""",
    "progress_counts": SLICES + """SELECT name, CAST(slice AS BIGINT) AS batchId, n AS numInputRows,
       CAST(0 AS BIGINT) AS dropped
FROM q, s""",
    "throughput_counts": SLICES + """SELECT name, CAST(sum(n) AS BIGINT) AS sent, count(*) AS batches
FROM q, s GROUP BY name""",
})

# ---------------------------------------------------------------- runs over time
BEHIND = with_(WEATHER, PARSED, CLEAN6, BOUNDS) + f"""SELECT city, count(*) AS events_behind, min(timestamp) AS oldest, max(timestamp) AS newest
FROM processed p JOIN events e USING (event_id), bounds WHERE {_slice('e.ts', 3)} = 2 GROUP BY city"""

WALL = """WITH b AS (
  SELECT 'run-' || CAST(user_id % 5 AS VARCHAR) AS runId, CASE WHEN event_id % 2 = 0 THEN 'processed' ELSE 'aggregates' END AS name,
         user_id AS sent, epoch_us(ts) // 1000 AS f, epoch_us(ts) // 1000 + event_id * 7919 % 9000000 AS t, event_id AS id FROM events
), m AS (
  SELECT *, max(t) OVER (PARTITION BY runId, name ORDER BY f, t, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM b
), i AS (
  SELECT *, sum(CASE WHEN far IS NULL OR f > far THEN 1 ELSE 0 END) OVER (PARTITION BY runId, name ORDER BY f, t, id) AS island FROM m
), u AS (
  SELECT runId, name, island, sum(sent) AS sent, count(*) AS n, min(f) AS f, max(t) AS t FROM i GROUP BY ALL
)
SELECT runId, name, CAST(sum(sent) AS BIGINT) AS sent, CAST(sum(n) AS BIGINT) AS batches, count(*) - 1 AS pauses,
       (max(t) - min(f)) / 1000.0 AS wall_s, CAST(sum(t - f) AS BIGINT) / 1000.0 AS busy_s,
       ROUND(CAST(sum(sent) AS BIGINT) / greatest((max(t) - min(f)) / 1000.0, 1e-6), 6) AS rate_ev_s
FROM u GROUP BY runId, name"""

ENDS = """count(*) FILTER (WHERE event_id % 11 <> 0 AND event_id % 13 <> 0) AS {0}, count(*) FILTER (WHERE event_id % 11 = 0) AS {1},
       count(*) FILTER (WHERE event_id % 11 <> 0 AND event_id % 13 = 0) AS {2}""".format("{}", "failedTasks", "killedTasks")

ORACLE.update({
    "ordinal_over_runs": HOURLY + """, numbered AS (
  SELECT *, row_number() OVER (ORDER BY CAST(split_part(doc_id, '-', 2) AS INTEGER) % 2, time, doc_id, pos) - 1 AS o FROM hourly_cut
)
SELECT o AS event_id, city, strptime(time, '%Y-%m-%dT%H:%M') AS timestamp,
       CASE WHEN o > 0 AND o % 15 = 0 THEN 36.5 ELSE temperature_2m END AS temperature, relative_humidity_2m AS humidity,
       CASE WHEN o > 0 AND o % 25 = 0 THEN 55.0 ELSE precipitation END AS precipitation,
       CASE WHEN o > 0 AND o % 40 = 0 THEN 70.0 ELSE wind_speed_10m END AS wind_speed,
       wind_gusts_10m AS wind_gusts, surface_pressure, apparent_temperature, weather_code
FROM numbered""",
    "topic_backlog": BEHIND,
    "latest_windows_zoned": ABASE + _top(10),
    "timeseries_tail_zoned": ORACLE["timeseries_tail"],
    "latest_predictions_zoned": ORACLE["latest_predictions"],
    "alert_flag_zoned": ORACLE["alert_flag"],
    "throughput_wall": WALL,
    "event_log_executors": f"""SELECT CAST(event_id % 2 AS INTEGER) AS app, CAST(user_id % 8 AS VARCHAR) AS id, 2 AS cores, 455501414 / 1e6 AS memory_mb,
       {ENDS.format('tasks')},
       sum(user_id) / 1000.0 AS run_s, sum(CASE WHEN event_id % 13 = 0 THEN 0 ELSE user_id % 30 END) / 1000.0 AS gc_s,
       min(epoch_us(ts) // 1000) AS addedMs, CASE WHEN user_id % 8 % 3 = 0 THEN max(epoch_us(ts) // 1000) END AS removedMs
FROM events GROUP BY event_id % 2, user_id % 8""",
    "event_log_attempts": f"""SELECT CAST(event_id % 2 AS INTEGER) AS app, event_id % 100 AS stageId, CAST(event_id % 3 AS INTEGER) AS attempt,
       {ENDS.format('completedTasks')},
       CAST(sum(CASE WHEN event_id % 13 = 0 THEN 0 ELSE user_id * 2 END) AS BIGINT) AS executorRunMs, min(epoch_us(ts) // 1000) AS firstLaunchMs,
       max(epoch_us(ts) // 1000 + user_id) AS lastFinishMs
FROM events GROUP BY event_id % 2, event_id % 100, event_id % 3""",
    "ml_score_classes": TEST_ROWS + """SELECT risk_label, count(*) AS rows, true AS apart
FROM test GROUP BY risk_label""",
    "stream_window_update": ABASE + "SELECT * FROM aggregates",
    "stream_open_windows": BASE + f"""SELECT * FROM ({window_sql('hour')}) w
WHERE window_end > (SELECT max(timestamp) FROM processed) - INTERVAL 1 DAY""",
    "union_parts_skipped": ABASE + """SELECT 'corrupt' AS status, CAST(1 AS BIGINT) AS files, CAST(0 AS BIGINT) AS rows
UNION ALL SELECT 'empty', 1, 0 UNION ALL SELECT 'read', NULL, count(*) FROM aggregates""",
    "dataset_status_landed": with_(WEATHER, PARSED, CLEAN6, CLEAN10, PRED, AGG_1M) + """SELECT dataset, n AS rows, n > 0 AS has_data FROM (
  SELECT 'processed' AS dataset, count(*) AS n FROM processed UNION ALL SELECT 'aggregates', count(*) FROM aggregates
  UNION ALL SELECT 'predictions', count(*) FROM predictions UNION ALL SELECT 'nothing', 0) d""",
})
