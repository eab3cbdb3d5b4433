"""DuckDB SQL twins of the catalogue entries.

Tables ``events`` etc. are views over the driver's parquet files.  The CTEs
restate the fixture derivation (``sources.fixture``) and each operator's
semantics in plain SQL, independently of the Spark code.
"""

from __future__ import annotations

EVENT_COLS = ["city", "timestamp", "temperature", "humidity", "precipitation",
              "wind_speed", "wind_gusts", "surface_pressure", "apparent_temperature",
              "weather_code"]
FEATURES = EVENT_COLS[2:]
DOUBLES = EVENT_COLS[2:9]
REQUIRED = EVENT_COLS[:6]

WEATHER = """weather AS (
  SELECT event_id,
         'city_' || CAST(user_id % 10 AS VARCHAR) AS city,
         strftime(ts, '%Y-%m-%dT%H:%M') AS timestamp,
         (event_id*37 % 300)/CAST(10.0 AS DOUBLE)+10 AS temperature,
         CASE WHEN event_type='error' AND event_id % 5 = 0 THEN NULL
              ELSE 20+K*CAST(0.8 AS DOUBLE) END AS humidity,
         value/CAST(4.0 AS DOUBLE) AS precipitation,
         CAST(user_id % 75 AS DOUBLE) AS wind_speed,
         CASE WHEN event_id % 17 = 0 THEN NULL
              ELSE CAST(user_id % 75 AS DOUBLE)+K/CAST(10.0 AS DOUBLE) END AS wind_gusts,
         1000+K/CAST(4.0 AS DOUBLE) AS surface_pressure,
         (event_id*37 % 300)/CAST(10.0 AS DOUBLE)+10+(K-50)/CAST(20.0 AS DOUBLE) AS apparent_temperature,
         CAST(K % 66 AS INTEGER) AS weather_code
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS K FROM events) e
)"""


def _parsed_cols() -> str:
    out = ["event_id"]
    for c in EVENT_COLS:
        v = "strptime(timestamp, '%Y-%m-%dT%H:%M')" if c == "timestamp" else c
        out.append(f"CASE WHEN event_id % 97 <> 0 THEN {v} END AS {c}")
    return ",\n         ".join(out)


PARSED = f"""parsed AS (
  SELECT {_parsed_cols()}
  FROM weather
)"""


def _not_null(cols: list[str]) -> str:
    conds = []
    for c in cols:
        conds.append(f"{c} IS NOT NULL")
        if c in DOUBLES:
            conds.append(f"NOT isnan({c})")
    return " AND ".join(conds)


CLEAN6 = f"""processed AS (
  SELECT event_id, {', '.join(EVENT_COLS)} FROM parsed WHERE {_not_null(REQUIRED)}
)"""
CLEAN10 = f"""strict AS (
  SELECT event_id, {', '.join(EVENT_COLS)} FROM parsed WHERE {_not_null(EVENT_COLS)}
)"""
CLEAN8 = f"""features AS (
  SELECT * FROM processed WHERE {_not_null(FEATURES)}
)"""
LABELLED = """labelled AS (
  SELECT *,
         CASE WHEN temperature > 35 OR wind_speed > 60 OR precipitation > 50 THEN 2
              WHEN (temperature BETWEEN 30 AND 35) OR (precipitation BETWEEN 20 AND 50)
                   OR (wind_speed BETWEEN 40 AND 60) THEN 1
              ELSE 0 END AS risk_label
  FROM features
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = with_(WEATHER, PARSED, CLEAN6)


def window_sql(unit: str, src: str = "processed") -> str:
    return f"""SELECT city,
       date_trunc('{unit}', timestamp) AS window_start,
       date_trunc('{unit}', timestamp) + INTERVAL 1 {unit} AS window_end,
       ROUND(avg(temperature), 6) AS avg_temperature,
       max(temperature) AS max_temperature,
       min(temperature) AS min_temperature,
       ROUND(avg(humidity), 6) AS avg_humidity,
       ROUND(sum(precipitation), 6) AS total_precipitation,
       max(wind_speed) AS max_wind_speed,
       max(wind_gusts) AS max_wind_gusts,
       ROUND(avg(surface_pressure), 6) AS avg_surface_pressure,
       ROUND(avg(apparent_temperature), 6) AS avg_apparent_temperature,
       count(*) AS event_count
FROM {src}
GROUP BY 1, 2, 3"""


AGG_1M = f"aggregates AS ({window_sql('minute')})"

ORACLE: dict[str, str] = {
    "parse_events": with_(WEATHER, PARSED) + "SELECT * FROM parsed",
    "parse_timestamp": """SELECT event_id,
       CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M')
                         WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                         WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M')
                         ELSE event_type END AS raw,
       CASE WHEN event_id % 4 = 0 THEN date_trunc('minute', ts) END AS parsed
FROM events""",
    "clean_required": BASE + "SELECT * FROM processed",
    "clean_strict": with_(WEATHER, PARSED, CLEAN10) + "SELECT * FROM strict",
    "clean_features": with_(WEATHER, PARSED, CLEAN6, CLEAN8) + "SELECT * FROM features",
    "risk_label": with_(WEATHER, PARSED, CLEAN6, CLEAN8, LABELLED) + """SELECT event_id,
       temperature, precipitation, wind_speed, risk_label,
       CASE risk_label WHEN 2 THEN 'critical' WHEN 1 THEN 'moderate' ELSE 'normal' END AS risk_level
FROM labelled""",
    "window_stats_1m": BASE + window_sql("minute"),
    "window_stats_1h": BASE + window_sql("hour"),
}


def oracle_sql() -> dict[str, str]:
    from skyrisk.plans import oracle_more  # noqa: F401
    return dict(ORACLE)
