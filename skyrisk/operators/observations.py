"""Source observations and synthetic events.

* B9  ``explode_hourly``   struct of parallel arrays -> one row per time
* B10 ``build_event``      source variables -> event columns
* B11 ``inject_anomalies`` rule-based anomalies by global ordinal
* B12 ``synth_gauss``      Gaussian events with 5 % anomalies (load test)
* B13 ``synth_uniform``    uniform events from a rate-like stream
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyrisk.functions import randomness as R
from skyrisk.functions.timeparse import EVENT_TIME_FORMAT
from skyrisk.operators.ordinal import with_ordinal
from skyrisk.schemas import DEFAULT_CITY, EVENT_COLUMNS, HOURLY_TO_EVENT


# ---------------------------------------------------------------- B9, B10
def explode_hourly(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row per position of ``hourly.time``.  A variable whose array is
    shorter (or missing) gives null there; values past the end of ``time``
    are ignored (``posexplode`` + ``get``, not ``arrays_zip``, which would
    extend to the longest array)."""
    carry = carry if carry is not None else [c for c in docs.columns if c != "hourly"]
    rows = docs.select(*carry, "hourly", F.posexplode("hourly.time").alias("pos", "time"))
    return rows.select(*carry, "pos", "time",
                       *[F.get(F.col(f"hourly.{src}"), F.col("pos")).alias(src)
                         for src, _ in HOURLY_TO_EVENT])


def build_event(observations: DataFrame, city: str | Column | None = None) -> DataFrame:
    """Source variables renamed to event columns; the city is the given one,
    else the document's own ``city``, else the default."""
    if city is None:
        city_col = F.coalesce(F.col("city"), F.lit(DEFAULT_CITY)) \
            if "city" in observations.columns else F.lit(DEFAULT_CITY)
    else:
        city_col = F.lit(city) if isinstance(city, str) else city
    keep = [c for c in ("doc_id", "pos") if c in observations.columns]
    return observations.select(
        *keep, city_col.alias("city"), F.col("time").alias("timestamp"),
        *[F.col(src).alias(ev) for src, ev in HOURLY_TO_EVENT])


# ---------------------------------------------------------------- B11
# Anomaly period and injected value per measure.
ANOMALY_RULES = [
    ("temperature", 15, 36.5),
    ("precipitation", 25, 55.0),
    ("wind_speed", 40, 70.0),
]


def apply_anomalies(df: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Every 15th / 25th / 40th event (ordinal > 0) gets a high
    temperature / precipitation / wind; the rules are independent."""
    out = df
    for col, every, value in ANOMALY_RULES:
        hit = (F.col(ordinal) > 0) & (F.col(ordinal) % every == 0)
        out = out.withColumn(col, F.when(hit, F.lit(value)).otherwise(F.col(col)))
    return out


def inject_anomalies(df: DataFrame, order_key: str) -> DataFrame:
    """Anomalies by the event's global position in ``order_key`` order."""
    return apply_anomalies(with_ordinal(df, order_key))


# ---------------------------------------------------------------- B12
# Load-test distributions (mean, sd) and anomaly settings.
GAUSS = {
    "temperature": (22.0, 4.0), "humidity": (60.0, 15.0), "precipitation": (0.5, 1.5),
    "wind_speed": (12.0, 5.0), "gust_extra": (5.0, 3.0), "surface_pressure": (1015.0, 4.0),
    "apparent_delta": (0.0, 1.5),
}
WEATHER_CODES = [0, 1, 2, 3, 45, 61, 63, 80]
ANOMALY_PROB = 0.05
HEAT_RANGE, RAIN_RANGE, WIND_RANGE = (35.5, 42.0), (50.5, 90.0), (60.5, 95.0)
RAIN_CODE = 65


def synth_gauss(ids: DataFrame, id_col: str, start_ts: Column, rate_per_s: int = 5000,
                seed: int = 42, city: str = DEFAULT_CITY,
                anomaly_prob: float = ANOMALY_PROB) -> DataFrame:
    """One synthetic event per id.  Draws are keyed by (id, seed), so the
    output does not depend on partitioning; event time = start + id/rate s,
    cut to the minute."""
    d = R.with_uniforms(ids.select(id_col), id_col, seed, list(range(1, 15)) + [20, 21, 22, 23,
                                                                                 24, 25])

    def u(s):
        return F.col(f"__u{s}")

    def g(name, s1, s2):
        m, sd = GAUSS[name]
        return R.gaussian(u(s1), u(s2), m, sd)

    def span(s, lo, hi):
        return F.lit(lo) + u(s) * F.lit(hi - lo)

    temp = g("temperature", 1, 2)
    hum = F.greatest(F.lit(0.0), F.least(F.lit(100.0), g("humidity", 3, 4)))
    precip = F.greatest(F.lit(0.0), g("precipitation", 5, 6))
    wind = F.greatest(F.lit(0.0), g("wind_speed", 7, 8))
    gust = wind + F.greatest(F.lit(0.0), g("gust_extra", 9, 10))
    press = g("surface_pressure", 11, 12)
    app = temp + g("apparent_delta", 13, 14)
    code = R.choice(u(20), WEATHER_CODES)
    anomalous = u(21) < anomaly_prob
    kind = R.choice(u(22), ["heat", "rain", "wind"])
    heat, rain, windy = anomalous & (kind == "heat"), anomalous & (kind == "rain"), \
        anomalous & (kind == "wind")
    a_temp, a_rain, a_wind = span(23, *HEAT_RANGE), span(24, *RAIN_RANGE), span(25, *WIND_RANGE)
    k = F.col(id_col)
    ts = start_ts + F.make_interval(secs=(k.cast("double") / F.lit(float(rate_per_s))))
    base = d.select(
        k.alias(id_col),
        F.lit(city).alias("city"),
        F.date_format(ts, EVENT_TIME_FORMAT).alias("timestamp"),
        F.when(heat, a_temp).otherwise(temp).alias("temperature"),
        hum.alias("humidity"),
        F.when(rain, a_rain).otherwise(precip).alias("precipitation"),
        F.when(windy, a_wind).otherwise(wind).alias("wind_speed"),
        F.when(windy, a_wind + 10.0).otherwise(gust).alias("wind_gusts"),
        press.alias("surface_pressure"),
        F.when(heat, a_temp + 2.0).otherwise(app).alias("apparent_temperature"),
        F.when(rain, F.lit(RAIN_CODE)).otherwise(code).cast("int").alias("weather_code"),
    )
    measures = EVENT_COLUMNS[2:9]
    return base.select(id_col, *[F.round(c, 2).alias(c) if c in measures else F.col(c)
                                 for c in EVENT_COLUMNS])


# ---------------------------------------------------------------- B13
# Uniform events. Centre and width of ordinary measures, least value
# and span of anomalous ones, and the largest of the other draws.
UNIFORM = {"temperature": (22.0, 12.0), "humidity": (60.0, 50.0), "wind_speed": (12.0, 8.0),
           "surface_pressure": (1015.0, 8.0), "apparent_delta": (0.0, 3.0)}
UNIFORM_ANOMALY = {"temperature": (35.0, 7.0), "wind_speed": (60.0, 30.0), "precipitation": (50.0, 40.0)}
UNIFORM_RAIN, UNIFORM_GUST, UNIFORM_CODES = 3.0, 8.0, 65


def synth_uniform(rate: DataFrame, anomaly_prob: float = 0.05, seed: int = 7,
                  city: str = DEFAULT_CITY) -> DataFrame:
    """Rate rows (``timestamp``, ``value``) -> uniform synthetic events.

    One shared draw ``r1`` picks the anomaly band: heat below p, wind in
    (p, 2p), rain above 1-p; ``r2`` scales the anomaly.  Draws are keyed by
    ``value``, so a replayed micro-batch yields the same events.
    """
    d = R.with_uniforms(rate.select("timestamp", "value"), "value", seed, list(range(1, 11)))

    def u(s):
        return F.col(f"__u{s}")

    def usual(name, s):
        centre, width = UNIFORM[name]
        return centre + (u(s) - 0.5) * width

    def odd(name):
        least, span = UNIFORM_ANOMALY[name]
        return least + r2 * span

    r1, r2 = u(1), u(2)
    p = anomaly_prob
    temp = F.when(r1 < p, odd("temperature")).otherwise(usual("temperature", 3))
    wind = F.when((r1 > p) & (r1 < 2 * p), odd("wind_speed")).otherwise(usual("wind_speed", 5))
    return d.select(
        F.lit(city).alias("city"),
        F.col("timestamp"),
        temp.alias("temperature"),
        usual("humidity", 4).alias("humidity"),
        F.when(r1 > 1 - p, odd("precipitation")).otherwise(u(6) * UNIFORM_RAIN).alias("precipitation"),
        wind.alias("wind_speed"),
        (wind + u(7) * UNIFORM_GUST).alias("wind_gusts"),
        usual("surface_pressure", 8).alias("surface_pressure"),
        (temp + (u(9) - 0.5) * UNIFORM["apparent_delta"][1]).alias("apparent_temperature"),
        (u(10) * UNIFORM_CODES).cast("int").alias("weather_code"),
    )
