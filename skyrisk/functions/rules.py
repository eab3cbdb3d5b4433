"""Risk rules as JVM-side column expressions (stay inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyrisk.schemas import RISK_CLASSES

# Thresholds of the risk rule (°C, mm, km/h).
CRITICAL_TEMPERATURE = 35.0
CRITICAL_PRECIPITATION = 50.0
CRITICAL_WIND = 60.0
MODERATE_TEMPERATURE = (30.0, 35.0)
MODERATE_PRECIPITATION = (20.0, 50.0)
MODERATE_WIND = (40.0, 60.0)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_critical(temperature="temperature", precipitation="precipitation",
                wind_speed="wind_speed") -> Column:
    """Strictly above any critical threshold (null compares as not true)."""
    return ((_c(temperature) > CRITICAL_TEMPERATURE)
            | (_c(wind_speed) > CRITICAL_WIND)
            | (_c(precipitation) > CRITICAL_PRECIPITATION))


def is_moderate(temperature="temperature", precipitation="precipitation",
                wind_speed="wind_speed") -> Column:
    """Inside any moderate band, both bounds included."""
    t, p, w = _c(temperature), _c(precipitation), _c(wind_speed)
    return (t.between(*MODERATE_TEMPERATURE)
            | p.between(*MODERATE_PRECIPITATION)
            | w.between(*MODERATE_WIND))


def risk_label(temperature="temperature", precipitation="precipitation",
               wind_speed="wind_speed") -> Column:
    """0 normal, 1 moderate, 2 critical; critical wins."""
    return (F.when(is_critical(temperature, precipitation, wind_speed), F.lit(2))
            .when(is_moderate(temperature, precipitation, wind_speed), F.lit(1))
            .otherwise(F.lit(0)))


def risk_level(label="risk_label") -> Column:
    """Label number to text (anything else is normal)."""
    return (F.when(_c(label) == 2, F.lit("critical"))
            .when(_c(label) == 1, F.lit("moderate"))
            .otherwise(F.lit("normal")))


def prediction_text(prediction="prediction") -> Column:
    """Model output (double) to class text; unknown for anything else."""
    p = _c(prediction)
    expr = F.when(p == float(RISK_CLASSES[0][0]), F.lit(RISK_CLASSES[0][1]))
    for value, name in RISK_CLASSES[1:]:
        expr = expr.when(p == float(value), F.lit(name))
    return expr.otherwise(F.lit("unknown"))
