"""Event-time parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: wire format of event times (minute resolution, no zone).
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"


def parse_event_time(c="timestamp", fmt: str = EVENT_TIME_FORMAT) -> Column:
    """String to TIMESTAMP; a value that does not match gives null.

    ``try_to_timestamp`` rather than ``to_timestamp``: under ANSI mode (the
    default since Spark 4) the latter raises on a bad value, while the
    semantics wanted here are "bad time = missing time".
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(col, F.lit(fmt))


def format_event_time(c, fmt: str = EVENT_TIME_FORMAT) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, fmt)
