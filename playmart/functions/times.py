"""Event-time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "America/Denver"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_played_at(text: str | Column) -> Column:
    """UTC timestamp from ``…58.123Z``, ``…58+00:00`` or ``…58+00:00Z``; NULL if unreadable."""
    clean = F.regexp_replace(_col(text), r"([+-]\d{2}:?\d{2})Z$", "$1")
    return F.try_to_timestamp(clean)


def local_time(col: str | Column, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(_col(col), zone)


def seconds_of_day(col: str | Column) -> Column:
    c = _col(col)
    return (F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("int")


def clock_text(seconds: str | Column) -> Column:
    """``HH:mm:ss`` for a second of the day."""
    s = _col(seconds)
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(s / 3600).cast("int"), F.floor(s % 3600 / 60).cast("int"), (s % 60).cast("int"),
    )


def whole_seconds_between(earlier: Column, later: Column) -> Column:
    return F.timestamp_diff("SECOND", earlier, later)
