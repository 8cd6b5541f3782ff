"""Event times, calendar days and hour buckets, all in the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obslayers.schemas import TIME_PATTERN

USUAL_TIME = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z\z"


def parse_time(text: Column, pattern: str | None = TIME_PATTERN, strict: bool = False) -> Column:
    """``text`` as a timestamp, by ``pattern`` or, without one, by the ISO default.

    Text that does not fit gives null; with ``strict`` it fails the query under
    ANSI mode. The usual form of the offset pattern, whole seconds ending in Z, means
    the same to both parsers and goes to the default one, which is much faster.
    """
    if strict:
        return F.to_timestamp(text, pattern) if pattern else F.to_timestamp(text)
    if pattern is None:
        return F.try_to_timestamp(text)
    by_pattern = F.try_to_timestamp(text, F.lit(pattern))
    if pattern != TIME_PATTERN:
        return by_pattern
    return F.when(text.rlike(USUAL_TIME), F.try_to_timestamp(text)).otherwise(by_pattern)


def in_zone(time: Column, zone: str | None) -> Column:
    """UTC ``time`` shown as the wall clock of ``zone``; unchanged without a zone."""
    return F.from_utc_timestamp(time, zone) if zone else time


def calendar_day(time: Column) -> Column:
    return F.to_date(time)


def hour_bucket(time: Column) -> Column:
    return F.date_trunc("hour", time)
