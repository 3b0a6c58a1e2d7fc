"""Time functions. All of them assume the session time zone UTC (see `session.configure`)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the zone in which local order times are shown.
LOCAL_ZONE = "Europe/Stockholm"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_time(ts: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """Wall-clock time in `zone` of a UTC time (text with a trailing `Z` is accepted)."""
    return F.from_utc_timestamp(_col(ts), zone)


def round_to_millis(ts: Column | str) -> Column:
    """Nearest millisecond, halves up."""
    return F.date_trunc("MILLISECOND", _col(ts) + F.expr("INTERVAL 500 MICROSECONDS"))


def local_time_ms(ts: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """Wall-clock time at millisecond precision."""
    return round_to_millis(local_time(ts, zone))


def utc_text_timestamp(text: Column | str) -> Column:
    """Zone-less text read explicitly as UTC, whatever the session zone is."""
    return F.to_timestamp(F.concat(_col(text).cast("string"), F.lit(" UTC")))


def stamp(as_of: Column | None = None) -> Column:
    """Processing time: the given clock, else the time of the running query."""
    return F.current_timestamp() if as_of is None else as_of
