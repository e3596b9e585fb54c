"""Time expressions on TIMESTAMP_NTZ columns, all JVM-side.

Timestamps are handled as long microseconds since 1970-01-01 (wall clock, no
zone), which keeps window frames as plain ``rangeBetween`` on a long and makes
every interval exact.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_US = 60_000_000
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US
# Fixed value: bucket origin of the SQL time_bucket function for minute
# intervals (Monday 2000-01-03). Equal to the 1970 origin whenever the interval
# divides a day; exact for any interval.
BUCKET_ORIGIN_US = 946_857_600_000_000


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def micros(col: str | Column) -> Column:
    """TIMESTAMP_NTZ -> long micros since 1970-01-01, independent of session zone."""
    return F.timestamp_diff("MICROSECOND", _epoch(), _c(col))


def from_micros(col: str | Column) -> Column:
    """long micros -> TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", _c(col), _epoch())


def ts_literal_micros(ts: datetime) -> int:
    """Python naive datetime -> micros (wall clock)."""
    delta = ts - datetime(1970, 1, 1)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def floor_to(us: str | Column, step_us: int, origin_us: int = 0) -> Column:
    """Floor micros onto a grid of ``step_us`` anchored at ``origin_us`` (floor, not trunc)."""
    u = _c(us)
    return u - F.pmod(u - F.lit(origin_us), F.lit(step_us))


def bucket_micros(us: str | Column, interval_min: int) -> Column:
    """time_bucket(INTERVAL n MINUTE, ts) on micros."""
    return floor_to(us, interval_min * MINUTE_US, BUCKET_ORIGIN_US)


def hour_of_day(ts: str | Column) -> Column:
    return F.hour(_c(ts)).cast("int")


def day_of_week(ts: str | Column) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(_c(ts)) - 1).cast("int")


def is_weekend(ts: str | Column) -> Column:
    return F.dayofweek(_c(ts)).isin(1, 7).cast("int")


def ntz_literal(ts: datetime) -> Column:
    """A TIMESTAMP_NTZ literal for a naive datetime (no zone conversion on the
    way, whatever the session or Python time zone)."""
    return F.expr(f"TIMESTAMP_NTZ'{ts.isoformat(sep=' ')}'")
