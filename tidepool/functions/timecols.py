"""Event-time column helpers (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def event_time(col: str | Column, unit: str = "s") -> Column:
    """Epoch number -> TIMESTAMP (watermarks need TIMESTAMP, not NTZ)."""
    c = _c(col)
    if unit == "s":
        return F.timestamp_seconds(c)
    if unit == "ms":
        return F.timestamp_millis(c)
    if unit == "us":
        return F.timestamp_micros(c)
    raise ValueError(f"unit must be s, ms or us, not {unit!r}")


def as_ntz(col: str | Column) -> Column:
    return _c(col).cast("timestamp_ntz")


def as_ltz(col: str | Column) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP, read as UTC wall clock (session zone is UTC)."""
    return _c(col).cast("timestamp")


def seconds(n: float) -> Column:
    """A day-time interval of ``n`` seconds."""
    return F.make_dt_interval(secs=F.lit(n))


def epoch_micros(col: str | Column) -> Column:
    return F.unix_micros(as_ltz(col))


# fixed values: duration unit names and their length in seconds
_UNITS = {"us": 1e-6, "microsecond": 1e-6, "ms": 1e-3, "millisecond": 1e-3, "s": 1.0, "sec": 1.0,
          "second": 1.0, "m": 60.0, "min": 60.0, "minute": 60.0, "h": 3600.0, "hour": 3600.0,
          "d": 86400.0, "day": 86400.0}


def duration(spec: str | int | float) -> float:
    """'5 seconds' / '1 hour' / '15 minutes' / '1 ms' / '-5 days' / 3 -> seconds."""
    if isinstance(spec, (int, float)):
        return float(spec)
    n, unit = spec.split()
    unit = unit.lower()
    if unit not in _UNITS:
        unit = unit[:-1] if unit.endswith("s") else unit
    return float(n) * _UNITS[unit]


def with_ingest_time(df, out: str = "ingest_ts"):
    """Processing time: the arrival clock as a column (``current_timestamp``
    at read).  Any window over it is a processing-time window."""
    return df.withColumn(out, F.current_timestamp())


# the ascending-timestamp watermark is the max event time minus this delay
ASCENDING_DELAY = "1 ms"
