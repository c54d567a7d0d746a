"""Event-time expressions.

Files hold zone-less timestamps; watermarks need instants. Both are read as UTC: conversions count microseconds since 1970,
so they shift no value, whatever time zone the caller's session has.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds_of(span: str | timedelta) -> int:
    """Whole seconds of a span such as ``"10 seconds"`` or ``"6 hours"``; zero or less is refused."""
    if isinstance(span, timedelta):
        seconds = span.total_seconds()
    else:
        amount, unit = span.split()
        seconds = float(amount) * UNIT_SECONDS[unit.lower().rstrip("s")]
    if seconds <= 0 or seconds != int(seconds):
        raise ValueError(f"a time span must be a positive number of whole seconds, got {span!r}")
    return int(seconds)


def interval(span: str | timedelta) -> Column:
    return F.expr(f"INTERVAL '{seconds_of(span)}' SECOND")


def moment(at: datetime) -> Column:
    """A zone-less timestamp literal; ``lit`` would shift it by the time zone of the driver's machine."""
    return F.expr(f"TIMESTAMP_NTZ '{at.isoformat(sep=' ')}'")


def epoch_seconds(ts: str, frame: DataFrame) -> Column:
    """Whole seconds since 1970, never decreasing with ``ts``; zone-less columns stay clear of the session time zone."""
    column = F.col(ts)
    if isinstance(frame.schema[ts].dataType, T.TimestampType):
        return F.unix_seconds(column)
    return (column - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")).cast("interval second").cast("bigint")


def time_bucket(ts: str, frame: DataFrame, width: int, shift: int = 0) -> Column:
    """Number of the ``width``-second bucket that holds ``ts`` moved by ``shift`` seconds."""
    return F.floor((epoch_seconds(ts, frame) + F.lit(shift)) / F.lit(width)).cast("bigint")


def as_instant(frame: DataFrame) -> DataFrame:
    """Zone-less timestamp columns become instants, as ``withWatermark`` requires."""
    return _retype(frame, T.TimestampNTZType, utc_instant)


def as_wall_clock(frame: DataFrame) -> DataFrame:
    """Instants become zone-less timestamps, the type the tables use."""
    return _retype(frame, T.TimestampType, utc_clock)


def utc_clock(instant: str) -> str:
    """SQL: the UTC date and time of an instant, whatever the session's time zone."""
    return f"TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(unix_micros({instant}) AS DECIMAL(20, 0)) / 1000000)"


def utc_instant(clock: str) -> str:
    """SQL: the instant at which UTC shows a zone-less date and time, whatever the session's time zone."""
    since = f"CAST(({clock}) - TIMESTAMP_NTZ '1970-01-01 00:00:00' AS INTERVAL SECOND)"
    return f"timestamp_micros(CAST(CAST({since} AS DECIMAL(20, 6)) * 1000000 AS BIGINT))"


def _retype(frame: DataFrame, kind: type, conversion) -> DataFrame:
    casts = {f.name: F.expr(conversion(f"`{f.name}`")) for f in frame.schema if isinstance(f.dataType, kind)}
    return frame.withColumns(casts) if casts else frame
