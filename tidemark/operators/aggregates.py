"""Window and keyed aggregates. All are two-phase in Spark, so hot keys shrink before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.event_time import interval, seconds_of
from tidemark.sources.definitions import without_heartbeats


def tumble(frame: DataFrame, keys: list[str], ts: str, width: str, start: str = "window_start", **aggregates: Column) -> DataFrame:
    """Aggregates per key and fixed window ``[start, start + width)``, windows aligned to 1970.

    On a stream in append mode a window appears once, when the watermark reaches its end. Rows that only move the watermark
    are in no window.
    """
    grouped = without_heartbeats(frame).groupBy(*keys, F.window(ts, f"{seconds_of(width)} seconds")).agg(
        *[a.alias(name) for name, a in (aggregates or {"_rows": F.count(F.lit(1))}).items()])
    return grouped.select(*keys, F.col("window.start").alias(start), *aggregates)


def keyed(frame: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """Continuous aggregate per key."""
    return without_heartbeats(frame).groupBy(*keys).agg(*[a.alias(name) for name, a in aggregates.items()])


def closed_windows(windows: DataFrame, rows: DataFrame, ts: str, delay: str, width: str, start: str = "window_start") -> DataFrame:
    """The windows of a static ``tumble`` that a stream over the same rows would have emitted.

    The watermark is the greatest event time minus ``delay``, cut to milliseconds, as a scalar subquery.
    """
    mark = rows.agg(F.date_trunc("millisecond", F.max(ts) - interval(delay))).scalar()
    return windows.filter(F.col(start) + interval(width) <= mark)
