"""Registration, and the sources and streams the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sources.definitions import Catalog, Source, Stream
from tidemark.sources.landing import Writer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

EVENT_COLUMNS = ("event_id BIGINT NOT NULL, ts TIMESTAMP NOT NULL, user_id BIGINT, event_type VARCHAR, "
                 "value DOUBLE, props VARCHAR")
DELAY = "5 seconds"


def query(sql: str | None = None):
    """Register a query under the function's name."""
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function
    return add


def role(event_type: str, letter: str, id_name: str, delay: str = DELAY):
    """A stream of one event type whose columns carry their own prefix and watermark."""
    def build(events: DataFrame) -> DataFrame:
        return events.filter(F.col("event_type") == event_type).select(
            F.col("event_id").alias(id_name), F.col("user_id").alias(f"{letter}_user"),
            F.col("value").alias(f"{letter}_price"), F.col("ts").alias(f"{letter}_ts"),
        ).withWatermark(f"{letter}_ts", delay)
    return build


def event_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """``events`` with its watermark, the same rows without one, and three streams by event type."""
    path = f"{sf_dir}/events.parquet"
    return Catalog(spark).add(
        Source("events", EVENT_COLUMNS, path, watermark=("ts", DELAY)),
        Source("all_events", EVENT_COLUMNS, path),
        Stream("trades", ["all_events"], role("purchase", "t", "trade_id")),
        Stream("orders", ["all_events"], role("click", "o", "order_id")),
        Stream("quotes", ["all_events"], role("view", "q", "quote_id")),
    )


def id_range(top: int, parts: int, i: int) -> Column:
    """Events of part ``i`` out of ``parts`` by ascending id; plain bounds, so they reach the file scan."""
    first, after = -(-i * top // parts), -(-(i + 1) * top // parts)
    return (F.col("event_id") >= first) & (F.col("event_id") < after)


def land_in_turn(catalog: Catalog, root: str, parts: int, consume: Callable[[Source], object],
                 turn_of: Callable[[int, int], Column] | None = None, turns: int | None = None) -> Source:
    """Append all events to a new source, one turn after the other, and call ``consume`` after each.

    ``turn_of(top, i)`` selects the events of turn ``i``; by default part ``i`` by ascending id.
    """
    events = catalog.static("all_events")
    source = Source("landed", EVENT_COLUMNS, f"{root}/landed", watermark=("ts", DELAY))
    top = events.agg(F.max("event_id")).head()[0] + 1
    with Writer(catalog.spark, source) as writer:
        for i in range(turns or parts):
            writer.write(events.filter(turn_of(top, i) if turn_of else id_range(top, parts, i)))
            consume(source)
    return source
