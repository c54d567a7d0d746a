"""Late rows as a side output, from the operator that counts the others.

Spark drops rows that come after their window has closed and only says how many. Here one stateful operator asks the engine for
its watermark: a row whose window that watermark has closed comes out as late, and every other row is counted in the engine's state
until a timer at the end of its window emits the count. Late and counted rows make up the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.event_time import as_wall_clock, seconds_of
from tidemark.operators.stateful import NO_TIME, mark, micros, require_watermark, row_of, row_text
from tidemark.sources.definitions import without_heartbeats


def split_late(frame: DataFrame, ts: str, width: str, parts: int | None = None) -> DataFrame:
    """``late, window_start, event_count, row``, in append mode.

    A late row comes out at once, with its whole ``row`` and a count of 1; a row without an event time can belong to no window and is
    late, with ``window_start`` NULL. Windows of ``width`` come out when the watermark reaches their end, in up to ``parts`` rows
    to be added up: a window's rows are dealt over that many groups (the session's shuffle partitions by default), so
    that no window is one task's.
    """
    require_watermark(frame, ts, "a side output of late rows")
    frame = without_heartbeats(frame)
    parts = parts or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    length = seconds_of(width) * 1_000_000
    rows = as_wall_clock(frame.withColumn("_at", micros(ts)))
    schema = rows.drop("_at").schema
    rows = rows.select("_at", row_text(rows.drop("_at")).alias("_row"))
    window = F.floor(F.col("_at") / length).cast("long")  # of NO_TIME a window that was over long before 1970
    groups = rows.select(window.alias("_window"), F.pmod(F.xxhash64("_row"), F.lit(parts)).alias("_part"), mark(), "_row").groupBy("_window", "_part")
    split = groups.transformWithStateInPandas(_Count(seconds_of(width) * 1000), "late boolean, number long, event_count long, text string", "Append", "EventTime")
    start = F.expr(f"TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(number AS DECIMAL(20, 0)) * {seconds_of(width)})")
    return split.select("late", F.when(F.col("number") != F.floor(F.lit(NO_TIME) / length), start).alias("window_start"), "event_count", row_of("text", schema).alias("row"))


class _Count(StatefulProcessor):
    """One part of a window: its number of rows until the window closes, and the rows that come later."""

    def __init__(self, width: int):
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "event_count long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if timerValues.getCurrentWatermarkInMs() >= self._end(key):
            for chunk in rows:
                yield pd.DataFrame({"late": True, "number": key[0], "event_count": 1, "text": chunk.iloc[:, -1].to_numpy()})
            return
        before = self.count.get()
        if before is None:
            self.handle.registerTimer(self._end(key) - 1)
        self.count.update(((before[0] if before else 0) + sum(map(len, rows)),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if timerValues.getCurrentWatermarkInMs() < self._end(key):
            self.handle.registerTimer(self._end(key))
            return
        count = self.count.get()
        self.count.clear()
        if count is not None:
            yield pd.DataFrame({"late": [False], "number": [key[0]], "event_count": [count[0]], "text": [None]})

    def _end(self, key) -> int:
        return (key[0] + 1) * self.width

    def close(self) -> None: ...
