"""Writing batches into a source's folder, where streams pick them up."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidemark.functions.event_time import as_wall_clock, moment, seconds_of
from tidemark.session import make_dir, rename
from tidemark.sources.conform import check_batch_schema, conform_or_fail, not_null_guard, rejects_as_errors
from tidemark.sources.definitions import APPEND, DAY, HEARTBEAT, WRITER_CLOSED, EventError, Source, declared_columns


def append_rows(batch: DataFrame, path: str, day_of: str | None = None) -> int:
    """Append ``batch`` to a folder of Parquet files and return the number of rows, counted by the write itself.

    The rows go to a folder that readers skip, which one rename then makes visible as a whole. With ``day_of``, an event-time
    column, they are partitioned by its day; a day's rows are brought together before, so that small days make one file.
    """
    seen, name = Observation(), uuid.uuid4().hex
    if day_of is not None:
        batch = batch.withColumn(DAY, F.to_date(f"`{day_of}`")).hint("rebalance", DAY)
    writer = batch.observe(seen, F.count(F.lit(1)).alias("rows")).write
    with rejects_as_errors():
        (writer if day_of is None else writer.partitionBy(DAY)).parquet(f"{path}/_new-{name}")
    rename(batch.sparkSession, f"{path}/_new-{name}", f"{path}/{'rows-' if day_of is None else f'{APPEND}='}{name}")
    return int(seen.get["rows"])


class Writer:
    """Feeds one source. Each call is one committed append: readers see all its rows or none."""

    def __init__(self, spark: SparkSession, source: Source):
        self.spark = spark
        self.source = source
        self._closed = False
        self._pending: list[DataFrame] = []
        self._watermark_ms: int | None = None
        make_dir(spark, source.path)

    def __enter__(self) -> "Writer":
        return self

    def __exit__(self, *_exc) -> None:
        self.close()

    def write(self, batch: DataFrame) -> int:
        """Append a typed batch now; its columns and types must be the declared ones."""
        self._require_open()
        check_batch_schema(batch, self.source)
        return self._append(self._storable(batch))

    def write_json(self, rows: DataFrame, raw: str = "raw") -> int:
        """Append rows given as JSON text; one bad row fails them all."""
        self._require_open()
        return self._append(conform_or_fail(rows, self.source, raw))

    def buffer(self, batch: DataFrame) -> None:
        """Keep a typed batch for the next ``flush``, which appends everything buffered in one write."""
        self._require_open()
        check_batch_schema(batch, self.source)
        self._pending.append(self._storable(batch))

    def flush(self) -> int:
        self._require_open()
        pending, self._pending = self._pending, []
        if not pending:
            return 0
        together = pending[0]
        for batch in pending[1:]:
            together = together.unionByName(batch)
        return self._append(together)

    def watermark(self, at: int | datetime) -> None:
        """Move event time to ``at`` (epoch milliseconds or an aware datetime) without data.

        It never moves back. A row that carries only the event time is appended; it sits ``delay``
        after ``at`` because the watermark trails the greatest event time by that much.
        """
        self._require_open()
        if self.source.watermark is None:
            raise EventError(WRITER_CLOSED - 1, f"{self.source.name!r} declares no watermark")
        at_ms = at if isinstance(at, int) else round(at.timestamp() * 1000)
        if self._watermark_ms is not None and at_ms <= self._watermark_ms:
            return
        ts, delay = self.source.watermark
        event_time = moment(datetime(1970, 1, 1) + timedelta(milliseconds=at_ms, seconds=seconds_of(delay)))
        beat = self.spark.range(1).select(
            *[(event_time if f.name == ts else F.lit(None).cast(f.spark_type)).alias(f.name) for f in self.source.fields],
            F.lit(True).alias(HEARTBEAT))
        self._append(beat)
        self._watermark_ms = at_ms

    def current_watermark(self) -> int | None:
        """The last watermark given, in epoch milliseconds, or None."""
        self._require_open()
        return self._watermark_ms

    def close(self) -> None:
        """Flush what is buffered; closing twice does nothing."""
        if not self._closed:
            self.flush()
            self._closed = True

    def _append(self, rows: DataFrame) -> int:
        return append_rows(rows, self.source.path, self.source.watermark[0] if self.source.by_day else None)

    def _storable(self, batch: DataFrame) -> DataFrame:
        return not_null_guard(declared_columns(as_wall_clock(batch), self.source), self.source)

    def _require_open(self) -> None:
        if self._closed:
            raise EventError(WRITER_CLOSED, f"the writer of {self.source.name!r} is closed")
