"""Push delivery: a user function called per micro-batch, with one error and one close at the end."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.streaming.run import start


class Listener:
    """Override what is needed. ``on_batch`` gets a frame, so its work runs on the executors."""

    def on_batch(self, batch: DataFrame, epoch: int) -> None: ...

    def on_error(self, message: str) -> None: ...

    def on_close(self) -> None: ...


class _Termination(StreamingQueryListener):
    def __init__(self, delivery: "Delivery"):
        self.delivery = delivery

    def onQueryStarted(self, event): ...

    def onQueryProgress(self, event): ...

    def onQueryIdle(self, event): ...

    def onQueryTerminated(self, event):
        self.delivery._terminated(str(event.id), event.exception)


class Delivery:
    """A running push subscription."""

    def __init__(self, frame: DataFrame, listener: Listener, checkpoint: str, every: str | None = None):
        self.listener = listener
        self._stopped = threading.Event()
        self._early: dict[str, str | None] = {}
        self._lock = threading.Lock()
        self.query: StreamingQuery | None = None
        self._streams = frame.sparkSession.streams
        self._watch = _Termination(self)
        self._streams.addListener(self._watch)
        try:
            query = start(frame, listener.on_batch, checkpoint, every=every)
        except Exception:
            self._streams.removeListener(self._watch)
            raise
        with self._lock:
            self.query = query
            ended_early = str(query.id) in self._early
        if ended_early:
            self._finish(self._early[str(query.id)])

    def is_active(self) -> bool:
        return not self._stopped.is_set()

    def cancel(self) -> None:
        self.query.stop()

    def await_stopped(self, timeout: float | None = None) -> bool:
        """Wait for the last callback; returns whether it has run."""
        return self._stopped.wait(timeout)

    def _terminated(self, query_id: str, error: str | None) -> None:
        with self._lock:
            if self.query is None:
                self._early[query_id] = error
                return
            if query_id != str(self.query.id):
                return
        self._finish(error)

    def _finish(self, error: str | None) -> None:
        with self._lock:
            if self._stopped.is_set():
                return
            try:
                if error is not None:
                    self.listener.on_error(error)
                self.listener.on_close()
            finally:
                self._stopped.set()
        self._streams.removeListener(self._watch)


def per_batch(frame: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Run a bounded query's result through ``function``, one Arrow batch at a time, on the executors.

    Batches are produced as they are consumed, at most ``spark.sql.execution.arrow.maxRecordsPerBatch``
    rows each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield function(batch)
    return frame.mapInArrow(run, schema)
