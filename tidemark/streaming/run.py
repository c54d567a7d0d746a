"""Running streams: draining what is there, starting and stopping everything, checkpoints, metrics."""

from __future__ import annotations

import json
from datetime import datetime
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.functions.event_time import as_wall_clock
from tidemark.plans.admission import check_stream_plan
from tidemark.session import committed_numbers, numbered_files, read_text, remove, write_text
from tidemark.sources.definitions import NOT_CHECKPOINTED, SHUT_DOWN, Catalog, EventError, Sink, Source, Stream
from tidemark.streaming.journal import Journal


def start(frame: DataFrame, target, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Start a stream into a Parquet folder (a path) or a ``foreachBatch`` function.

    Without ``every`` all input present now is processed and the query ends.
    """
    writer = check_stream_plan(as_wall_clock(frame)).writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if callable(target):
        return writer.foreachBatch(lambda batch, epoch: target(batch, epoch)).start()
    return writer.format("parquet").option("path", target).start()


def drain(frame: DataFrame, target, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything present now and wait; a failure raises."""
    query = start(frame, target, checkpoint, mode)
    query.awaitTermination()
    return query


def replay(frame: DataFrame, root: str) -> DataFrame:
    """Everything an append stream emits over its present input, as a static frame."""
    drain(frame, f"{root}/out", f"{root}/checkpoint")
    return read_output(frame.sparkSession, f"{root}/out", frame)


def read_output(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The committed output of a file sink; only whole batches are visible."""
    return spark.read.schema(as_wall_clock(like).schema).parquet(path)


def current_watermark(query: StreamingQuery) -> int | None:
    """The query's last watermark in epoch milliseconds; None before the first one."""
    for progress in reversed(query.recentProgress):
        if progress["eventTime"].get("watermark"):
            return _millis(progress["eventTime"]["watermark"])
    return None


class Progress(StreamingQueryListener):
    """Running totals of what the batches of a session's queries reported.

    One record a query, whatever the number of batches: sums, and the last batch they hold, so that a batch which reports
    again counts once. With a ``folder`` the record is also kept there, one small JSON file a query after each batch (the last two
    stay), under the id that a query keeps over restarts; totals then go on where they ended. A report comes after its
    batch has been committed: a driver lost between the two leaves that one batch out.
    """

    def __init__(self, session: SparkSession, folder: str | None = None):
        self.session = session
        self.folder = folder
        self._totals: dict[str, dict] = {}
        session.streams.addListener(self)

    def onQueryStarted(self, event): ...

    def onQueryIdle(self, event): ...

    def onQueryTerminated(self, event): ...

    def onQueryProgress(self, event):
        progress = event.progress
        query = str(progress.id)
        total = self._record(query)
        if progress.batchId <= total["last_batch"]:
            return
        mark = _millis(progress.eventTime.get("watermark"))
        total["last_batch"] = progress.batchId
        total["batches"] += 1
        total["input_rows"] += progress.numInputRows
        total["dropped_rows"] += sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        total["watermark_ms"] = max(filter(None, (total["watermark_ms"], mark)), default=None)
        for source in progress.sources:
            folder = _folder_of(source.description)
            total["sources"][folder] = total["sources"].get(folder, 0) + source.numInputRows
        if self.folder:
            self._keep(query, total)

    def _record(self, query: str) -> dict:
        if query not in self._totals:
            self._totals[query] = (self.folder and self._kept(query)) or {
                "last_batch": -1, "batches": 0, "input_rows": 0, "dropped_rows": 0, "watermark_ms": None, "sources": {}}
        return self._totals[query]

    def _kept(self, query: str) -> dict | None:
        """The newest record that was written whole."""
        for batch in reversed(numbered_files(self.session, f"{self.folder}/{query}")):
            try:
                return json.loads(read_text(self.session, f"{self.folder}/{query}/{batch}"))
            except ValueError:
                continue
        return None

    def _keep(self, query: str, total: dict) -> None:
        write_text(self.session, f"{self.folder}/{query}/{total['last_batch']}", json.dumps(total))
        for old in numbered_files(self.session, f"{self.folder}/{query}")[:-2]:
            remove(self.session, f"{self.folder}/{query}/{old}")

    def _records(self, queries: dict[str, str]) -> list[tuple[str, dict]]:
        """Waits until all reports so far are in."""
        self.session.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        return [(name, self._record(query)) for name, query in queries.items()]

    def totals(self, queries: dict[str, StreamingQuery]) -> DataFrame:
        """Per stream: input rows, batches, rows dropped as late, watermark."""
        rows = [(name, r["input_rows"], r["batches"], r["dropped_rows"], r["watermark_ms"])
                for name, r in self._records({name: str(query.id) for name, query in queries.items()})]
        return self.session.createDataFrame(
            rows, "stream string, input_rows long, batches long, dropped_rows long, watermark_ms long")

    def by_source(self, queries: dict[str, StreamingQuery]) -> DataFrame:
        """Per stream and folder it reads: input rows."""
        rows = [(name, folder, n) for name, r in self._records({name: str(query.id) for name, query in queries.items()})
                for folder, n in r["sources"].items()]
        return self.session.createDataFrame(rows, "stream string, folder string, input_rows long")

    def close(self) -> None:
        self.session.streams.removeListener(self)


def _folder_of(description: str) -> str:
    """The folder in a file source's description, ``FileStreamSource[file:/a/b]``, without its scheme."""
    inner = description.partition("[")[2].rpartition("]")[0] or description
    return plain_path(inner)


def plain_path(path: str) -> str:
    return "/" + urlsplit(path).path.strip("/")


def _millis(text: str | None) -> int | None:
    if not text:
        return None
    return round(datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp() * 1000) or None


class Runner:
    """Runs every sink of a catalogue; one query and one checkpoint folder each."""

    def __init__(self, catalog: Catalog, root: str | None = None):
        self.catalog = catalog
        self.root = root
        self.queries: dict[str, StreamingQuery] = {}
        self._progress: Progress | None = None
        self._continuous = False
        self._down = False

    def start(self, every: str | None = None) -> dict[str, StreamingQuery]:
        """Start every sink. With ``every`` they keep running until ``shutdown``; without, they end when drained."""
        self._require_up()
        if self.root is None:
            raise EventError(NOT_CHECKPOINTED, "checkpointing is not enabled: give a folder")
        self._continuous = self._continuous or every is not None
        self._reports()
        for sink in self.catalog.of_kind(Sink):
            running = self.queries.get(sink.name)
            if running is None or not running.isActive:
                self.queries[sink.name] = self._start(sink, every)
        return self.queries

    def _start(self, sink: Sink, every: str | None) -> StreamingQuery:
        return start(self.catalog.live(sink.stream), self._journal(sink), f"{self.root}/{sink.name}", sink.mode, every)

    def _journal(self, sink: Sink) -> Journal:
        return Journal(self.catalog.spark, sink.path, list(sink.key) if sink.mode == "update" else None, sink.compact_every)

    def drain(self) -> dict[str, StreamingQuery]:
        """Run every sink over the input present now and wait for all of them."""
        queries = self.start()
        for query in queries.values():
            query.processAllAvailable() if self._continuous else query.awaitTermination()
        return queries

    def read(self, sink_name: str, at: int | None = None) -> DataFrame:
        """A sink's table: all rows of an appended one, the latest row per key of an updated one, the last result of a complete one.

        ``at`` is the id of a checkpoint: the table as it was then, so that all sinks read at one id show the same cut.
        """
        self._require_up()
        sink: Sink = self.catalog.get(sink_name)
        through = None if at is None else self._reached(at, sink_name)
        journal, schema = self._journal(sink), lambda: as_wall_clock(self.catalog.live(sink.stream)).schema
        if through == -1:
            return self.catalog.spark.createDataFrame([], schema())
        if sink.mode == "update":
            return journal.latest(list(sink.key), through)
        if sink.mode == "complete":
            return journal.newest_epoch(through)
        return journal.appended(schema(), through)

    def _reached(self, checkpoint_id: int, sink_name: str) -> int:
        """The sink's last batch in a checkpoint."""
        spark = self.catalog.spark
        if self.root is None or checkpoint_id not in committed_numbers(spark, f"{self.root}/checkpoints", "id="):
            raise EventError(NOT_CHECKPOINTED, f"there is no checkpoint {checkpoint_id}")
        found = spark.read.schema("sink string, batch_id long").parquet(
            f"{self.root}/checkpoints/id={checkpoint_id}").filter(F.col("sink") == sink_name).head()
        if found is None:
            raise EventError(NOT_CHECKPOINTED, f"checkpoint {checkpoint_id} does not hold {sink_name!r}")
        return found["batch_id"]

    def checkpoint(self) -> int:
        """Record how far each sink got under a new, greater id.

        Sinks that are not running are brought up to date first; running ones go on, and what they have committed counts.
        """
        self._require_up()
        if self.root is None:
            raise EventError(NOT_CHECKPOINTED, "checkpointing is not enabled: give a folder")
        if not self.catalog.of_kind(Stream) or not self.catalog.of_kind(Sink):
            raise EventError(NOT_CHECKPOINTED, "nothing to checkpoint: no derived stream has a sink")
        running = self._continuous and all(query.isActive for query in self.queries.values())
        if not running:
            self.drain()
        done = committed_numbers(self.catalog.spark, f"{self.root}/checkpoints", "id=")
        checkpoint_id = (done[-1] if done else 0) + 1
        reached = [(name, _last_batch(self.catalog.spark, f"{self.root}/{name}")) for name in self.queries]
        self.catalog.spark.createDataFrame(reached, "sink string, batch_id long").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.root}/checkpoints/id={checkpoint_id}")
        return checkpoint_id

    def metrics(self) -> DataFrame:
        """Totals of the started sinks since their first batch, over restarts."""
        return self._reports().totals(self.queries)

    def source_metrics(self) -> DataFrame:
        """Input rows per sink and source since the first batch; a folder that several or no sources name is given as such."""
        names: dict[str, list[str]] = {}
        for source in self.catalog.of_kind(Source):
            names.setdefault(plain_path(source.path), []).append(source.name)
        single = [(folder, found[0]) for folder, found in names.items() if len(found) == 1]
        rows = self._reports().by_source(self.queries)
        known = rows.sparkSession.createDataFrame(single, "folder string, source string")
        return rows.join(known, "folder", "left").select("stream", F.coalesce("source", "folder").alias("source"), "input_rows")

    def _reports(self) -> Progress:
        self._progress = self._progress or Progress(self.catalog.streaming, self.root and f"{self.root}/metrics")
        return self._progress

    def shutdown(self) -> None:
        """Stop everything; any later call fails."""
        for query in self.queries.values():
            query.stop()
        if self._progress is not None:
            self._progress.close()
        self._down = True

    def _require_up(self) -> None:
        if self._down:
            raise EventError(SHUT_DOWN, "already shut down")


def _last_batch(spark: SparkSession, checkpoint: str) -> int:
    commits = numbered_files(spark, f"{checkpoint}/commits")
    return commits[-1] if commits else -1
