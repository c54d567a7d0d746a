"""Named streams, sinks, frames, listeners and checkpoints."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.operators.aggregates import keyed, tumble
from tidemark.registry.base import EVENT_COLUMNS, event_catalog, land_in_turn, query
from tidemark.session import workspace
from tidemark.sources.definitions import EventError, Sink, Source, Stream, read_live, sql_stream
from tidemark.streaming.journal import Journal, Subscription
from tidemark.streaming.listener import Delivery, Listener, per_batch
from tidemark.streaming.run import Runner, drain, replay

PART = "event_id * 3 // (SELECT max(event_id) + 1 FROM events)"


@query("SELECT event_id, event_type FROM events")
def stream_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream without a watermark emits at once."""
    catalog = event_catalog(spark, sf_dir).add(
        Stream("out", ["all_events"], lambda e: e.select("event_id", "event_type")))
    return replay(catalog.live("out"), workspace(spark, "stream_passthrough"))


@query("SELECT trade_id, t_price FROM (SELECT event_id AS trade_id, value AS t_price FROM events WHERE event_type = 'purchase') WHERE t_price > 100")
def stream_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that reads a stream; the second one is given as SQL text."""
    catalog = event_catalog(spark, sf_dir).add(
        Stream("large", ["trades"], lambda t: t.filter("t_price > 100")),
        sql_stream("large_prices", ["large"], "SELECT trade_id, t_price FROM large"))
    return replay(catalog.live("large_prices"), workspace(spark, "stream_chain"))


@query("SELECT event_id, ts, value FROM events WHERE value > 50")
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An appended table, filled over three turns of input."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "sink_append")
    build = lambda e: e.filter("value > 50").select("event_id", "ts", "value")

    def turn(source):
        if "landed" not in catalog.names(type(source)):
            catalog.add(source, Stream("large", ["landed"], build), Sink("large_out", "large", f"{root}/large"))
        Runner(catalog, f"{root}/run").drain()
    land_in_turn(catalog, root, 3, turn)
    return Runner(catalog, f"{root}/run").read("large_out")


@query("SELECT event_type, count(*) AS event_count FROM events GROUP BY event_type")
def sink_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An updated table: each batch writes the keys it changed, readers see the newest row per key."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "sink_update")
    catalog.add(Stream("totals", ["all_events"], lambda e: keyed(e, ["event_type"], event_count=F.count(F.lit(1)))),
                Sink("totals_out", "totals", f"{root}/totals", mode="update", key=("event_type",)))
    runner = Runner(catalog, f"{root}/run")
    runner.drain()
    return runner.read("totals_out")


@query("""SELECT 'large_out' AS sink, count(*) AS row_count FROM events WHERE value > 100
UNION ALL SELECT 'hours_out', count(*) FROM (SELECT date_trunc('hour', ts) AS w FROM events GROUP BY 1)
  WHERE w + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts) - INTERVAL 5 SECOND) FROM events)""")
def run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sink of a catalogue started at once and drained, then counted."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "run_all")
    catalog.add(
        Stream("large", ["events"], lambda e: e.filter("value > 100").select("event_id", "value")),
        Stream("hours", ["events"], lambda e: tumble(e, [], "ts", "1 hour", event_count=F.count(F.lit(1)))),
        Sink("large_out", "large", f"{root}/large"), Sink("hours_out", "hours", f"{root}/hours"))
    runner = Runner(catalog, f"{root}/run")
    runner.drain()
    counts = [runner.read(name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("sink"), "row_count")
              for name in catalog.names(Sink)]
    runner.shutdown()
    return counts[0].unionByName(counts[1])


def _journal(spark: SparkSession, sf_dir: str, label: str, columns: list[str]) -> Journal:
    """All events delivered as three epochs."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, label)
    journal = Journal(catalog.spark, f"{root}/journal")
    land_in_turn(catalog, root, 3, lambda source: drain(
        read_live(catalog.streaming, source).select(*columns), journal, f"{root}/checkpoint"))
    return journal


@query(f"""WITH e AS (SELECT {PART} AS epoch, count(*) AS row_count FROM events GROUP BY 1)
SELECT 'data' AS kind, 2 * epoch AS sequence, epoch, NULL::BIGINT AS checkpoint_id, NULL::BIGINT AS through_sequence, row_count FROM e
UNION ALL SELECT 'barrier', 2 * epoch + 1, epoch, epoch, 2 * epoch, NULL FROM e""")
def frames_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data frames and the barriers that make them durable."""
    return _journal(spark, sf_dir, "frames_journal", ["event_id", "value"]).frames()


@query(f"SELECT event_id, value, {PART} AS epoch FROM events")
def frames_batches_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All delivered rows, barriers skipped."""
    return _journal(spark, sf_dir, "frames_batches_only", ["event_id", "value"]).batches()


@query(f"SELECT event_id, epoch FROM (SELECT event_id, {PART} AS epoch FROM events) WHERE epoch > 0")
def frames_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer that has acknowledged the first epoch goes on after it."""
    subscription = Subscription(_journal(spark, sf_dir, "frames_resume", ["event_id"]))
    subscription.acknowledge(0)
    return subscription.poll()


class _Lost(Exception):
    """Stands for a consumer that goes away."""


@query(f"SELECT event_id, {PART} AS epoch, CASE {PART} WHEN 1 THEN 2 ELSE 1 END AS deliveries FROM events")
def frames_consumer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named consumer is lost between its own write and the acknowledgement: the next one of that name gets the epoch again."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "frames_consumer")
    journal = Journal(catalog.spark, f"{root}/journal")
    deliveries: dict[int, int] = {}

    def copy(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/copy/epoch={epoch}")
        deliveries[epoch] = deliveries.get(epoch, 0) + 1
        if (epoch, deliveries[epoch]) == (1, 1):
            raise _Lost

    def turn(source):
        drain(read_live(catalog.streaming, source).select("event_id"), journal, f"{root}/checkpoint")
        try:
            Subscription(journal, name="copier").consume(copy)
        except _Lost:
            pass
    land_in_turn(catalog, root, 3, turn)
    counted = catalog.spark.createDataFrame(list(deliveries.items()), "epoch long, deliveries int")
    copied = catalog.spark.read.parquet(f"{root}/copy").withColumn("epoch", F.col("epoch").cast("bigint"))
    return copied.join(counted, "epoch").select("event_id", "epoch", "deliveries")


@query(f"""WITH e AS (SELECT {PART} AS epoch, count(*) AS n FROM events GROUP BY 1)
SELECT c.cursor, count(e.epoch) AS lag, coalesce(sum(e.n), 0)::BIGINT AS pending_rows
FROM (SELECT -1::BIGINT AS cursor UNION ALL SELECT epoch FROM e) c LEFT JOIN e ON e.epoch > c.cursor GROUP BY c.cursor""")
def frames_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far behind a consumer is at each position it can have."""
    journal = _journal(spark, sf_dir, "frames_lag", ["event_id"])
    barriers = journal.barriers().select("epoch", "row_count")
    # A position before the first epoch, and one at each; a row stands for each epoch, so the sum runs over few rows.
    after = Window.orderBy("cursor").rowsBetween(1, Window.unboundedFollowing)
    places = barriers.select(F.col("epoch").alias("cursor"), "row_count", F.lit(1).alias("one")).unionByName(
        spark.range(1).select(F.lit(-1).cast("bigint").alias("cursor"), F.lit(0).cast("bigint").alias("row_count"), F.lit(0).alias("one")))
    return places.select("cursor", F.coalesce(F.sum("one").over(after), F.lit(0)).cast("bigint").alias("lag"),
                         F.coalesce(F.sum("row_count").over(after), F.lit(0)).cast("bigint").alias("pending_rows"))


@query("SELECT user_id, max(value) AS best FROM events GROUP BY user_id")
def journal_after_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An updated table read after its old epochs were compacted into a base and dropped."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "journal_after_expiry")
    journal = Journal(catalog.spark, f"{root}/journal")
    best = lambda source: keyed(read_live(catalog.streaming, source), ["user_id"], best=F.max("value"))

    def turn(source):
        drain(best(source), journal, f"{root}/checkpoint", "update")
        if len(journal.epochs()) == 2:
            journal.compact(["user_id"])
            journal.expire(journal.epochs()[-1] + 1, keyed=True)
    land_in_turn(catalog, root, 3, turn)
    return journal.latest(["user_id"])


class CountingListener(Listener):
    """Writes the counts by type of each batch it is given."""

    def __init__(self, path: str):
        self.path = path
        self.closed = self.failed = 0

    def on_batch(self, batch: DataFrame, epoch: int) -> None:
        counts = batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))
        counts.write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")

    def on_error(self, message: str) -> None:
        self.failed += 1

    def on_close(self) -> None:
        self.closed += 1


@query(f"SELECT {PART} AS epoch, event_type, count(*) AS event_count FROM events GROUP BY 1, 2")
def listener(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user function pushed one batch at a time."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "listener")

    def deliver(source):
        counting = CountingListener(f"{root}/counts")
        Delivery(read_live(catalog.streaming, source), counting, f"{root}/checkpoint").await_stopped(600)
        if (counting.failed, counting.closed) != (0, 1):
            raise EventError(500, "delivery did not end with exactly one close")
    land_in_turn(catalog, root, 3, deliver)
    counts = catalog.spark.read.parquet(f"{root}/counts")
    return counts.select(F.col("epoch").cast("bigint").alias("epoch"), "event_type", "event_count")


@query(f"""SELECT p + 1 AS checkpoint_id, sum(count(*)) OVER (ORDER BY p)::BIGINT AS row_count
FROM (SELECT {PART} AS p FROM events) GROUP BY p""")
def checkpoint_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream restarted from its checkpoint after each turn: ids grow, no row is lost or doubled."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "checkpoint_advance")
    reached = []

    def turn(source):
        if not reached:
            catalog.add(source, Stream("ids", ["landed"], lambda e: e.select("event_id")), Sink("ids_out", "ids", f"{root}/ids"))
        runner = Runner(catalog, f"{root}/run")
        checkpoint_id = runner.checkpoint()
        rows = runner.read("ids_out").agg(F.count("event_id").alias("all"), F.countDistinct("event_id").alias("distinct")).head()
        if rows["all"] != rows["distinct"]:
            raise EventError(900, "a row was delivered twice")
        reached.append((checkpoint_id, rows["all"]))
    land_in_turn(catalog, root, 3, turn)
    return catalog.spark.createDataFrame(reached, "checkpoint_id long, row_count long")


@query(f"""WITH e AS (SELECT event_type, {PART} AS p FROM events), c AS (SELECT DISTINCT p FROM e)
SELECT c.p + 1 AS checkpoint_id, 'ids_out' AS sink, 'any' AS event_type, count(*) AS row_count FROM c JOIN e ON e.p <= c.p GROUP BY c.p
UNION ALL SELECT c.p + 1, 'totals_out', e.event_type, count(*) FROM c JOIN e ON e.p <= c.p GROUP BY c.p, e.event_type""")
def checkpoint_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sinks that take different numbers of batches, read as of each checkpoint after the last one: always the same cut."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "checkpoint_read")
    turns, reached = [], []

    def turn(source):
        turns.append(source)
        if len(turns) == 1:
            catalog.add(
                source, Source("singly", EVENT_COLUMNS, source.path, options={"maxFilesPerTrigger": "1"}),
                Stream("ids", ["singly"], lambda e: e.select("event_id")),
                Stream("totals", ["landed"], lambda e: keyed(e, ["event_type"], row_count=F.count(F.lit(1)))),
                Sink("ids_out", "ids", f"{root}/ids"),
                Sink("totals_out", "totals", f"{root}/totals", mode="update", key=("event_type",), compact_every=2))
        if len(turns) % 2 == 0:
            reached.append(Runner(catalog, f"{root}/run").checkpoint())
    land_in_turn(catalog, root, 6, turn)
    runner, cuts = Runner(catalog, f"{root}/run"), []
    for at in reached:
        ids = runner.read("ids_out", at).agg(F.count("event_id").alias("row_count")).select(F.lit("any").alias("event_type"), "row_count")
        totals = runner.read("totals_out", at).select("event_type", "row_count")
        cuts += [frame.select(F.lit(at).cast("bigint").alias("checkpoint_id"), F.lit(name).alias("sink"), "event_type", "row_count")
                 for name, frame in (("ids_out", ids), ("totals_out", totals))]
    together = cuts[0]
    for cut in cuts[1:]:
        together = together.unionByName(cut)
    return together


def _sizes(batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["batch_rows"])


@query("SELECT count(*)::BIGINT AS row_count FROM events")
def bounded_query_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded result handed over batch by batch on the executors; the batches hold every row once."""
    events = event_catalog(spark, sf_dir).static("events").select("event_id")
    return per_batch(events, _sizes, "batch_rows long").agg(F.sum("batch_rows").alias("row_count"))
