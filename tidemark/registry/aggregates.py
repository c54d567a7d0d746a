"""Counts, averages, tumbling windows and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.event_time import as_wall_clock
from tidemark.operators.aggregates import closed_windows, keyed, tumble
from tidemark.operators.topk import RunningTopK, top_k
from tidemark.registry.base import DELAY, EVENT_COLUMNS, event_catalog, id_range, land_in_turn, query
from tidemark.session import workspace
from tidemark.sources.definitions import Sink, Source, Stream, read_live
from tidemark.sources.landing import Writer
from tidemark.streaming.journal import Journal
from tidemark.streaming.late import split_late
from tidemark.streaming.run import Progress, Runner, drain, replay


def _windows(delay: str | None) -> str:
    closed = "" if delay is None else (
        f"WHERE window_start + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts) - INTERVAL {delay}) FROM events)")
    return f"""WITH g AS (SELECT event_type, date_trunc('hour', ts) AS window_start, count(*) AS event_count
FROM events GROUP BY 1, 2) SELECT event_type, window_start, event_count FROM g {closed}"""


def _hourly(events: DataFrame) -> DataFrame:
    return tumble(events, ["event_type"], "ts", "1 hour", event_count=F.count_if(F.col("event_id").isNotNull()))


@query("SELECT count(*) AS n FROM events")
def agg_count_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_catalog(spark, sf_dir).static("events").agg(F.count(F.lit(1)).alias("n"))


AVERAGES = "SELECT user_id AS device, round(avg(value), 8) AS avg_value FROM events GROUP BY user_id"


@query(AVERAGES)
def agg_avg_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A continuous average per key: three turns of input, each emitting the keys it changed."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "agg_avg_by_key")
    journal = Journal(catalog.spark, f"{root}/averages", ["user_id"])
    land_in_turn(catalog, root, 3, lambda source: drain(
        keyed(read_live(catalog.streaming, source), ["user_id"], avg_value=F.avg("value")),
        journal, f"{root}/checkpoint", "update"))
    return _rounded(journal.latest(["user_id"]))


def _rounded(averages: DataFrame) -> DataFrame:
    return averages.select(F.col("user_id").alias("device"), F.round("avg_value", 8).alias("avg_value"))


@query(f"SELECT 'on' AS incremental, * FROM ({AVERAGES}) UNION ALL SELECT 'off', * FROM ({AVERAGES})")
def incremental_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed keys only, or everything each time: both come to the same table."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "incremental_emit")
    averages = lambda: keyed(catalog.live("all_events"), ["user_id"], avg_value=F.avg("value"))
    changes, whole = Journal(catalog.spark, f"{root}/changes", ["user_id"]), Journal(catalog.spark, f"{root}/whole")
    drain(averages(), changes, f"{root}/changes_checkpoint", "update")
    drain(averages(), whole, f"{root}/whole_checkpoint", "complete")
    on = _rounded(changes.latest(["user_id"])).select(F.lit("on").alias("incremental"), "*")
    return on.unionByName(_rounded(whole.newest_epoch()).select(F.lit("off").alias("incremental"), "*"))


@query(_windows("5 SECOND"))
def tumble_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts by event type, each emitted once its window has closed."""
    catalog = event_catalog(spark, sf_dir).add(Stream("totals", ["events"], _hourly))
    return replay(catalog.live("totals"), workspace(spark, "tumble_count"))


@query(_windows("5 SECOND"))
def tumble_count_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows the stream has closed, from the static tables."""
    events = event_catalog(spark, sf_dir).static("events")
    return closed_windows(_hourly(events), events, "ts", DELAY, "1 hour")


@query(_windows("24 HOUR"))
def wm_declare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that declares a day's delay closes a day's windows less."""
    catalog = event_catalog(spark, sf_dir).add(
        Source("slow_events", EVENT_COLUMNS, f"{sf_dir}/events.parquet", watermark=("ts", "24 hours")),
        Stream("totals", ["slow_events"], _hourly))
    return replay(catalog.live("totals"), workspace(spark, "wm_declare"))


@query(_windows(None))
def wm_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The writer moves the watermark past the data, which closes every window."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "wm_advance")
    source = Source("landed", EVENT_COLUMNS, f"{root}/landed", watermark=("ts", DELAY))
    events = catalog.static("events")
    end = events.agg(F.unix_millis(F.max("ts").cast("timestamp"))).head()[0]
    with Writer(catalog.spark, source) as writer:
        writer.write(events)
        writer.watermark(end + 2 * 3600 * 1000)
    return replay(_hourly(read_live(catalog.streaming, source)), root)


@query("SELECT date_trunc('hour', ts) AS window_start, count(*) AS event_count FROM events GROUP BY 1")
def wm_advance_runner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermarks given through the catalogue's own path, one of them inside a window that holds data: no row is added."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "wm_advance_runner")
    source = Source("landed", EVENT_COLUMNS, f"{root}/landed", watermark=("ts", DELAY))
    catalog.add(source, Stream("hours", ["landed"], lambda e: tumble(e, [], "ts", "1 hour", event_count=F.count(F.lit(1)))),
                Sink("hours_out", "hours", f"{root}/hours"))
    events = catalog.static("events")
    first, end = events.agg(F.min(F.unix_millis(F.col("ts").cast("timestamp"))), F.max(F.unix_millis(F.col("ts").cast("timestamp")))).head()
    runner = Runner(catalog, f"{root}/run")
    with Writer(catalog.spark, source) as writer:
        writer.watermark(first)
        writer.write(events)
        writer.watermark(end + 2 * 3600 * 1000)
    runner.drain()
    rows = runner.read("hours_out")
    runner.shutdown()
    return rows


@query("SELECT 'totals' AS stream, count(*) AS input_rows, "
       "epoch_ms(date_trunc('milliseconds', max(ts) - INTERVAL 5 SECOND)) AS watermark_ms FROM events")
def wm_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermark a query has reached, with the rows it read."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "wm_current")
    progress = Progress(catalog.streaming)
    done = drain(_hourly(catalog.live("events")), f"{root}/out", f"{root}/checkpoint")
    totals = progress.totals({"totals": done}).select("stream", "input_rows", "watermark_ms")
    progress.close()
    return totals


def _delayed_errors(top: int, turn: int):
    """Turn ``turn`` brings its third of the events without errors, and the errors of the third before."""
    error = F.col("event_type").eqNullSafe("error")  # an event without a type is none, and must not be lost
    return (id_range(top, 3, turn) & ~error) | (id_range(top, 3, turn - 1) & error)


def _split(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Four turns through the split, a run each, in which one batch takes all of the turn's files; ``epoch`` is the turn."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, label)
    journal, ends = Journal(catalog.spark, f"{root}/split"), []

    def take(source: Source) -> None:
        drain(split_late(read_live(catalog.streaming, source), "ts", "1 hour"), journal, f"{root}/checkpoint")
        ends.append(journal.epochs()[-1])

    land_in_turn(catalog, root, 3, take, _delayed_errors, turns=4)
    # A run may end with batches without input, in which windows close: they belong to its turn.
    return journal.batches().withColumn("epoch", sum((F.col("epoch") > end).cast("bigint") for end in ends[:-1]))


@query("""WITH landed AS (SELECT *, event_id * 3 // (SELECT max(event_id) + 1 FROM events)
  + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS epoch FROM events),
marks AS (SELECT epoch, date_trunc('milliseconds',
  max(max(ts)) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 5 SECOND) AS mark
  FROM landed GROUP BY epoch)
SELECT event_id, ts, event_type, epoch FROM landed JOIN marks USING (epoch)
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark""")
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors arrive one turn late; those whose hour has closed by then go to the side output."""
    return _split(spark, sf_dir, "late_rows").filter("late").select("row.event_id", "row.ts", "row.event_type", "epoch")


@query("""WITH landed AS (SELECT *, date_trunc('hour', ts) AS window_start, event_id * 3 // (SELECT max(event_id) + 1 FROM events)
  + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS epoch FROM events),
marks AS (SELECT epoch, date_trunc('milliseconds',
  max(max(ts)) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 5 SECOND) AS mark
  FROM landed GROUP BY epoch),
judged AS (SELECT window_start, coalesce(window_start + INTERVAL 1 HOUR <= mark, false) AS late FROM landed JOIN marks USING (epoch))
SELECT 'late' AS part, window_start, count(*) AS event_count FROM judged WHERE late GROUP BY ALL
UNION ALL SELECT 'counted', window_start, count(*) FROM judged WHERE NOT late AND window_start + INTERVAL 1 HOUR
  <= (SELECT date_trunc('milliseconds', max(ts) - INTERVAL 5 SECOND) FROM events) GROUP BY ALL""")
def late_rows_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is not late is counted, by the same operator, and every row is in one of the two."""
    parts = F.when(F.col("late"), "late").otherwise("counted")
    return _split(spark, sf_dir, "late_rows_counted").groupBy(parts.alias("part"), "window_start").agg(F.sum("event_count").alias("event_count"))


TOP = "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 20"


@query(f"SELECT * FROM ({TOP})")
def topk_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty greatest values delivered so far, kept up over three turns of input."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "topk_stream")
    best = RunningTopK(f"{root}/top", [F.col("value").desc(), F.col("event_id")], 20)
    land_in_turn(catalog, root, 3, lambda source: drain(
        read_live(catalog.streaming, source).select("event_id", "user_id", "value"), best, f"{root}/checkpoint"))
    return best.read(catalog.spark)


@query(f"SELECT * FROM ({TOP})")
def topk_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_catalog(spark, sf_dir).static("events").select("event_id", "user_id", "value")
    return top_k(events, [F.col("value").desc(), F.col("event_id")], 20)
