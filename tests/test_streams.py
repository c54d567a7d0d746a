import random
from dataclasses import replace
from datetime import datetime

import pytest
from helpers import Feed, at, frame, rows_of
from pyspark.sql import functions as F

from tidemark import (AdmissionError, Catalog, Journal, Runner, RunningTopK, Sink, Stream, check_stream_plan, closed_windows,
                      current_watermark, drain, interval_join, keyed, replay, split_late, sql_stream, top_k, tumble)
from tidemark.functions.event_time import seconds_of
from tidemark.sources.definitions import read_live, read_static
from tidemark.streaming.run import Progress

COLUMNS = "id BIGINT, symbol VARCHAR, ts TIMESTAMP"
EPOCH = datetime(1970, 1, 1)


def millis(moment):
    return int((moment - EPOCH).total_seconds() * 1000)


def counts(events):
    return tumble(events, ["symbol"], "ts", "10 seconds", n=F.count_if(F.col("id").isNotNull()))


def test_windows_appear_once_closed(spark, root):
    feed = Feed(spark, root, "trades", COLUMNS, "ts").put((1, "A", at(1)), (2, "A", at(9.999)), (3, "B", at(10)), (4, "A", at(14.999)))
    assert rows_of(replay(counts(feed.live()), root)) == []
    feed.put((5, "A", at(15)))  # the watermark reaches 10:00:10 exactly
    assert rows_of(replay(counts(feed.live()), root)) == [("A", at(0), 2)]


def test_writer_watermark_closes_windows_without_data(spark, root):
    feed = Feed(spark, root, "trades", COLUMNS, "ts").put((1, "A", at(1)), (2, "B", at(11)))
    live = lambda: counts(feed.live(heartbeats=True))
    assert rows_of(replay(live(), root)) == []
    feed.writer.watermark(millis(at(19)))
    assert rows_of(replay(live(), root)) == [("A", at(0), 1)]
    feed.writer.watermark(millis(at(20)))
    query = drain(live(), f"{root}/out", f"{root}/checkpoint")
    assert rows_of(spark.read.parquet(f"{root}/out")) == [("A", at(0), 1), ("B", at(10), 1)]
    assert current_watermark(query) == millis(at(20))


def test_heartbeats_do_not_reach_streams_that_did_not_ask(spark, root):
    feed = Feed(spark, root, "trades", COLUMNS, "ts").put((1, "A", at(1)))
    feed.writer.watermark(millis(at(60)))
    assert rows_of(replay(feed.live(), root)) == [(1, "A", at(1))]
    assert rows_of(read_static(spark, feed.source)) == [(1, "A", at(1))]


def test_watermarks_through_catalog_and_runner(spark, root):
    feed = Feed(spark, root, "trades", COLUMNS, "ts").put((1, "A", at(1)), (2, "B", at(12)))
    feed.writer.watermark(millis(at(2)))  # inside the first window: it adds no row
    catalog = Catalog(spark).add(
        feed.source, Stream("all", ["trades"], lambda t: tumble(t, [], "ts", "10 seconds", n=F.count(F.lit(1)))),
        Stream("large", ["trades"], lambda t: tumble(t.filter("id > 1"), ["symbol"], "ts", "10 seconds", n=F.count(F.lit(1)))),
        Stream("ids", ["trades"], lambda t: t.select("id")),
        *[Sink(f"{n}_out", n, f"{root}/{n}") for n in ("all", "large", "ids")])
    runner = Runner(catalog, f"{root}/run")
    runner.drain()
    assert rows_of(runner.read("all_out")) == []
    feed.writer.watermark(millis(at(3600)))
    runner.drain()
    assert rows_of(runner.read("all_out")) == [(at(0), 1), (at(10), 1)]
    assert rows_of(runner.read("large_out")) == [("B", at(10), 1)]
    assert rows_of(runner.read("ids_out")) == [(1,), (2,)]


@pytest.mark.parametrize("how, expected", [("left", [(1, 5), (2, None)]), ("full", [(1, 5), (2, None), (None, 6)]), ("anti", [(2,)])])
def test_watermarks_make_rows_without_partner_final(spark, root, how, expected):
    left = Feed(spark, root, "l", "l_id BIGINT, l_key BIGINT, l_ts TIMESTAMP", "l_ts").put((1, 1, at(0)), (2, 2, at(1)))
    right = Feed(spark, root, "r", "r_id BIGINT, r_key BIGINT, r_ts TIMESTAMP", "r_ts").put((5, 1, at(2)), (6, 3, at(2)))
    for feed in (left, right):
        feed.writer.watermark(millis(at(600)))
    joined = interval_join(left.live(), right.live(), [("l_key", "r_key")], "l_ts", "r_ts", "10 seconds", how)
    assert rows_of(replay(joined, root), *(("l_id",) if how == "anti" else ("l_id", "r_id"))) == sorted(expected, key=repr)


def test_totals_are_whole_over_many_batches(spark, root):
    feed = Feed(spark, root, "trades", COLUMNS)
    frame(spark, [(i, "A", at(i)) for i in range(105)], feed.ddl).repartitionByRange(105, "id").write.parquet(f"{feed.source.path}/many")
    source = replace(feed.source, options={"maxFilesPerTrigger": "1"})
    progress = Progress(feed.streaming)
    query = drain(read_live(feed.streaming, source), f"{root}/out", f"{root}/checkpoint")
    got = progress.totals({"s": query}).head()
    progress.close()
    assert (got.input_rows, got.batches >= 101, len(query.recentProgress) <= 100) == (105, True, True)


def test_late_rows_are_what_spark_drops(spark, root):
    """The side output and Spark's own counter agree, and nothing is lost between late and counted rows."""
    feed = Feed(spark, root, "trades", COLUMNS, "ts")
    journal = Journal(spark, f"{root}/split")
    dropped = 0
    turns = [[(1, "A", at(1)), (2, "A", at(3))], [(3, "A", at(20))], [(4, "A", at(4)), (5, "A", at(21))],
             [(6, "A", at(5)), (7, "B", at(40)), (8, "C", at(12))], [(9, "A", at(6)), (10, "A", at(29))]]
    for turn in turns:
        feed.put(*turn)
        drain(split_late(feed.live(), "ts", "10 seconds"), journal, f"{root}/split_checkpoint")
        query = drain(counts(feed.live()), f"{root}/out", f"{root}/checkpoint")
        dropped += sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    late, counted = journal.batches().filter("late"), journal.batches().filter("NOT late")
    assert rows_of(late, "row.id") == [(10,), (4,), (6,), (9,)]
    assert dropped == 4
    assert rows_of(counted.groupBy("window_start").agg(F.sum("event_count"))) == [(at(0), 2), (at(10), 1), (at(20), 2)]
    assert rows_of(spark.read.parquet(f"{root}/out")) == [("A", at(0), 2), ("A", at(20), 2), ("C", at(10), 1)]


def test_late_and_counted_rows_make_up_the_input_back_to_back(spark, root):
    """Many batches in one run, with late rows in most of them."""
    rng = random.Random(6)
    feed = Feed(spark, root, "trades", COLUMNS, "ts")
    total = 0
    for turn in range(8):
        rows = [(i, "A", at(max(0, turn * 20 + rng.randint(-40, 20)))) for i in range(12)]
        total += len(rows)
        feed.put(*rows)
    feed.put((99, "A", at(1000)))
    feed.source = replace(feed.source, options={"maxFilesPerTrigger": "1"})
    journal = Journal(spark, f"{root}/split")
    drain(split_late(feed.live(), "ts", "10 seconds", parts=3), journal, f"{root}/checkpoint")
    rows = journal.batches()
    assert rows.agg(F.sum("event_count")).head()[0] == total
    assert 0 < rows.filter("late").count() < total


@pytest.mark.parametrize("seed", range(2))
def test_any_ordered_split_replays_to_the_batch_result(spark, root, seed):
    rng = random.Random(seed)
    rows = sorted(((i, rng.choice("ABC"), at(rng.randrange(200))) for i in range(60)), key=lambda r: r[2])
    feed = Feed(spark, root, "trades", COLUMNS, "ts")
    cuts = sorted(rng.sample(range(1, 60), 2))
    for first, last in zip([0, *cuts], [*cuts, 60]):
        feed.put(*rows[first:last])
        replay(counts(feed.live(heartbeats=True)), root)
    events = read_static(spark, feed.source)
    closed = closed_windows(counts(events), events, "ts", "5 seconds", "10 seconds")
    assert rows_of(spark.read.parquet(f"{root}/out")) == rows_of(closed)
    feed.writer.watermark(millis(at(1000)))
    replay(counts(feed.live(heartbeats=True)), root)
    assert rows_of(spark.read.parquet(f"{root}/out")) == rows_of(counts(events))


def test_top_k(spark, root):
    feed = Feed(spark, root, "trades", "id BIGINT, price DOUBLE")
    order = [F.col("price").desc(), F.col("id")]
    best = RunningTopK(f"{root}/top", order, 2)
    feed.put((1, 5.0), (2, 9.0), (3, 1.0))
    drain(feed.live(), best, f"{root}/checkpoint")
    assert rows_of(best.read(spark)) == [(1, 5.0), (2, 9.0)]
    feed.put((4, 9.0), (5, 0.0))
    drain(feed.live(), best, f"{root}/checkpoint")
    assert rows_of(best.read(spark)) == [(2, 9.0), (4, 9.0)]
    with pytest.raises(AdmissionError):
        top_k(read_static(spark, feed.source), order, 0)


def test_streams_given_as_sql(spark, root):
    """A bounded join and a tumbling count, both given as SQL text, over two sources with watermarks."""
    calls = Feed(spark, root, "calls", "call BIGINT NOT NULL, ship VARCHAR, tons DOUBLE, at TIMESTAMP", "at")
    visits = Feed(spark, root, "visits", "visit BIGINT NOT NULL, vessel VARCHAR, loaded DOUBLE, seen TIMESTAMP", "seen")
    catalog = Catalog(spark).add(
        calls.source, visits.source,
        sql_stream("met", ["calls", "visits"], """
            SELECT call, visit, tons + loaded AS weight FROM visits JOIN calls
            ON vessel = ship AND seen BETWEEN at AND at + INTERVAL 8 SECONDS"""),
        sql_stream("busy", ["calls"], """
            SELECT ship, window.start AS since, sum(tons) AS total FROM calls GROUP BY ship, window(at, '20 seconds')"""),
        Sink("met_out", "met", f"{root}/met"), Sink("busy_out", "busy", f"{root}/busy"))
    calls.put((31, "Alma", 3.0, at(5)), (32, "Alma", 4.0, at(61)))
    visits.put((7, "Alma", 0.5, at(4)), (8, "Alma", 1.5, at(13)), (9, "Alma", 1.0, at(14)))
    runner = Runner(catalog, f"{root}/run")
    runner.drain()
    assert rows_of(runner.read("met_out")) == [(31, 8, 4.5)]
    assert rows_of(runner.read("busy_out")) == [("Alma", at(0), 3.0)]
    assert rows_of(catalog.static("busy")) == [("Alma", at(0), 3.0), ("Alma", at(60), 4.0)]
    assert rows_of(catalog.describe("busy"), "field", "type_name") == [("ship", "Utf8"), ("since", "Timestamp(us)"), ("total", "Float64")]


# Admission.

def two(spark, root, watermarks=True):
    return [Feed(spark, root, n, f"{n}_key BIGINT, {n}_ts TIMESTAMP", f"{n}_ts" if watermarks else None).put((1, at(0))).live()
            for n in ("l", "r")]


RANGE = "r_ts BETWEEN l_ts AND l_ts + INTERVAL '10' SECOND"


def test_bounded_join_is_admitted(spark, root):
    left, right = two(spark, root)
    check_stream_plan(left.join(right, F.expr(f"l_key = r_key AND {RANGE}")))
    check_stream_plan(interval_join(left, right, [("l_key", "r_key")], "l_ts", "r_ts", "10 seconds", "full"))
    pairs = interval_join(left, right, [("l_key", "r_key")], "l_ts", "r_ts", "10 seconds")
    check_stream_plan(tumble(pairs, ["l_key"], "r_ts", "1 hour", n=F.count("r_key")))
    third = Feed(spark, root, "q", "q_key BIGINT, q_ts TIMESTAMP", "q_ts").live()
    check_stream_plan(interval_join(pairs, third, [("r_key", "q_key")], "r_ts", "q_ts", "10 seconds"))


@pytest.mark.parametrize("condition, message", [
    (None, "cross"), ("l_key = r_key", "time range"), ("l_key = r_key AND r_ts >= l_ts", "both ends"),
    (RANGE, "equality"), ("l_key < r_key", "equality")])
def test_unbounded_joins_are_refused(spark, root, condition, message):
    left, right = two(spark, root)
    joined = left.crossJoin(right) if condition is None else left.join(right, F.expr(condition))
    with pytest.raises(AdmissionError, match=message):
        check_stream_plan(joined)


def test_join_without_watermarks_is_refused(spark, root):
    left, right = two(spark, root, watermarks=False)
    with pytest.raises(AdmissionError, match="watermark"):
        check_stream_plan(left.join(right, F.expr(f"l_key = r_key AND {RANGE}")))


def test_sort_without_limit_is_refused(spark, root):
    left, _ = two(spark, root)
    with pytest.raises(AdmissionError, match="LIMIT"):
        check_stream_plan(left.orderBy("l_ts"))
    check_stream_plan(keyed(left, ["l_key"], n=F.count(F.lit(1))).orderBy("n").limit(3))


def test_joins_with_static_tables_are_not_stream_joins(spark, root):
    left, _ = two(spark, root)
    check_stream_plan(left.join(spark.range(3).withColumnRenamed("id", "l_key"), "l_key"))


@pytest.mark.parametrize("span, seconds", [("10 seconds", 10), ("1 minute", 60), ("6 hours", 21600), ("2 days", 172800)])
def test_spans(span, seconds):
    assert seconds_of(span) == seconds
