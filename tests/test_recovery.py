"""Batches that run again and queries that die half-way: nothing is lost, nothing is doubled."""

import pytest
from helpers import Feed, at, rows_of
from pyspark.sql import functions as F

from tidemark import Journal, RunningTopK, drain, keyed, split_late, tumble


def twice(target):
    return lambda batch, epoch: (target(batch, epoch), target(batch, epoch))


class DiesOnce:
    """A sink that does its work and then fails, the first time, as when a driver is lost before the commit."""

    def __init__(self, target):
        self.target, self.died = target, False

    def __call__(self, batch, epoch):
        self.target(batch, epoch)
        if not self.died:
            self.died = True
            raise RuntimeError("lost before the commit")


def test_top_k_repeats_a_batch(spark, root):
    feed = Feed(spark, root, "s", "id BIGINT, price DOUBLE").put((1, 5.0), (2, 9.0), (3, 1.0))
    best = RunningTopK(f"{root}/top", [F.col("price").desc()], 2)
    drain(feed.live(), twice(best), f"{root}/checkpoint")
    feed.put((4, 7.0))
    drain(feed.live(), twice(best), f"{root}/checkpoint")
    assert rows_of(best.read(spark)) == [(2, 9.0), (4, 7.0)]


def test_late_split_repeats_a_batch_and_keeps_rows_without_time(spark, root):
    feed = Feed(spark, root, "s", "id BIGINT, ts TIMESTAMP", "ts")
    journal = Journal(spark, f"{root}/split")
    for turn in ([(1, at(1)), (2, at(40))], [(3, at(2)), (4, None), (5, at(41)), (6, at(90))]):
        feed.put(*turn)
        drain(split_late(feed.live(), "ts", "10 seconds", parts=2), twice(journal), f"{root}/checkpoint")
    assert rows_of(journal.batches().filter("late"), "row.id", "window_start", "event_count") == [(3, at(0), 1), (4, None, 1)]
    counted = journal.batches().filter("NOT late").groupBy("window_start").agg(F.sum("event_count"))
    assert rows_of(counted) == [(at(0), 1), (at(40), 2)]


def test_a_sink_that_dies_after_writing_is_not_doubled(spark, root):
    feed = Feed(spark, root, "s", "a BIGINT").put((1,), (2,))
    journal = Journal(spark, f"{root}/journal")
    sink = DiesOnce(journal)
    with pytest.raises(Exception, match="lost before the commit"):
        drain(feed.live(), sink, f"{root}/checkpoint")
    feed.put((3,))
    drain(feed.live(), sink, f"{root}/checkpoint")
    assert rows_of(journal.batches(), "a") == [(1,), (2,), (3,)]


def test_state_survives_a_failed_batch(spark, root):
    """A keyed count goes on from the last committed state."""
    feed = Feed(spark, root, "s", "a BIGINT").put((1,), (1,))
    journal = Journal(spark, f"{root}/journal")
    counts = lambda: keyed(feed.live(), ["a"], n=F.count(F.lit(1)))
    drain(counts(), journal, f"{root}/checkpoint", "update")
    feed.put((1,))
    sink = DiesOnce(journal)
    for _ in range(2):
        try:
            drain(counts(), sink, f"{root}/checkpoint", "update")
        except Exception as error:
            assert "lost before the commit" in str(error)
    assert rows_of(journal.latest(["a"])) == [(1, 3)]


def test_a_window_is_emitted_once_across_restarts(spark, root):
    feed = Feed(spark, root, "s", "a BIGINT, ts TIMESTAMP", "ts")
    for second in (1, 12, 30, 31):
        feed.put((1, at(second)))
        drain(tumble(feed.live(), ["a"], "ts", "10 seconds", n=F.count("a")), f"{root}/out", f"{root}/checkpoint")
    assert rows_of(spark.read.parquet(f"{root}/out")) == [(1, at(0), 1), (1, at(10), 1)]


def test_every_type_survives_the_round_trip(spark, root):
    feed = Feed(spark, root, "s", "i INT, l BIGINT, f FLOAT, d DOUBLE, s VARCHAR, b BINARY, o BOOLEAN, t TIMESTAMP")
    rows = [(1, 2 ** 53 + 1, 0.5, 0.1, "é", bytearray(b"\x00\xff"), True, at(0.000001)), (None,) * 8]
    feed.put(*rows)
    drain(feed.live(), f"{root}/out", f"{root}/checkpoint")
    assert rows_of(spark.read.parquet(f"{root}/out")) == sorted(rows, key=repr)
