import pyarrow as pa
import pytest
from helpers import Feed, rows_of
from pyspark.sql import functions as F

from tidemark import (AdmissionError, Catalog, Delivery, EventError, Journal, Listener, Runner, Sink, Stream, Subscription, drain, keyed,
                      per_batch)


def test_frames_and_barriers(spark, root):
    feed = Feed(spark, root, "s", "a BIGINT")
    journal = Journal(spark, f"{root}/journal")
    with pytest.raises(EventError):
        journal.batches()
    for turn in ([(1,), (2,)], [(3,)]):
        feed.put(*turn)
        drain(feed.live(), journal, f"{root}/checkpoint")
    empty = spark.createDataFrame([], "a long")
    journal(empty, 2)
    assert rows_of(journal.frames()) == sorted([
        ("data", 0, 0, None, None, 2), ("barrier", 1, 0, 0, 0, None), ("data", 2, 1, None, None, 1),
        ("barrier", 3, 1, 1, 2, None), ("barrier", 5, 2, 2, 2, None)], key=repr)
    assert rows_of(journal.batches()) == [(1, 0), (2, 0), (3, 1)]


def test_a_batch_run_again_is_not_doubled(spark, root):
    journal = Journal(spark, f"{root}/journal")
    batch = spark.createDataFrame([(1,), (2,)], "a long")
    journal(batch, 0)
    journal(batch, 0)
    assert rows_of(journal.batches()) == [(1, 0), (2, 0)]


def test_rows_without_their_barrier_are_not_visible(spark, root):
    journal = Journal(spark, f"{root}/journal")
    batch = spark.createDataFrame([(1,)], "a long")
    journal(batch, 0)
    batch.write.parquet(f"{root}/journal/data/epoch=1")  # the job died before the barrier
    assert rows_of(journal.batches()) == [(1, 0)]


def test_subscription_resumes_lags_and_falls_behind(spark, root):
    journal = Journal(spark, f"{root}/journal")
    consumer = Subscription(journal)
    assert consumer.poll() is None and consumer.lag() == 0
    for epoch in range(4):
        journal(spark.createDataFrame([(epoch,)], "a long"), epoch)
    assert consumer.lag() == 4
    assert rows_of(consumer.poll(), "a") == rows_of(consumer.poll(), "a") == [(0,), (1,), (2,), (3,)]
    consumer.acknowledge(1)
    assert rows_of(consumer.poll(), "a") == [(2,), (3,)]
    consumer.acknowledge(3)
    assert consumer.poll() is None
    slow = Subscription(journal, 0)
    journal.expire(before=3)
    with pytest.raises(EventError, match="2 epochs expired") as error:
        slow.poll()
    assert error.value.code == 500
    with pytest.raises(EventError) as error:
        slow.poll()
    assert error.value.code == 501


class Recorder(Listener):
    def __init__(self, fail_at=None):
        self.calls, self.fail_at = [], fail_at

    def on_batch(self, batch, epoch):
        if epoch == self.fail_at:
            raise RuntimeError("listener gives up")
        self.calls.append(("batch", batch.count()))

    def on_error(self, message):
        self.calls.append(("error", "listener gives up" in message))

    def on_close(self):
        self.calls.append("close")


def test_listener_gets_batches_then_one_close(spark, root):
    feed = Feed(spark, root, "s", "a BIGINT").put((1,), (2,))
    heard = Recorder()
    delivery = Delivery(feed.live(), heard, f"{root}/checkpoint")
    assert delivery.await_stopped(60) and not delivery.is_active()
    assert heard.calls == [("batch", 2), "close"]


def test_a_throwing_listener_gets_one_error_then_one_close(spark, root):
    feed = Feed(spark, root, "s", "a BIGINT").put((1,))
    heard = Recorder(fail_at=0)
    assert Delivery(feed.live(), heard, f"{root}/checkpoint").await_stopped(60)
    assert heard.calls == [("error", True), "close"]


def test_cancel_ends_a_running_delivery(spark, root):
    feed = Feed(spark, root, "s", "a BIGINT").put((1,))
    heard = Recorder()
    delivery = Delivery(feed.live(), heard, f"{root}/checkpoint", every="200 milliseconds")
    delivery.query.processAllAvailable()
    assert delivery.is_active()
    delivery.cancel()
    assert delivery.await_stopped(60)
    assert heard.calls == [("batch", 1), "close"]


def catalogue(spark, feed, root, mode="append"):
    return Catalog(spark).add(
        feed.source, Stream("counts", [feed.source.name], lambda s: s if mode == "append" else keyed(s, ["a"], n=F.count(F.lit(1)))),
        Sink("out", "counts", f"{root}/out", mode, ("a",)))


def test_checkpoint_ids_grow_and_no_row_comes_twice(spark, root):
    feed = Feed(spark, root, "s", "a BIGINT").put((1,))
    first = Runner(catalogue(spark, feed, root), f"{root}/run")
    assert first.checkpoint() < first.checkpoint()
    feed.put((2,))
    again = Runner(catalogue(spark, feed, root), f"{root}/run")  # as after a restart
    assert again.checkpoint() == 3
    assert rows_of(again.read("out")) == [(1,), (2,)]
    assert rows_of(again.metrics(), "stream", "input_rows") == [("out", 2)]
    assert rows_of(again.source_metrics()) == [("out", "s", 2)]


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_update_and_complete_sinks_converge(spark, root, mode):
    feed = Feed(spark, root, "s", "a BIGINT").put((1,), (1,), (2,))
    runner = Runner(catalogue(spark, feed, root, mode), f"{root}/run")
    runner.drain()
    feed.put((2,), (3,))
    runner.drain()
    assert rows_of(runner.read("out")) == [(1, 2), (2, 2), (3, 1)]
    written = Journal(spark, f"{root}/out").batches(0, 1).count()
    assert written == (2 if mode == "update" else 3)


def test_checkpoint_is_refused_without_folder_or_stream(spark, root):
    feed = Feed(spark, root, "s", "a BIGINT").put((1,))
    with pytest.raises(EventError, match="not enabled") as error:
        Runner(catalogue(spark, feed, root)).checkpoint()
    assert error.value.code == 900
    with pytest.raises(EventError) as error:
        Runner(Catalog(spark).add(feed.source), f"{root}/run").checkpoint()
    assert error.value.code == 900


def test_after_shutdown_every_call_fails(spark, root):
    feed = Feed(spark, root, "s", "a BIGINT").put((1,))
    runner = Runner(catalogue(spark, feed, root), f"{root}/run")
    running = runner.start(every="200 milliseconds")
    running["out"].processAllAvailable()
    runner.shutdown()
    assert not running["out"].isActive
    for call in (runner.start, runner.checkpoint, lambda: runner.read("out")):
        with pytest.raises(EventError) as error:
            call()
        assert error.value.code == 901


def test_bounded_batches_hold_every_row_once(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    sizes = per_batch(spark.range(100).coalesce(3), lambda b: pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]), "n long")
    got = [r["n"] for r in sizes.collect()]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert sum(got) == 100 and max(got) <= 7


def test_a_failing_stream_raises(spark, root):
    feed = Feed(spark, root, "s", "a BIGINT").put((1,))
    with pytest.raises(Exception, match="boom"):
        drain(feed.live().withColumn("a", F.raise_error(F.lit("boom")).cast("long")), f"{root}/out", f"{root}/checkpoint")


def test_checkpoint_of_running_sinks_does_not_wait_for_input_to_end(spark, root):
    feed = Feed(spark, root, "s", "a BIGINT").put((1,))
    runner = Runner(catalogue(spark, feed, root), f"{root}/run")
    runner.start(every="200 milliseconds")["out"].processAllAvailable()
    first = runner.checkpoint()
    feed.put((2,))
    assert runner.checkpoint() == first + 1
    runner.queries["out"].processAllAvailable()
    runner.shutdown()


def test_a_refused_stream_leaves_no_listener_behind(spark, root):
    frame = Feed(spark, root, "s", "a BIGINT").put((1,)).live()
    listeners = lambda: len(frame.sparkSession.streams._jsqm.listListeners())
    before = listeners()
    with pytest.raises(AdmissionError):
        Delivery(frame.orderBy("a"), Recorder(), f"{root}/checkpoint")
    assert listeners() == before


def test_a_compacted_base_keeps_every_key(spark, root):
    journal = Journal(spark, f"{root}/journal")
    for epoch, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 1)]]):
        journal(spark.createDataFrame(rows, "k string, n int"), epoch)
        if epoch == 1:
            with pytest.raises(EventError, match="compact first"):
                journal.expire(1, keyed=True)
            journal.compact(["k"])
            journal.expire(2, keyed=True)
            assert rows_of(journal.latest(["k"])) == [("a", 2), ("b", 1)]
    assert rows_of(journal.latest(["k"])) == [("a", 2), ("b", 1), ("c", 1)]
    journal.compact(["k"])
    journal.expire(3, keyed=True)
    assert rows_of(journal.latest(["k"])) == [("a", 2), ("b", 1), ("c", 1)]


def test_a_named_consumer_goes_on_where_it_ended(spark, root):
    journal = Journal(spark, f"{root}/journal")
    for epoch in range(3):
        journal(spark.createDataFrame([(epoch,)], "a long"), epoch)
    Subscription(journal, name="one").acknowledge(0)
    again = Subscription(journal, name="one")
    assert again.lag() == 2 and rows_of(again.poll(), "a") == [(1,), (2,)]
    assert Subscription(journal, name="two").lag() == Subscription(journal).lag() == 3
    again.acknowledge(2)
    again.acknowledge(1)
    assert Subscription(journal, name="one").poll() is None
    with pytest.raises(ValueError, match="name"):
        Subscription(journal, name="../one")


def test_a_consumer_lost_before_the_acknowledgement_gets_its_epoch_again(spark, root):
    journal, seen = Journal(spark, f"{root}/journal"), []

    def write(rows, epoch):
        seen.append((epoch, rows_of(rows)))
        if len(seen) == 2:
            raise RuntimeError("lost")
    for epoch, rows in enumerate([[(1,)], [(2,)], [], [(3,)]]):
        journal(spark.createDataFrame(rows, "a long"), epoch)
    with pytest.raises(RuntimeError):
        Subscription(journal, name="c").consume(write)
    assert Subscription(journal, name="c").consume(write) == 3
    assert seen == [(0, [(1,)]), (1, [(2,)]), (1, [(2,)]), (3, [(3,)])]
    assert Subscription(journal, name="c").consume(write) == 0


def test_reading_an_updated_sink_costs_the_same_after_fifty_batches(spark, root):
    journal = Journal(spark, f"{root}/journal", ["k"], compact_every=8)
    files = []
    for epoch in range(50):
        journal(spark.createDataFrame([(epoch % 3, epoch)], "k int, n int").coalesce(1), epoch)
        files.append(len(journal.latest(["k"]).inputFiles()))
    assert max(files) <= 12 and max(files[-8:]) <= max(files[:16])
    assert rows_of(journal.latest(["k"])) == [(0, 48), (1, 49), (2, 47)]
    # An earlier state comes from the last base before it, or from the epochs themselves.
    assert rows_of(journal.latest(["k"], 45)) == [(0, 45), (1, 43), (2, 44)]
    assert rows_of(journal.latest(["k"], 4)) == [(0, 3), (1, 4), (2, 2)]
    journal.expire(40, keyed=True)
    assert rows_of(journal.latest(["k"])) == [(0, 48), (1, 49), (2, 47)]
    with pytest.raises(EventError, match="expired") as error:
        journal.latest(["k"], 4)
    assert error.value.code == 500


@pytest.mark.parametrize("mode", ["append", "update", "complete"])
def test_a_sink_read_as_of_a_checkpoint(spark, root, mode):
    feed = Feed(spark, root, "s", "a BIGINT").put((1,), (2,))
    runner = Runner(catalogue(spark, feed, root, mode), f"{root}/run")
    first = runner.checkpoint()
    feed.put((2,))
    runner.drain()
    again = Runner(catalogue(spark, feed, root, mode), f"{root}/run")
    second = again.checkpoint()
    before, after = ([(1,), (2,)], [(1,), (2,), (2,)]) if mode == "append" else ([(1, 1), (2, 1)], [(1, 1), (2, 2)])
    assert rows_of(again.read("out", first)) == before
    assert rows_of(again.read("out", second)) == rows_of(again.read("out")) == after
    with pytest.raises(EventError, match="no checkpoint") as error:
        again.read("out", 99)
    assert error.value.code == 900


def test_totals_by_source_over_a_restart_in_bounded_memory(spark, root):
    one, two = (Feed(spark, root, name, "a BIGINT") for name in ("one", "two"))
    def runner():
        return Runner(Catalog(spark).add(one.source, two.source, Stream("both", ["one", "two"], lambda l, r: l.unionByName(r)),
                                         Sink("out", "both", f"{root}/out")), f"{root}/run")
    for turn in range(3):
        one.put((turn,))
        two.put((turn,), (turn,))
        current = runner()
        current.drain()
        assert rows_of(current.source_metrics()) == [("out", "one", turn + 1), ("out", "two", 2 * turn + 2)]
        assert len(current._progress._totals) == 1
        current.shutdown()


def test_working_folders_are_removed_by_their_owner(spark, tmp_path, monkeypatch):
    from tidemark import clear_workspaces, session
    monkeypatch.setattr(session, "_application_folder", lambda _: str(tmp_path))
    made = session.workspace(spark, "a")
    spark.range(1).write.parquet(made)
    assert made.startswith(str(tmp_path)) and session.exists(spark, made)
    clear_workspaces(spark)
    assert not session.exists(spark, made)
