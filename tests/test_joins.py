import random
from datetime import datetime, timedelta

import pytest
from helpers import BASE, Feed, at, brute_asof, brute_interval, frame, rows_of
from pyspark.sql import functions as F

from tidemark import AdmissionError, Journal, asof_join, asof_stream, drain, interval_join, replay
from tidemark.operators.stateful import kept_state

LEFT, RIGHT = "l_key bigint, l_ts timestamp_ntz, l_id bigint", "r_key bigint, r_ts timestamp_ntz, r_id bigint"
ON = [("l_key", "r_key")]


def crafted(seed, n=120, keys=4, span=400):
    rng = random.Random(seed)
    def side():
        return [(rng.choice([None, *[1] * 4, *range(keys)]), at(rng.randrange(span) + rng.choice([0, 0, 0.5, 0.000001])), i)
                for i in range(n)]
    return side(), side()


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "anti"])
def test_interval_join_equals_brute_force(spark, how, seed):
    left, right = crafted(seed)
    pairs = brute_interval(left, right, 10)
    lonely_left = {(i, None) for i in range(len(left))} - {(i, None) for i, _ in pairs}
    lonely_right = {(None, j) for j in range(len(right))} - {(None, j) for _, j in pairs}
    expected = {"inner": pairs, "left": pairs | lonely_left, "right": pairs | lonely_right,
                "full": pairs | lonely_left | lonely_right, "anti": {(i,) for i, _ in lonely_left}}[how]
    got = interval_join(frame(spark, left, LEFT), frame(spark, right, RIGHT), ON, "l_ts", "r_ts", "10 seconds", how)
    assert rows_of(got, *(["l_id"] if how == "anti" else ["l_id", "r_id"])) == sorted(expected, key=repr)


def test_interval_ends_are_inclusive_and_direction_matters(spark):
    left = [(1, at(20), 0)]
    right = [(1, at(20), 0), (1, at(30), 1), (1, at(30.000001), 2), (1, at(19.999999), 3)]
    got = interval_join(frame(spark, left, LEFT), frame(spark, right, RIGHT), ON, "l_ts", "r_ts", "10 seconds")
    assert rows_of(got, "r_id") == [(0,), (1,)]


def test_rows_before_1970_and_without_time(spark):
    left = [(1, BASE.replace(year=1950), 0), (1, None, 1)]
    right = [(1, BASE.replace(year=1950) + timedelta(seconds=9), 0), (1, None, 1)]
    got = interval_join(frame(spark, left, LEFT), frame(spark, right, RIGHT), ON, "l_ts", "r_ts", "10 seconds", "full")
    assert rows_of(got, "l_id", "r_id") == [(0, 0), (1, None), (None, 1)]


@pytest.mark.parametrize("how, salts", [("inner", (3, 2)), ("left", (4, 1)), ("anti", (3, 1)), ("right", (1, 3))])
def test_salting_changes_nothing(spark, how, salts):
    left, right = crafted(7)
    join = lambda **more: rows_of(interval_join(frame(spark, left, LEFT), frame(spark, right, RIGHT), ON, "l_ts", "r_ts",
                                                "10 seconds", how, **more))
    assert join(salts=salts) == join()


def test_hot_key_is_spread_by_time(spark):
    hot = frame(spark, [(1, at(i * 60), i) for i in range(500)], LEFT)
    other = frame(spark, [(1, at(i * 60 + 1), i) for i in range(500)], RIGHT)
    joined = interval_join(hot, other, ON, "l_ts", "r_ts", "10 seconds")
    assert joined.count() == 500
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "_left_bucket" in plan


@pytest.mark.parametrize("left, right, on, message", [
    (LEFT, RIGHT, [], "equality key"),
    (LEFT, RIGHT.replace("r_key bigint", "r_key string"), ON, "one type"),
    (LEFT.replace("l_key bigint", "l_key double"), RIGHT.replace("r_key bigint", "r_key double"), ON, "string or bigint"),
    (LEFT, RIGHT.replace("r_id", "l_id"), ON, "alias"),
])
def test_join_rules(spark, left, right, on, message):
    with pytest.raises(AdmissionError, match=message):
        interval_join(spark.createDataFrame([], left), spark.createDataFrame([], right), on, "l_ts", "r_ts", "10 seconds")


@pytest.mark.parametrize("bound", ["0 seconds", "-1 seconds"])
def test_bounds_must_be_positive(spark, bound):
    with pytest.raises(ValueError, match="positive"):
        interval_join(spark.createDataFrame([], LEFT), spark.createDataFrame([], RIGHT), ON, "l_ts", "r_ts", bound)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("retention", [None, 20])
@pytest.mark.parametrize("slice", ["7 seconds", "1 hour"])
def test_asof_equals_brute_force(spark, seed, retention, slice):
    left, right = crafted(seed, keys=3)
    got = asof_join(frame(spark, left, LEFT), frame(spark, right, RIGHT), ON, "l_ts", "r_ts", "r_id",
                    f"{retention} seconds" if retention else None, slice)
    expected = brute_asof([r[:2] for r in left], right, retention)
    assert rows_of(got, "l_id", "r_id") == sorted(((r[2], e) for r, e in zip(left, expected)), key=repr)


def test_asof_ties_and_equal_time(spark):
    left = [(1, at(10), 0), (None, at(10), 1)]
    right = [(1, at(10), 5), (1, at(10), 7), (1, at(10), 6), (1, at(11), 9), (None, at(9), 1)]
    got = asof_join(frame(spark, left, LEFT), frame(spark, right, RIGHT), ON, "l_ts", "r_ts", "r_id")
    assert rows_of(got, "l_id", "r_id") == [(0, 7), (1, None)]


@pytest.mark.parametrize("how", ["left", "full", "anti", "asof"])
def test_a_key_with_a_third_of_the_rows_is_cut_by_time(spark, how):
    """No task sorts more than a slice's share of the hot key, and building the plan runs no job."""
    side = lambda letter: spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias(f"{letter}_key"),
        (F.expr("TIMESTAMP_NTZ '2026-08-29 10:00:00'") + F.expr("make_dt_interval(0, 0, 0, id)")).alias(f"{letter}_ts"), F.col("id").alias(f"{letter}_id"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    if how == "asof":
        joined = asof_join(side("l"), side("r"), ON, "l_ts", "r_ts", "r_id", slice="10 minutes")
    else:
        joined = interval_join(side("l"), side("r"), ON, "l_ts", "r_ts", "10 seconds", how)
    assert not tracker.getJobIdsForGroup("plan")
    spark.sparkContext.setJobGroup("", "")
    # Each hot row meets itself and the up to three after it within ten seconds; each other row itself.
    assert joined.count() == {"anti": 0, "asof": 30000}.get(how, 20000 + sum(min(4, 10000 - i) for i in range(10000)))
    slices = side("l").groupBy("l_key", F.window(F.col("l_ts").cast("timestamp"), "10 minutes")).count().agg(F.max("count")).head()[0]
    assert slices <= 200


# Streams.

def feeds(spark, root, delay="5 seconds"):
    return (Feed(spark, root, "l", "l_key BIGINT, l_ts TIMESTAMP, l_id BIGINT", "l_ts", delay),
            Feed(spark, root, "r", "r_key BIGINT, r_ts TIMESTAMP, r_id BIGINT", "r_ts", delay))


@pytest.mark.parametrize("salts", [(1, 1), (2, 3)])
@pytest.mark.parametrize("how", ["left", "right", "full", "anti"])
def test_unmatched_rows_wait_for_the_other_side(spark, root, how, salts):
    """Nothing early; a row exactly at the watermark is held back; NULL keys do not pair up."""
    left, right = feeds(spark, root)
    build = lambda: interval_join(left.live(), right.live(), ON, "l_ts", "r_ts", "10 seconds", how, salts)
    columns = ["l_id"] if how == "anti" else ["l_id", "r_id"]

    def seen():
        return rows_of(replay(build(), root), *columns)
    # Left watermark 95, right watermark 25: the smaller counts.
    left.put((1, at(0), 1), (2, at(1), 2), (5, at(15), 6), (1, at(15.5), 3), (3, at(14.999), 4), (None, at(2), 5), (9, at(100), 9))
    right.put((1, at(5), 1), (4, at(24.999), 2), (4, at(25), 3), (None, at(3), 4), (8, at(30), 9))
    lefts, rights = [(2, None), (4, None), (5, None)], [(None, 2), (None, 4)]
    expected = {"left": [(1, 1), *lefts], "right": [(1, 1), *rights], "full": [(1, 1), *lefts, *rights],
                "anti": [(i,) for i, _ in lefts]}[how]
    assert seen() == sorted(expected, key=repr)
    right.put((1, at(25.5), 7))  # exactly at the end of left row 3's interval
    assert ((3, 7) in seen()) == (how != "anti")


def drained(frame, root, twice=False):
    """The output so far of an as-of stream, and its query."""
    journal = Journal(frame.sparkSession, f"{root}/asof")
    target = (lambda batch, epoch: (journal(batch, epoch), journal(batch, epoch))) if twice else journal
    return journal, drain(frame, target, f"{root}/checkpoint")


@pytest.mark.parametrize("how", ["left", "right", "full", "anti"])
def test_salted_streams_with_a_hot_key_equal_brute_force(spark, root, how):
    """A third of the rows on one key, and repeated rows: both sides spread."""
    rng = random.Random(9)
    side = lambda: [(rng.choice([1, *range(2, 7), None]) if i % 3 else 1, at(rng.randrange(200)), i // 2) for i in range(90)]
    left_rows, right_rows = side(), side()
    left_rows += left_rows[:15]
    left, right = feeds(spark, root)
    left.put(*left_rows, (99, at(1000), 1000))
    right.put(*right_rows, (98, at(1000), 1000))
    got = replay(interval_join(left.live(), right.live(), ON, "l_ts", "r_ts", "4 seconds", how, (3, 2)), root)
    pairs = brute_interval(left_rows, right_rows, 4)
    lonely_left = [(r[2],) if how == "anti" else (r[2], None) for i, r in enumerate(left_rows) if all(p[0] != i for p in pairs)]
    lonely_right = [(None, r[2]) for j, r in enumerate(right_rows) if all(p[1] != j for p in pairs)]
    matched = [(left_rows[i][2], right_rows[j][2]) for i, j in pairs]
    expected = {"left": matched + lonely_left, "right": matched + lonely_right, "full": matched + lonely_left + lonely_right, "anti": lonely_left}[how]
    assert rows_of(got, *(["l_id"] if how == "anti" else ["l_id", "r_id"])) == sorted(expected, key=repr)


@pytest.mark.parametrize("slices,salts", [(1, 1), (3, 2)])
def test_asof_stream_over_batches_equals_batch(spark, root, slices, salts):
    """Rows split over turns in time order, with ties, NULL keys and a retention: as the static join."""
    left_rows, right_rows = crafted(5, n=90, span=300)
    left, right = feeds(spark, root)
    stream = lambda: asof_stream(left.live(), right.live(), ON, "l_ts", "r_ts", "r_id", "30 seconds", slices, salts)
    for turn in range(3):
        part = lambda rows: [r for r in rows if at(turn * 100) <= r[1] < at((turn + 1) * 100)]
        left.put(*part(left_rows))
        right.put(*part(right_rows))
        journal, query = drained(stream(), root)
        mark = datetime.fromisoformat(query.lastProgress["eventTime"]["watermark"].replace("Z", ""))
        assert journal.batches().agg(F.max("l_ts")).head()[0] < mark
    left.put((1, at(1000), 500))
    right.put((1, at(1000), 500))
    journal, _ = drained(stream(), root)
    expected = brute_asof([r[:2] for r in left_rows], right_rows, 30)
    assert rows_of(journal.batches().filter("NOT _late"), "l_id", "r_id") == sorted(((r[2], e) for r, e in zip(left_rows, expected)), key=repr)
    assert journal.batches().filter("_late").count() == 0


def test_asof_stream_with_text_ties_and_fractions(spark, root):
    left = Feed(spark, root, "left", "l_key VARCHAR, l_ts TIMESTAMP, l_id BIGINT", "l_ts")
    right = Feed(spark, root, "right", "r_key VARCHAR, r_ts TIMESTAMP, tie VARCHAR, price DOUBLE, raw BINARY", "r_ts")
    left.put(("é", at(10.000001), 1), ("é", at(10), 2), ("é", at(9.999999), 3), ("é", at(60), 9))
    right.put(("é", at(10.000001), None, 0.1, None), ("é", at(10), "a", float("nan"), bytearray(b"\x00\xff")), ("é", at(10), "b", -0.0, None), ("é", at(60), "z", 1.0, None))
    out, _ = drained(asof_stream(left.live(), right.live(), ON, "l_ts", "r_ts", "tie", "1 hour"), root)
    assert rows_of(out.batches(), "l_id", "r_ts", "tie", "price") == [(1, at(10.000001), None, 0.1), (2, at(10), "b", -0.0), (3, None, None, None)]


def test_asof_stream_returns_late_rows(spark, root):
    left, right = feeds(spark, root)
    run = lambda: drained(asof_stream(left.live(), right.live(), ON, "l_ts", "r_ts", "r_id", "1 hour"), root)[0]
    left.put((1, at(10), 1), (1, at(100), 2))
    right.put((1, at(5), 1), (1, at(100), 2))
    assert rows_of(run().batches().filter("NOT _late"), "l_id", "r_id") == [(1, 1)]
    left.put((1, at(50), 3), (1, at(200), 4), (None, None, 6))
    right.put((1, at(8), 3), (1, at(200), 4), (1, None, 5), (None, at(8), 7))
    rows = run().batches()
    assert rows_of(rows.filter("NOT _late"), "l_id", "r_id") == [(1, 1), (2, 2)]
    assert rows_of(rows.filter("_late"), "l_id", "r_id") == sorted([(3, None), (6, None), (None, 3), (None, 5)], key=repr)


def test_asof_stream_repeats_a_batch_after_a_lost_commit(spark, root):
    """Running an epoch again, as Spark does after a failure, changes nothing."""
    left, right = feeds(spark, root)
    left.put((1, at(10), 1), (1, at(100), 2))
    right.put((1, at(5), 1), (1, at(100), 2))
    journal, _ = drained(asof_stream(left.live(), right.live(), ON, "l_ts", "r_ts", "r_id", "1 hour"), root, twice=True)
    assert rows_of(journal.batches(), "l_id", "r_id") == [(1, 1)]


def test_asof_stream_heartbeats(spark, root):
    left, right = feeds(spark, root)
    left.put((1, at(10), 1))
    right.put((1, at(5), 1))
    for feed in (left, right):
        feed.writer.watermark(int((at(60) - BASE.replace(year=1970, month=1, day=1, hour=0)).total_seconds() * 1000))
    journal, _ = drained(asof_stream(left.live(), right.live(), ON, "l_ts", "r_ts", "r_id", "1 hour"), root)
    assert rows_of(journal.batches().drop("epoch", "_late")) == [(1, at(10), 1, 1, at(5), 1)]


def test_asof_stream_leaves_idle_keys_alone_and_forgets_them(spark, root):
    """Sixty keys, then batches of one of them: only its state is written, and the other keys' state goes when their slice is over."""
    left, right = feeds(spark, root)
    left.put(*[(k, at(10), k) for k in range(60)])
    right.put(*[(k, at(9), k) for k in range(60)])
    run = lambda: drained(asof_stream(left.live(), right.live(), ON, "l_ts", "r_ts", "r_id", "1 hour"), root)
    run()
    for second in (100, 200, 300):
        left.put((7, at(second), second))
        right.put((7, at(second), second))
        journal, query = run()
        touched = [op["numRowsUpdated"] for p in query.recentProgress for op in p["stateOperators"]]
        assert max(touched[1:] or touched) < 40 or second == 100  # the sixty keys' own timers fire in the first of these
    keys = lambda: {r[0] for r in kept_state(spark, f"{root}/checkpoint", "history").select("key._key0").collect()}
    assert keys() == set(range(60))
    left.put((7, at(4 * 3600), 1000))
    right.put((7, at(4 * 3600), 1000))
    journal, _ = run()
    assert keys() == {7}
    assert rows_of(journal.batches(), "l_id", "r_id") == sorted([*((k, k) for k in range(60)), (100, 100), (200, 200), (300, 300)], key=repr)


def test_asof_stream_whose_keys_share_groups(spark, root):
    """Over turns as the static join, with ties, NULL keys and late rows, in no more groups than were asked for."""
    left_rows, right_rows = crafted(5, n=90, span=300)
    left_rows += [(100 + k, at(10), 1000 + k) for k in range(60)]
    right_rows += [(100 + k, at(9), 1000 + k) for k in range(60)]
    left, right = feeds(spark, root)
    run = lambda: drained(asof_stream(left.live(), right.live(), ON, "l_ts", "r_ts", "r_id", "30 seconds", shared=3), root)[0]
    groups = lambda: kept_state(spark, f"{root}/checkpoint", "history").select("key").distinct().count()
    for turn in range(3):
        part = lambda rows: [r for r in rows if at(turn * 100) <= r[1] < at((turn + 1) * 100)]
        left.put(*part(left_rows))
        right.put(*part(right_rows))
        run()
        assert 0 < groups() <= 2 * 3 * (100 // 30 + 2)
    left.put((1, at(1000), 500), (2, at(20), 501))
    right.put((1, at(1000), 500), (1, None, 502), (None, at(20), 503))
    rows = run().batches()
    expected = brute_asof([r[:2] for r in left_rows], right_rows, 30)
    assert rows_of(rows.filter("NOT _late"), "l_id", "r_id") == sorted(((r[2], e) for r, e in zip(left_rows, expected)), key=repr)
    assert rows_of(rows.filter("_late"), "l_id", "r_id") == [(501, None), (None, 502)]
    assert {r[0] for r in kept_state(spark, f"{root}/checkpoint", "history").selectExpr("explode(list_element.keys)").collect()} == {'{"_key0":1}'}


@pytest.mark.parametrize("name", ["asof_left_stream", "state_retention_kept"])
def test_registered_asof_streams_have_groups_that_do_not_grow_with_the_users(caller, root, name, monkeypatch):
    """As many groups for four times the users, where each slice of each user had been one."""
    import tidemark.registry.joins as registered
    events = caller.read.parquet("/root/testdata/sf0.001/events.parquet").filter("event_type IN ('purchase', 'view')")
    copies = events.crossJoin(caller.range(4).withColumnRenamed("id", "copy"))
    copies.withColumn("event_id", F.expr("event_id * 4 + copy")).withColumn("user_id", F.expr("user_id * 4 + copy")).drop("copy").write.parquet(f"{root}/events.parquet")
    monkeypatch.setattr(registered, "SHARED", 2)
    monkeypatch.setattr(registered, "workspace", lambda _, label: f"{root}/{label}")
    assert getattr(registered, name)(caller, root).count() > 0
    kept = kept_state(caller, f"{root}/{name}/checkpoint", "history").select("key").distinct().groupBy("key._slice").count()
    assert kept.agg(F.max("count")).head()[0] <= 2


def test_asof_stream_is_refused_without_watermark_or_order(spark, root):
    left, right = feeds(spark, root)
    bare = Feed(spark, root, "bare", "r_key BIGINT, r_ts TIMESTAMP, r_id BIGINT")
    with pytest.raises(AdmissionError):
        asof_stream(left.live(), bare.live(), ON, "l_ts", "r_ts", "r_id", "1 hour")
    with pytest.raises(AdmissionError):
        asof_stream(left.live(), right.live(), ON, "l_ts", "r_ts", "r_ts", "1 hour")
