from datetime import datetime, timedelta

import pytest
from helpers import frame, rows_of

from tidemark import Catalog, Runner, Sink, Source, Stream, Writer

DDL = "id long, ts timestamp_ntz"
DAY = datetime(2026, 8, 29)


def daily(root, **more):
    return Source("daily", "id BIGINT, ts TIMESTAMP", f"{root}/daily", watermark=("ts", "5 seconds"), by_day=True, **more)


def hours(spark, *numbers):
    return frame(spark, [(n, DAY + timedelta(hours=n)) for n in numbers], DDL)


def test_a_range_opens_only_its_days(spark, root):
    catalog = Catalog(spark).add(daily(root), Stream("ids", ["daily"], lambda d: d.select("id")))
    with Writer(spark, catalog.get("daily")) as writer:
        assert writer.write(hours(spark, *range(0, 96))) == 96
        assert writer.write(hours(spark, 25, 100)) == 2
        writer.write(frame(spark, [(-1, None)], DDL))
        writer.watermark(1788000000000)
    assert catalog.static("ids").count() == 99
    some = catalog.static("ids", DAY + timedelta(hours=24), DAY + timedelta(hours=30))
    assert rows_of(some) == sorted([(n,) for n in [*range(24, 30), 25]], key=repr)
    plan = some._jdf.queryExecution().executedPlan().toString()
    scanned = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert scanned and all("event_day" in line.split("PartitionFilters:")[1].split("]")[0] for line in scanned)
    some.collect()
    # 24 to 30 o'clock lies within one day, whose two appends are one file each.
    leaf = [node for node in _nodes(some) if "scan parquet" in node.nodeName().lower()][0]
    assert leaf.metrics().apply("numFiles").value() == 2
    assert rows_of(catalog.static("ids", since=DAY + timedelta(hours=95))) == [(100,), (95,)]
    assert rows_of(catalog.static("ids", until=DAY + timedelta(hours=1))) == [(0,)]


def _nodes(df):
    found, open_nodes = [], [df._jdf.queryExecution().executedPlan()]
    while open_nodes:
        node = open_nodes.pop()
        found.append(node)
        open_nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_a_range_of_a_source_without_days_filters_event_time(spark, root):
    plain = Source("plain", "id BIGINT, ts TIMESTAMP", f"{root}/plain", watermark=("ts", "5 seconds"))
    other = Source("other", "id BIGINT", f"{root}/other")
    catalog = Catalog(spark).add(plain, other)
    with Writer(spark, plain) as writer, Writer(spark, other) as rest:
        writer.write(hours(spark, 1, 2, 3))
        rest.write(frame(spark, [(7,)], "id long"))
    assert rows_of(catalog.static("plain", DAY + timedelta(hours=2)), "id") == [(2,), (3,)]
    assert rows_of(catalog.static("other", DAY)) == [(7,)]


def test_batches_bounded_by_bytes_hold_every_row_once(spark, root):
    source = daily(root, options={"maxBytesPerTrigger": "1"})
    catalog = Catalog(spark).add(source, Stream("ids", ["daily"], lambda d: d.select("id")), Sink("out", "ids", f"{root}/out"))
    with Writer(spark, source) as writer:
        writer.write(hours(spark, *range(0, 72)))
    runner = Runner(catalog, f"{root}/run")
    runner.drain()
    assert rows_of(runner.read("out")) == sorted([(n,) for n in range(72)], key=repr)
    assert runner.metrics().head()["batches"] >= 3


def test_days_need_event_time_and_a_free_name(root):
    with pytest.raises(ValueError, match="watermark"):
        Source("s", "id BIGINT", f"{root}/s", by_day=True)
    with pytest.raises(ValueError, match="event_day"):
        Source("s", "event_day BIGINT, ts TIMESTAMP", f"{root}/s", watermark=("ts", "1 second"), by_day=True)
