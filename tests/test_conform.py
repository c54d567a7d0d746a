import json
from datetime import datetime

import pytest
from helpers import Feed, at, frame, rows_of

from tidemark import EventError, Source, Writer, conform_or_fail, conform_rows
from tidemark.session import derive
from tidemark.sources.conform import rejects_as_errors
from tidemark.sources.definitions import read_static


def check(spark, columns, *rows):
    declared = Source("s", columns, "/nowhere")
    texts = [(r if isinstance(r, str) else json.dumps(r),) for r in rows]
    return conform_rows(spark.createDataFrame(texts, "raw string"), declared)


@pytest.mark.parametrize("sql_type, good, bad", [
    ("INT", [1, -2147483648], ["x", 2147483648, 1.5, True]),
    ("BIGINT", [1, 9223372036854775807], ["not a number", 9223372036854775808, 1.0, False]),
    ("DOUBLE", [1.5, -2.25, 1e300], ["1.5", 1, True]),
    ("VARCHAR", ["a", ""], [1, True, 1.5, {"b": 1}, [1]]),
    ("BOOLEAN", [True, False], ["true", 1]),
    ("TIMESTAMP", ["2026-08-29T10:00:00Z", "2026-08-29 10:00:00.123456", 1788000000000000], ["later", True, 1.5]),
    ("BINARY", ["aGk="], [1, "*"]),
])
def test_value_rules(spark, sql_type, good, bad):
    split = check(spark, f"a {sql_type}", *[{"a": v} for v in good + bad], {"a": None}, {})
    assert split.accepted.count() == len(good) + 2
    rejects = split.rejected.collect()
    assert len(rejects) == len(bad)
    assert {(r["field"], r["code"]) for r in rejects} == {("a", 302)}


def test_values_are_kept_exactly(spark):
    split = check(spark, "a BIGINT, d DOUBLE, t TIMESTAMP, b BINARY",
                  {"a": 9007199254740993, "d": 0.1, "t": -1, "b": "aGk="},
                  {"t": "2026-08-29T10:00:00.000001+02:00"})
    first, second = split.accepted.collect()
    assert (first["a"], first["d"], first["t"], bytes(first["b"])) == (
        9007199254740993, 0.1, datetime(1969, 12, 31, 23, 59, 59, 999999), b"hi")
    assert second["t"] == datetime(2026, 8, 29, 8, 0, 0, 1) and second["a"] is None


def test_nulls_unknown_keys_and_broken_rows(spark):
    split = check(spark, "a BIGINT, b VARCHAR NOT NULL", {"a": 1}, {"a": 1, "b": None}, {"a": 1, "b": "x", "c": 2},
                  "not json", "[1]", {"b": "ok"})
    assert rows_of(split.rejected, "field", "reason") == sorted([
        ("b", "a required column is null"), ("b", "a required column is null"),
        ("c", "no such column is declared"), (None, "not a JSON object"), (None, "not a JSON object")], key=repr)
    assert rows_of(split.accepted) == [(None, "ok")]
    assert split.checked.count() == 6


def test_one_bad_row_fails_the_batch(spark, root):
    declared = Source("exact", "a BIGINT", f"{root}/exact")
    strict = conform_or_fail(spark.createDataFrame([('{"a": 1}',), ('{"a": 1, "b": 2}',)], "raw string"), declared)
    with pytest.raises(EventError, match="'b'") as error, rejects_as_errors():
        strict.collect()
    assert error.value.code == 302
    with Writer(spark, declared) as writer:
        with pytest.raises(EventError):
            writer.write_json(spark.createDataFrame([('{"a": 1}',), ('{"a": "x"}',)], "raw string"))
        assert writer.write_json(spark.createDataFrame([('{"a": 1}',), ('{"a": 2}',)], "raw string")) == 2
    assert rows_of(read_static(spark, declared)) == [(1,), (2,)]


def test_batch_schema_must_match(spark, root):
    feed = Feed(spark, root, "s", "a BIGINT, b VARCHAR NOT NULL")
    for rows, ddl, column in [([(1, "x", 2)], "a long, b string, c long", "c"), ([(1,)], "a long", "b"),
                              ([(1, "x")], "a int, b string", "a")]:
        with pytest.raises(EventError, match=f"'{column}'") as error:
            feed.writer.write(frame(spark, rows, ddl))
        assert error.value.code == 302
    with pytest.raises(EventError, match="a required column is null .*'b'"):
        feed.put((1, None))
    assert not spark.read.schema("a long").parquet(feed.source.path).head(1)


def test_writer_buffers_flushes_and_closes(spark, root):
    feed = Feed(spark, root, "events", "kind VARCHAR, ts TIMESTAMP", ts="ts")
    writer = feed.writer
    assert writer.current_watermark() is None
    writer.buffer(frame(spark, [("open", at(0))], feed.ddl))
    writer.buffer(frame(spark, [(None, at(1))], feed.ddl))
    assert writer.flush() == 2 and writer.flush() == 0
    writer.watermark(1788000005000)
    writer.watermark(1788000004000)
    assert writer.current_watermark() == 1788000005000
    writer.buffer(frame(spark, [("last", at(2))], feed.ddl))
    writer.close()
    writer.close()
    with pytest.raises(EventError) as error:
        writer.write(frame(spark, [("x", at(3))], feed.ddl))
    assert error.value.code == 301
    assert rows_of(read_static(spark, feed.source), "kind") == [
        ("last",), ("open",), (None,)]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "UTC"])
def test_instants_are_stored_as_utc_whatever_the_callers_zone(caller, root, zone):
    spark = caller.newSession()
    spark.conf.set("spark.sql.session.timeZone", zone)
    declared = Source("seen", "id BIGINT, at TIMESTAMP", f"{root}/seen")
    texts = ['"2026-03-08T06:30:00Z"', '"2026-03-08T08:30:00.25+02:00"', '"2026-03-08 06:30:00"', '"2026-03-08"', "1772951400000000", "-1", "null"]
    rows = spark.createDataFrame([(f'{{"id": {i}, "at": {t}}}',) for i, t in enumerate(texts)], "raw string")
    half = datetime(2026, 3, 8, 6, 30)
    expected = [half, half.replace(microsecond=250000), half, datetime(2026, 3, 8), half, datetime(1969, 12, 31, 23, 59, 59, 999999), None]
    with Writer(spark, declared) as writer:
        writer.write_json(rows)
        typed = spark.sql("SELECT 10L AS id, TIMESTAMP '2026-11-01T05:30:00Z' AS at UNION ALL SELECT 11, TIMESTAMP '2026-11-01T06:30:00Z'")
        writer.write(typed)
    kept = read_static(derive(spark), declared).orderBy("id").collect()
    assert [r["at"] for r in kept] == [*expected, datetime(2026, 11, 1, 5, 30), datetime(2026, 11, 1, 6, 30)]
    checked = conform_rows(rows, declared).accepted.orderBy("id").collect()
    assert [r["at"] for r in checked] == expected
