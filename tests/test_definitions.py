import pytest
from helpers import rows_of

from tidemark import Catalog, EventError, Sink, Source, Stream, Table, values
from tidemark.session import derive


def source(name="events", **more):
    return Source(name, "berth BIGINT NOT NULL, vessel VARCHAR, draught DOUBLE, docked BOOLEAN, seen TIMESTAMP", "/nowhere", **more)


def test_describe_reports_canonical_type_names(spark):
    catalog = Catalog(spark).add(source())
    assert rows_of(catalog.describe("events"), "field", "type_name", "nullable") == sorted([
        ("berth", "Int64", False), ("vessel", "Utf8", True), ("draught", "Float64", True),
        ("docked", "Boolean", True), ("seen", "Timestamp(us)", True)], key=repr)
    assert source().column("missing") is None
    assert source().column("vessel").sql_type == "VARCHAR"


def test_listing_by_kind(spark):
    catalog = Catalog(spark).add(source("base"), Stream("derived", ["base"], lambda b: b), Sink("out", "derived", "/nowhere"))
    assert (catalog.names(Source), catalog.names(Stream), catalog.names(Sink)) == (["base"], ["derived"], ["out"])
    assert rows_of(catalog.listing()) == [("sink", "out"), ("source", "base"), ("stream", "derived")]


def test_duplicate_and_unknown_names_are_refused(spark):
    catalog = Catalog(spark).add(source())
    with pytest.raises(EventError, match="already exists") as error:
        catalog.add(source())
    assert error.value.code == 400
    with pytest.raises(EventError) as error:
        catalog.add(Stream("s", ["nothing"], lambda n: n))
    assert error.value.code == 200


def test_bad_declarations_are_refused():
    with pytest.raises(ValueError, match="exactly one primary key"):
        Table("t", "a BIGINT", "/nowhere")
    with pytest.raises(ValueError, match="TIMESTAMP"):
        source(watermark=("berth", "5 seconds"))
    with pytest.raises(ValueError, match="positive"):
        source(watermark=("seen", "-5 seconds"))
    with pytest.raises(ValueError, match="unknown column type"):
        Source("s", "a DECIMAL", "/nowhere")
    with pytest.raises(ValueError, match="twice"):
        Source("s", "a INT, a INT", "/nowhere")


def test_values_are_bigint_and_double_and_keep_nulls(spark):
    frame = values(spark, "(70, 'north', 0.5), (71, NULL, 12.25)", ["id", "pier", "depth"])
    assert frame.schema.simpleString() == "struct<id:bigint,pier:string,depth:double>"
    assert rows_of(frame) == [(70, "north", 0.5), (71, None, 12.25)]


def test_derived_session_leaves_the_caller_alone(caller):
    before = caller.conf.get("spark.sql.session.timeZone")
    session = derive(caller)
    session.conf.set("spark.sql.shuffle.partitions", "3")
    assert caller.conf.get("spark.sql.shuffle.partitions") != "3"
    assert caller.conf.get("spark.sql.session.timeZone") == before
