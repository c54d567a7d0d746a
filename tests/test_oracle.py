"""Every registered query against its SQL."""

import duckdb
import pytest
from compare import compare, connect
from conftest import SF
from pyspark.sql import functions as F

from tidemark.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(caller, db, name):
    assert compare(caller, db, name, SF) is None


@pytest.mark.parametrize("name", ["late_rows", "late_rows_counted"])
def test_late_rows_of_a_table_in_many_files(caller, db, root, name):
    """A turn that takes several files, in no order of event time, is still one batch."""
    caller.read.parquet(f"{SF}/events.parquet").repartition(5).write.parquet(f"{root}/events.parquet")
    assert compare(caller, db, name, root) is None


@pytest.mark.parametrize("name", ["late_rows", "late_rows_counted"])
def test_late_rows_without_a_type(caller, db, root, name):
    """An event whose type is NULL is no error: it comes in its own turn and is in one of the two parts."""
    events = caller.read.parquet(f"{SF}/events.parquet")
    events.withColumn("event_type", F.when(F.col("event_id") % 7 != 0, F.col("event_type"))).write.parquet(f"{root}/events.parquet")
    untyped = duckdb.connect()
    untyped.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{root}/events.parquet/*.parquet')")
    assert compare(caller, untyped, name, root) is None


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


def test_entry_has_rows(caller):
    import __spark_entry__
    assert __spark_entry__.entry(caller).count() > 0
