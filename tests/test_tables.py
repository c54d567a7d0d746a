import pytest
from helpers import frame, rows_of
from pyspark.sql import functions as F

from tidemark import EventError, KeyedTable, Table, upsert


@pytest.fixture
def metrics(spark, root):
    return KeyedTable(spark, Table("metrics", "id BIGINT NOT NULL, device VARCHAR, value DOUBLE", f"{root}/metrics", "id"))


DDL = "id long, device string, value double"


def test_insert_and_read(spark, metrics):
    assert metrics.read().count() == 0
    assert metrics.append(frame(spark, [(1, "a", 1.5), (2, "b", -2.25)], DDL)) == 2
    assert rows_of(metrics.require()) == [(1, "a", 1.5), (2, "b", -2.25)]


def test_insert_of_a_present_or_repeated_key_is_refused(spark, metrics):
    metrics.append(frame(spark, [(1, "a", 1.5)], DDL))
    for rows in ([(1, "c", 0.0)], [(2, "c", 0.0), (2, "d", 0.0)]):
        with pytest.raises(EventError, match="key") as error:
            metrics.append(frame(spark, rows, DDL))
        assert error.value.code == 400
    assert metrics.read().count() == 1


def test_missing_table(metrics):
    with pytest.raises(EventError) as error:
        metrics.require()
    assert error.value.code == 200


def test_upsert_last_write_wins(spark, metrics):
    metrics.append(frame(spark, [(1, "a", 1.0), (2, "b", 2.0)], DDL))
    changes = frame(spark, [(2, "b2", 3.0, 1), (2, "b3", 4.0, 2), (3, "c", 5.0, 1)], DDL + ", n int")
    assert metrics.upsert(changes, [F.col("n").desc()]) == 2
    assert rows_of(metrics.read()) == [(1, "a", 1.0), (2, "b3", 4.0), (3, "c", 5.0)]


def test_an_upsert_into_a_new_table(spark, metrics):
    changes = frame(spark, [(2, "b", 3.0), (2, "c", 4.0), (None, "d", 5.0)], DDL)
    assert metrics.upsert(changes, [F.col("value").desc()]) == 1
    assert rows_of(metrics.require()) == [(2, "c", 4.0)]


def test_an_upsert_writes_only_the_slices_it_touches(spark, metrics):
    metrics.slice_bytes = 512
    metrics.append(frame(spark, [(i, "a", 1.0) for i in range(500)], DDL))
    metrics.slice_bytes = 1 << 30  # no more slices from here on
    assert metrics.slices() >= 4
    metrics.append(frame(spark, [(i, "b", 2.0) for i in range(500, 600)], DDL))
    before = set(metrics.read().inputFiles())
    assert len(before) <= 2 * metrics.slices()
    assert metrics.upsert(frame(spark, [(7, "c", 3.0), (9000, "d", 4.0)], DDL), [F.col("id")]) == 2
    after = set(metrics.read().inputFiles())
    assert len(after - before) <= 2 and len(after & before) >= len(before) - 4
    expected = sorted([(i, "a", 1.0) for i in range(500) if i != 7] + [(i, "b", 2.0) for i in range(500, 600)] + [(7, "c", 3.0), (9000, "d", 4.0)], key=repr)
    assert rows_of(metrics.read()) == expected
    assert metrics.upsert(frame(spark, [], DDL), [F.col("id")]) == 0
    assert set(metrics.read().inputFiles()) == after
    metrics.upsert(frame(spark, [(i, "z", 0.0) for i in range(700)], DDL), [F.col("id")])
    assert metrics.read().count() == 701 and len(metrics.read().inputFiles()) <= metrics.slices()


def test_the_number_of_slices_follows_the_size(spark, root):
    table = KeyedTable(spark, Table("metrics", "id BIGINT NOT NULL, device VARCHAR, value DOUBLE", f"{root}/metrics", "id"), slice_bytes=8 << 10)
    ids = lambda first, last: spark.range(first, last).select("id", F.sha2(F.col("id").cast("string"), 256).alias("device"), F.rand(1).alias("value"))
    assert table.append(ids(0, 10)) == 10
    few = table.slices()
    assert table.append(ids(10, 3000)) == 2990
    many = table.slices()
    assert many >= 4 * few and table.read().count() == 3000 == table.read().select("id").distinct().count()
    assert table.upsert(ids(2900, 3100), [F.col("id")]) == 200
    assert table.read().count() == 3100
    kept = {path.split("slices=")[1].split("/")[0] for path in table.read().inputFiles()}
    assert kept == {str(table.slices())}


def test_a_column_that_names_the_partitions_is_refused(spark, root):
    with pytest.raises(ValueError, match="key_slice"):
        KeyedTable(spark, Table("t", "key_slice BIGINT", f"{root}/t", "key_slice"))


def test_a_failed_upsert_leaves_the_table_as_it_was(spark, metrics):
    metrics.append(frame(spark, [(1, "a", 1.0)], DDL))
    broken = frame(spark, [(1, "b", 2.0)], DDL).withColumn("value", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(Exception, match="boom"):
        metrics.upsert(broken, [F.col("id")])
    assert rows_of(metrics.read()) == [(1, "a", 1.0)]


def test_hot_key_shrinks_before_the_shuffle(spark):
    new = spark.range(100000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("id"), F.col("id").alias("n"))
    merged = upsert(spark.range(5).withColumn("n", F.lit(-1).cast("long")), new, ["id"], [F.col("n").desc()])
    assert merged.filter("id = 1").head()["n"] == 99998
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
