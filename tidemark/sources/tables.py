"""Keyed tables: Parquet partitioned by a hash of the key.

A key's rows are in one slice, and Spark's dynamic partition overwrite replaces the slices that an upsert touches; the others are
neither read nor written. The number of slices follows the size of the table: a table that has outgrown its slices is
written once more into more of them. A job that fails leaves the table as it was, because Spark moves files into place only
when all of them are there. That last step moves one slice after the other: readers should wait for the writer, and a driver
lost within it can leave slices old or missing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from tidemark.session import committed_numbers, hadoop_path, remove
from tidemark.sources.conform import check_batch_schema, not_null_guard, rejects_as_errors
from tidemark.sources.definitions import EventError, QUERY_FAILED, Table, TABLE_NOT_FOUND, declared_columns


def latest_per_key(rows: DataFrame, key: list[str], newest_first: list[Column]) -> DataFrame:
    """One row per key: the first under ``newest_first``.

    Spark keeps only the best row per key of each input partition before the shuffle, so a key with
    very many rows does not pile up in one task.
    """
    order = Window.partitionBy(*key).orderBy(*newest_first)
    return rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == 1).drop("_rank")


def upsert(old: DataFrame, new: DataFrame, key: list[str], newest_first: list[Column]) -> DataFrame:
    """Rows of ``old`` whose key is not in ``new``, and the newest row per key of ``new``.

    Both join sides have one row per key, so no key is hot.
    """
    return _merged(old, latest_per_key(new.filter(_all_set(key)), key, newest_first).select(*old.columns), key)


def _merged(old: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    return old.join(changes.select(*key), key, "left_anti").unionByName(changes)


def _all_set(key: list[str]) -> Column:
    condition = F.lit(True)
    for name in key:
        condition = condition & F.col(name).isNotNull()
    return condition


SLICE = "key_slice"
FIRST_SLICES = 1
SLICE_BYTES = 256 << 20


class KeyedTable:
    """One writer at a time. ``slice_bytes`` is the size a slice should have; slices may reach twice that."""

    def __init__(self, spark: SparkSession, table: Table, slice_bytes: int = SLICE_BYTES):
        if table.column(SLICE) is not None:
            raise ValueError(f"{table.name!r} has a column {SLICE!r}, which names the table's partitions")
        self.spark = spark
        self.table = table
        self.slice_bytes = slice_bytes

    def slices(self) -> int | None:
        """How many slices the table has; None before the first write."""
        done = committed_numbers(self.spark, self.table.path, "slices=")
        return done[-1] if done else None

    def read(self) -> DataFrame:
        """The rows present now. An upsert replaces files, so read again after one."""
        slices = self.slices()
        if slices is None:
            return self.spark.createDataFrame([], self.table.schema)
        return declared_columns(self._stored(self._folder(slices)), self.table)

    def append(self, rows: DataFrame, check_keys: bool = True) -> int:
        """Insert rows whose keys are new; returns the number of rows.

        ``check_keys`` looks for keys that repeat or are present already and refuses the insert.
        """
        check_batch_schema(rows, self.table)
        key, slices = self.table.primary_key, self.slices()
        if check_keys:
            clashing = rows.groupBy(key).count().filter((F.col("count") > 1) | F.col(key).isNull()).select(key)
            if slices is not None:
                clashing = clashing.unionByName(rows.select(key).join(self.read().select(key), key, "left_semi"))
            clash = clashing.head(1)
            if clash:
                raise EventError(QUERY_FAILED, f"key {clash[0][0]!r} repeats or is present in {self.table.name!r}")
        written = self._write(declared_columns(rows, self.table), slices or FIRST_SLICES, "append" if slices else "overwrite")
        self._grow()
        return written

    def upsert(self, rows: DataFrame, newest_first: list[Column]) -> int:
        """Insert or overwrite by key, last row under ``newest_first`` winning; returns the number of keys written.

        ``rows`` may carry further columns that only ``newest_first`` uses.
        """
        check_batch_schema(rows.select(*[f.name for f in self.table.fields]), self.table)
        key, slices = [self.table.primary_key], self.slices()
        changes = declared_columns(latest_per_key(rows.filter(_all_set(key)), key, newest_first), self.table)
        if slices is None:
            written = self._write(changes, FIRST_SLICES, "overwrite")
        else:
            # Ranked once: the slices that are touched must be known before any old row is read.
            staged = f"{self.table.path}/_changes-{uuid.uuid4().hex}"
            written = self._write(changes, slices, "overwrite", staged)
            touched = self._present(staged)
            if touched:
                old = self._stored(self._folder(slices)).filter(F.col(SLICE).isin(touched))
                merged = _merged(declared_columns(old, self.table), declared_columns(self._stored(staged), self.table), key)
                self._write(merged, slices, "replace")
            remove(self.spark, staged)
        self._grow()
        return written

    def require(self) -> DataFrame:
        """The table's rows; a table never written to is an error."""
        if self.slices() is None:
            raise EventError(TABLE_NOT_FOUND, f"no table named {self.table.name!r}")
        return self.read()

    def _folder(self, slices: int) -> str:
        return f"{self.table.path}/slices={slices}"

    def _stored(self, folder: str) -> DataFrame:
        return self.spark.read.schema(self.table.schema.add(SLICE, "integer")).parquet(folder)

    def _present(self, folder: str) -> list[int]:
        jpath, fs = hadoop_path(self.spark, f"{folder}/{SLICE}=*")
        return [int(status.getPath().getName().partition("=")[2]) for status in (fs.globStatus(jpath) or [])]

    def _write(self, rows: DataFrame, slices: int, how: str, folder: str | None = None) -> int:
        """Write rows by slice; returns how many. ``replace`` overwrites the slices that ``rows`` has rows for.

        Rows of a slice are brought together before, as many to a file as adaptive execution puts into a partition.
        """
        seen = Observation()
        number = F.pmod(F.xxhash64(self.table.primary_key), F.lit(slices)).cast("int")
        stored = not_null_guard(rows, self.table).withColumn(SLICE, number).hint("rebalance", SLICE)
        writer = stored.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append" if how == "append" else "overwrite")
        with rejects_as_errors():
            writer.option("partitionOverwriteMode", "dynamic" if how == "replace" else "static").partitionBy(SLICE).parquet(
                folder or self._folder(slices))
        return int(seen.get["rows"])

    def _grow(self) -> None:
        """Bring a table over twice its slices' size into as many slices as it needs: at least twice as many, so that
        all such rewrites together cost no more than the writes that made the table."""
        numbers = committed_numbers(self.spark, self.table.path, "slices=")
        for old in numbers[:-1]:
            remove(self.spark, self._folder(old))
        jpath, fs = hadoop_path(self.spark, self._folder(numbers[-1]))
        needed = -(-fs.getContentSummary(jpath).getLength() // self.slice_bytes)
        if needed <= 2 * numbers[-1]:
            return
        self._write(self.read(), 1 << (needed - 1).bit_length(), "overwrite")
        remove(self.spark, self._folder(numbers[-1]))
