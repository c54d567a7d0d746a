"""Declared sources, tables and streams, and the catalogue that names them.

A stream is a Python function from DataFrames to a DataFrame. The same function runs over static
tables (``Catalog.static``) and over unbounded input (``Catalog.live``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.event_time import as_instant, moment, seconds_of
from tidemark.session import derive, derive_streaming, is_file

# Declared SQL type -> (Spark type, canonical name in listings).
SQL_TYPES = {
    "INT": (T.IntegerType(), "Int32"),
    "BIGINT": (T.LongType(), "Int64"),
    "FLOAT": (T.FloatType(), "Float32"),
    "DOUBLE": (T.DoubleType(), "Float64"),
    "VARCHAR": (T.StringType(), "Utf8"),
    "BINARY": (T.BinaryType(), "Binary"),
    "BOOLEAN": (T.BooleanType(), "Boolean"),
    "TIMESTAMP": (T.TimestampNTZType(), "Timestamp(us)"),
}

# Error codes shown to callers.
TABLE_NOT_FOUND = 200
WRITER_CLOSED = 301
SCHEMA_MISMATCH = 302
QUERY_FAILED = 400
SUBSCRIPTION_FAILED = 500
SUBSCRIPTION_CLOSED = 501
NOT_CHECKPOINTED = 900
SHUT_DOWN = 901


# Names of the folders below a source that is kept by day.
APPEND, DAY = "append", "event_day"


class EventError(Exception):
    """A failure with the numeric code of its class and, for bad rows, the field at fault."""

    def __init__(self, code: int, message: str, field_name: str | None = None):
        super().__init__(message if field_name is None else f"{message} (field '{field_name}')")
        self.code = code
        self.field_name = field_name


@dataclass(frozen=True)
class Field:
    name: str
    sql_type: str
    nullable: bool = True

    def __post_init__(self):
        if self.sql_type not in SQL_TYPES:
            raise ValueError(f"unknown column type {self.sql_type!r} for {self.name!r}")

    @property
    def spark_type(self) -> T.DataType:
        return SQL_TYPES[self.sql_type][0]


def canonical_type_name(data_type: T.DataType) -> str:
    """The listing name of a column type; anything outside the declared types is ``Other``."""
    if isinstance(data_type, T.TimestampType):
        return "Timestamp(us, UTC)"
    for spark_type, name in SQL_TYPES.values():
        if spark_type == data_type:
            return name
    return "Other"


def _columns(declaration: str) -> tuple[Field, ...]:
    """Fields of ``"id BIGINT NOT NULL, label VARCHAR"``."""
    fields = []
    for part in declaration.split(","):
        words = part.split()
        fields.append(Field(words[0], words[1].upper(), [w.upper() for w in words[2:]] != ["NOT", "NULL"]))
    return tuple(fields)


@dataclass(frozen=True)
class Relation:
    """What sources and tables share: typed columns, an optional key and the folder of Parquet files."""

    name: str
    fields: tuple[Field, ...]
    path: str
    primary_key: str | None = None

    def __post_init__(self):
        if isinstance(self.fields, str):
            object.__setattr__(self, "fields", _columns(self.fields))
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ValueError(f"{self.name!r} declares a column twice")
        if self.primary_key is not None and self.primary_key not in names:
            raise ValueError(f"{self.name!r} has no column {self.primary_key!r} to use as its key")

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type, f.nullable) for f in self.fields])

    def column(self, name: str) -> Field | None:
        return next((f for f in self.fields if f.name == name), None)


@dataclass(frozen=True)
class Source(Relation):
    """Append-only input. ``watermark`` is ``(event-time column, allowed delay)``.

    ``options`` go to Spark's file stream: ``maxFilesPerTrigger`` and ``maxBytesPerTrigger`` bound a batch. With ``by_day`` each
    append is partitioned by the day of its event time, and ``Catalog.static`` over a time range opens those days' files only.
    """

    watermark: tuple[str, str] | None = None
    options: dict = field(default_factory=dict)
    by_day: bool = False

    def __post_init__(self):
        super().__post_init__()
        if self.watermark is not None:
            ts, delay = self.watermark
            seconds_of(delay)
            declared = self.column(ts)
            if declared is None or declared.sql_type != "TIMESTAMP":
                raise ValueError(f"{self.name!r} needs a TIMESTAMP column {ts!r} for its watermark")
        if self.by_day and (self.watermark is None or self.column(DAY) is not None):
            raise ValueError(f"{self.name!r} needs a watermark, and no column {DAY!r}, to be kept by day")


@dataclass(frozen=True)
class Table(Relation):
    """A keyed table that takes inserts and upserts."""

    def __post_init__(self):
        super().__post_init__()
        if self.primary_key is None:
            raise ValueError(f"table {self.name!r} needs exactly one primary key column")


@dataclass(frozen=True)
class Stream:
    """A derived stream: ``build`` gets one DataFrame per name in ``inputs``."""

    name: str
    inputs: Sequence[str]
    build: Callable[..., DataFrame]


@dataclass(frozen=True)
class Sink:
    """Where a stream is written: a folder and ``append``, ``update`` or ``complete`` output.

    An updated sink compacts itself after every ``compact_every`` batches.
    """

    name: str
    stream: str
    path: str
    mode: str = "append"
    key: tuple[str, ...] = ()
    compact_every: int = 16


class Catalog:
    """Named definitions and the DataFrames they stand for."""

    def __init__(self, spark: SparkSession):
        self._caller = spark
        self.spark = derive(spark)
        self._entries: dict[str, Relation | Stream | Sink] = {}

    @cached_property
    def streaming(self) -> SparkSession:
        return derive_streaming(self._caller)

    def add(self, *definitions) -> "Catalog":
        for definition in definitions:
            if definition.name in self._entries:
                raise EventError(QUERY_FAILED, f"{definition.name!r} already exists")
            inputs = definition.inputs if isinstance(definition, Stream) else (
                [definition.stream] if isinstance(definition, Sink) else [])
            for name in inputs:
                self.get(name)
            self._entries[definition.name] = definition
        return self

    def get(self, name: str):
        if name not in self._entries:
            raise EventError(TABLE_NOT_FOUND, f"no source, table or stream named {name!r}")
        return self._entries[name]

    def of_kind(self, kind: type) -> list:
        return [e for e in self._entries.values() if isinstance(e, kind)]

    def names(self, kind: type) -> list[str]:
        return [e.name for e in self.of_kind(kind)]

    def listing(self) -> DataFrame:
        """One row per definition: its kind and name."""
        rows = [(type(e).__name__.lower(), e.name) for e in self._entries.values()]
        return self.spark.createDataFrame(rows, "kind string, name string")

    def describe(self, name: str) -> DataFrame:
        """Position, name, canonical type and nullability of each declared column."""
        entry = self.get(name)
        if isinstance(entry, Sink):
            raise EventError(QUERY_FAILED, f"{name!r} is a sink; describe the stream it writes")
        columns = self.static(name).schema if isinstance(entry, Stream) else entry.schema
        rows = [(i, f.name, canonical_type_name(f.dataType), f.nullable) for i, f in enumerate(columns)]
        return self.spark.createDataFrame(rows, "position int, field string, type_name string, nullable boolean")

    def static(self, name: str, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """The definition over all rows present now, or over its sources' rows with ``since <= event time < until`` (either may
        be missing; naive UTC wall clock). Rows of sources without event time are all taken in."""
        entry = self.get(name)
        if isinstance(entry, Stream):
            return entry.build(*[self.static(i, since, until) for i in entry.inputs])
        return read_static(self.spark, entry, since, until)

    def live(self, name: str) -> DataFrame:
        """The definition over unbounded input."""
        entry = self.get(name)
        if isinstance(entry, Stream):
            return entry.build(*[self.live(i) for i in entry.inputs])
        return read_live(self.streaming, entry)


def sql_stream(name: str, inputs: Sequence[str], text: str) -> Stream:
    """A stream given as Spark SQL over its inputs' names; windows are Spark's ``window(ts, '10 seconds')``."""
    def build(*frames: DataFrame) -> DataFrame:
        for input_name, frame in zip(inputs, frames):
            frame.createOrReplaceTempView(input_name)
        return frames[0].sparkSession.sql(text)
    return Stream(name, inputs, build)


HEARTBEAT = "_heartbeat"


def declared_columns(frame: DataFrame, relation: Relation) -> DataFrame:
    return frame.select(*[F.col(f"`{f.name}`").cast(f.spark_type).alias(f.name) for f in relation.fields])


def _file_schema(relation: Relation) -> T.StructType:
    """The declared columns as files hold them: nothing is enforced, and a marker may be present."""
    columns = [T.StructField(f.name, f.spark_type, True) for f in relation.fields]
    return T.StructType([*columns, T.StructField(HEARTBEAT, T.BooleanType())])


def without_heartbeats(frame: DataFrame) -> DataFrame:
    """The rows that carry data, dropped behind the watermark, which has then seen all of them.

    A condition Spark takes for non-deterministic stays where it is, and so does every filter above it; pushed below the
    watermark, it would keep heartbeats from moving event time.
    """
    if HEARTBEAT not in frame.columns:
        return frame
    return frame.filter(F.col(HEARTBEAT).isNull() | (F.spark_partition_id() < 0)).drop(HEARTBEAT)


def read_static(spark: SparkSession, relation: Relation, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """All rows present now; only the declared columns are read, and no file is opened to learn its schema.

    A time range reaches the file scan, and, where the source is kept by day, the choice of folders.
    """
    bounded = (since is not None or until is not None) and isinstance(relation, Source) and relation.watermark is not None
    if bounded and relation.by_day:
        schema = _file_schema(relation).add(APPEND, "string").add(DAY, "date")
        frame = _within(spark.read.schema(schema).parquet(relation.path), F.col(DAY), since and F.lit(since.date()),
                        until and F.lit(until.date()), inclusive=True).drop(DAY, APPEND)
    else:
        frame = _all_appends(spark, spark.read.schema(_file_schema(relation)), relation.path).parquet(relation.path)
    if bounded:
        frame = _within(frame, F.col(f"`{relation.watermark[0]}`"), since and moment(since), until and moment(until))
    return frame.filter(F.col(HEARTBEAT).isNull()).drop(HEARTBEAT)


def _within(frame: DataFrame, at: Column, since: Column | None, until: Column | None, inclusive: bool = False) -> DataFrame:
    if since is not None:
        frame = frame.filter(at >= since)
    if until is not None:
        frame = frame.filter(at <= until if inclusive else at < until)
    return frame


def _all_appends(spark: SparkSession, reader, path: str):
    """Each append is a folder of its own."""
    return reader if is_file(spark, path) else reader.option("recursiveFileLookup", "true")


def read_live(spark: SparkSession, source: Source, heartbeats: bool = False) -> DataFrame:
    """The source as unbounded input, with its watermark.

    Rows that only move event time (see ``Writer.watermark``) reach the watermark and go no further. ``heartbeats=True`` keeps
    them and their marker column; an operator downstream must then drop them behind the watermark.
    """
    reader = spark.readStream.schema(_file_schema(source)).options(**source.options)
    folder, _, name = source.path.rstrip("/").rpartition("/")
    if is_file(spark, source.path):
        reader, path = reader.option("pathGlobFilter", name), folder
    else:
        reader, path = reader.option("recursiveFileLookup", "true"), source.path
    frame = as_instant(reader.parquet(path))
    if source.watermark is None:
        return frame if heartbeats else frame.filter(F.col(HEARTBEAT).isNull()).drop(HEARTBEAT)
    ts, delay = source.watermark
    frame = frame.withWatermark(ts, f"{seconds_of(delay)} seconds")
    return frame if heartbeats else without_heartbeats(frame)
