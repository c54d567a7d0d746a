"""Small crafted inputs and a source folder to feed them into."""

from datetime import datetime, timedelta

from tidemark import Source, Writer
from tidemark.sources.definitions import read_live
from tidemark.session import derive_streaming

BASE = datetime(2026, 8, 29, 10, 0, 0)


def at(seconds: float) -> datetime:
    return BASE + timedelta(seconds=seconds)


def frame(spark, rows, ddl):
    """Rows with naive datetimes for ``timestamp_ntz`` columns."""
    return spark.createDataFrame(rows, ddl).coalesce(1)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


class Feed:
    """A source in its own folder, written in steps and read as a stream."""

    def __init__(self, spark, root, name, columns, ts=None, delay="5 seconds"):
        self.spark = spark
        self.source = Source(name, columns, f"{root}/{name}", watermark=(ts, delay) if ts else None)
        self.ddl = ", ".join(f"{f.name} {f.spark_type.simpleString()}" for f in self.source.fields)
        self.writer = Writer(spark, self.source)
        self.streaming = derive_streaming(spark)

    def put(self, *rows):
        self.writer.write(frame(self.spark, list(rows), self.ddl))
        return self

    def live(self, heartbeats=False):
        return read_live(self.streaming, self.source, heartbeats)


def brute_interval(left, right, bound):
    """Index pairs of an interval join, by comparing everything; rows are (key, ts, ...)."""
    return {(i, j) for i, l in enumerate(left) for j, r in enumerate(right)
            if l[0] is not None and l[0] == r[0] and l[1] is not None and r[1] is not None
            and l[1] <= r[1] <= l[1] + timedelta(seconds=bound)}


def brute_asof(left, right, retention=None):
    """Per left row (key, ts) the tie value of its right row (key, ts, tie), or None."""
    found = []
    for key, ts in left:
        seen = [(r[1], r[2]) for r in right if key is not None and r[0] == key and r[1] <= ts
                and (retention is None or r[1] >= ts - timedelta(seconds=retention))]
        found.append(max(seen)[1] if seen else None)
    return found
