"""What the operators share: staged tables and bounded Arrow slices."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import workspace

SLICE_BYTES = 4 << 20


def stash(df: DataFrame, label: str) -> DataFrame:
    """The rows written below ``spark.checkpoint.dir`` and read again.

    Cuts the lineage, survives lost executors, and gives the planner the true size of the table.
    """
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``most`` bytes, one row at least."""
    if batch.num_rows == 0:
        return
    step = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def map_slices(df: DataFrame, schema: str, of: Callable[[pa.RecordBatch], list]) -> DataFrame:
    """``of`` turns each slice into the columns of ``schema``, in order, as Arrow arrays or lists."""
    fields = [f.name for f in _schema(df, schema).fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                columns = of(piece)
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns], names=fields)

    return df.mapInArrow(run, schema)


def _schema(df: DataFrame, ddl: str):
    from pyspark.sql.types import StructType
    return StructType.fromDDL(ddl)


def worker_store() -> dict:
    """What a Python worker keeps from task to task; code that is sent by value has no module of its own for it."""
    return sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker")).__dict__


def texts(piece: pa.RecordBatch, column: str = "text") -> list[str | None]:
    return piece.column(column).to_pylist()
