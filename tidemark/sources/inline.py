"""Inline rows: ``VALUES`` lists with the column types the event-time tables use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def values(spark: SparkSession, rows: str, columns: list[str]) -> DataFrame:
    """``VALUES`` rows as a frame; whole numbers are BIGINT and decimals DOUBLE, NULLs stay."""
    frame = spark.sql(f"SELECT * FROM (VALUES {rows}) AS t({', '.join(columns)})")
    widened = []
    for f in frame.schema:
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            widened.append(F.col(f.name).cast("bigint"))
        elif isinstance(f.dataType, T.DecimalType):
            widened.append(F.col(f.name).cast("double"))
        else:
            widened.append(F.col(f.name))
    return frame.select(*widened)
