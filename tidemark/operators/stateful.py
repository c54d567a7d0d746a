"""What the operators on the engine's own state share: rows as text, and rows that the engine does not drop as late."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.plans.admission import WATERMARK_KEY, AdmissionError

# Whole microseconds, which JSON text would cut.
JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
NO_TIME = -(1 << 63)


def require_watermark(frame: DataFrame, ts: str, what: str) -> None:
    if WATERMARK_KEY not in frame.schema[ts].metadata:
        raise AdmissionError(f"{what} needs a watermark on {ts}")


def row_text(frame: DataFrame) -> Column:
    """A row of zone-less times as JSON text, for state and for Python; ``row_of`` reads it back."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in frame.columns]), JSON)


def row_of(text: str, schema: T.StructType) -> Column:
    return F.from_json(text, schema, JSON)


def micros(ts: str) -> Column:
    """Microseconds since 1970; ``NO_TIME`` for rows without an event time."""
    return F.coalesce(F.unix_micros(ts), F.lit(NO_TIME))


def mark() -> Column:
    """An event-time column without values.

    The engine drops rows whose event time is behind its watermark before an operator sees them. An operator that
    judges late rows itself, by the watermark it is given, takes in this column and not the rows' own.
    """
    return F.lit(None).cast("timestamp").alias("_mark", metadata={WATERMARK_KEY: 0})


def kept_state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """What a stopped query's state variable holds as of its last batch: ``key``, the value, ``partition_id``."""
    return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
