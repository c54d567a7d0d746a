"""Checking incoming rows against a declared source.

Rows arrive as JSON objects, one string per row. Each becomes either an accepted typed row or a
reject naming the field at fault. The parsing and every check are Catalyst expressions; no row
passes through Python.
"""

from __future__ import annotations

import re
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.event_time import utc_clock
from tidemark.sources.definitions import SCHEMA_MISMATCH, EventError, Field, Relation


@dataclass(frozen=True)
class Conformed:
    """``checked`` has every row once: the kept columns, the raw text, the declared columns (NULL in a
    reject) and, for a reject, field, code and reason. The other two are its halves."""

    checked: DataFrame
    accepted: DataFrame
    rejected: DataFrame


def conform_rows(rows: DataFrame, relation: Relation, raw: str = "raw", keep: tuple[str, ...] = ()) -> Conformed:
    """Split ``rows`` into typed rows of ``relation`` and rejects.

    A missing field is NULL; NULL in a NOT NULL column, an unknown field and a value of another type
    are rejects. JSON has one integer kind, so INT is a range check on it, and a number written with
    a point or exponent is a DOUBLE. ``keep`` names columns of ``rows`` passed through to both sides.
    """
    fields = list(enumerate(relation.fields))
    typed = rows.select(
        *keep, F.col(raw).alias("_raw"),
        # NULL for anything but an object.
        F.try_variant_get(F.try_parse_json(F.col(raw)), "$", "map<string,variant>").alias("_doc"),
    ).selectExpr("*", *[f"try_element_at(_doc, {_quoted(f.name)}) AS _v{i}" for i, f in fields]
    ).selectExpr("*", *[f"substring_index(schema_of_variant(_v{i}), '(', 1) AS _k{i}" for i, _ in fields]
    ).selectExpr("*", *[f"{_value(f, i)} AS _x{i}" for i, f in fields])

    declared = ", ".join(_quoted(f.name) for f in relation.fields)
    unknown = f"try_element_at(array_except(map_keys(_doc), array({declared})), 1)"
    faults = [("_doc IS NULL", "CAST(NULL AS STRING)", "not a JSON object"),
              (f"{unknown} IS NOT NULL", unknown, "no such column is declared")]
    for i, f in fields:
        absent = f"coalesce(_k{i} = 'VOID', true)"
        kinds = ", ".join(_quoted(k) for k in KINDS[f.sql_type])
        if not f.nullable:
            faults.append((absent, _quoted(f.name), "a required column is null"))
        faults.append((f"NOT {absent} AND NOT (_k{i} IN ({kinds}) AND _x{i} IS NOT NULL)", _quoted(f.name),
                       f"not a value of type {f.sql_type}"))
    fault = F.expr("CASE " + " ".join(
        f"WHEN {wrong} THEN named_struct('field', {name}, 'reason', {_quoted(reason)})" for wrong, name, reason in faults) + " END")
    # A one-element explode, because a filter on its output stays above it: pushed below, the filter
    # would repeat the parsing for every mention of a field.
    judged = typed.withColumn("_fault", fault).select(
        *keep, "_raw", F.explode(F.array(F.struct(F.col("_fault"), *[f"_x{i}" for i, _ in fields]))).alias("_row"))
    good = F.col("_row._fault").isNull()
    checked = judged.select(
        *keep, F.col("_raw").alias("raw"),
        *[F.when(good, F.col(f"_row._x{i}")).alias(f.name) for i, f in fields],
        F.col("_row._fault.field").alias("field"), F.when(~good, F.lit(SCHEMA_MISMATCH)).alias("code"),
        F.col("_row._fault.reason").alias("reason"))
    columns = [f.name for f in relation.fields]
    return Conformed(checked, checked.filter("code IS NULL").select(*keep, *columns),
                     checked.filter("code IS NOT NULL").select(*keep, "raw", "field", "code", "reason"))


def conform_or_fail(rows: DataFrame, relation: Relation, raw: str = "raw") -> DataFrame:
    """All rows or none: whatever reads the result fails on the first reject, in the same pass that parses it.

    Run it inside ``rejects_as_errors`` to get the failure as an ``EventError``.
    """
    checked = conform_rows(rows, relation, raw).checked
    message = F.concat(F.lit(f"[{SCHEMA_MISMATCH}] "), "reason", F.lit(" (field '"), F.coalesce("field", F.lit("")), F.lit("')"))
    passes = F.when(F.col("code").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return checked.filter(passes).select(*[f.name for f in relation.fields])


@contextmanager
def rejects_as_errors():
    """Turns a Spark failure caused by a bad row into an ``EventError`` with its code and field."""
    try:
        yield
    except Exception as error:
        found = re.search(rf"\[{SCHEMA_MISMATCH}\] (.*?) \(field '(.*?)'\)", str(error))
        if found is None:
            raise
        raise EventError(SCHEMA_MISMATCH, found[1], found[2] or None) from error


def check_batch_schema(batch: DataFrame, relation: Relation) -> None:
    """A columnar batch must have exactly the declared columns and types; order is free."""
    declared = {f.name: f.spark_type for f in relation.fields}
    given = {f.name: T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType
             for f in batch.schema}
    for name in given:
        if name not in declared:
            raise EventError(SCHEMA_MISMATCH, "column not present in the source schema", name)
    for name, data_type in declared.items():
        if name not in given:
            raise EventError(SCHEMA_MISMATCH, "column missing from the batch", name)
        if given[name] != data_type:
            raise EventError(SCHEMA_MISMATCH, f"column has type {given[name].simpleString()}", name)


def not_null_guard(batch: DataFrame, relation: Relation) -> DataFrame:
    """Fails the write, inside its tasks, on a NULL in a NOT NULL column; Spark files do not check this."""
    for f in relation.fields:
        if not f.nullable:
            message = f"[{SCHEMA_MISMATCH}] a required column is null (field '{f.name}')"
            batch = batch.withColumn(f.name, F.coalesce(F.col(f.name), F.raise_error(F.lit(message)).cast(f.spark_type)))
    return batch


# The JSON kinds, as Spark's variants name them, that each column type takes.
KINDS = {
    "INT": ["BIGINT"], "BIGINT": ["BIGINT"], "FLOAT": ["DECIMAL", "DOUBLE", "FLOAT"], "DOUBLE": ["DECIMAL", "DOUBLE", "FLOAT"],
    "VARCHAR": ["STRING"], "BINARY": ["STRING"], "BOOLEAN": ["BOOLEAN"], "TIMESTAMP": ["STRING", "BIGINT"],
}


def _value(f: Field, i: int) -> str:
    """The JSON value as the column's type, NULL if it cannot be: timestamps as ISO text or microseconds, binary as base64."""
    get = lambda target: f"try_variant_get(_v{i}, '$', '{target}')"
    if f.sql_type == "TIMESTAMP":
        text = get("string")  # without a zone it is UTC, also where it is only a date
        instant = f"coalesce(try_to_timestamp({text} || 'Z'), try_to_timestamp({text} || 'T00:00:00Z'), try_to_timestamp({text}))"
        return utc_clock(f"CASE _k{i} WHEN 'BIGINT' THEN timestamp_micros({get('bigint')}) WHEN 'STRING' THEN {instant} END")
    if f.sql_type == "BINARY":
        return f"try_to_binary({get('string')}, 'base64')"
    return get(f.spark_type.simpleString())


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
