"""Run registered queries next to their SQL in DuckDB: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from datetime import datetime

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session() -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("tidemark-tests")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def plain(value):
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(body, key=repr)


# Spark type -> DuckDB type.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP"}


def compare(spark, db, name: str, sf_dir: str) -> str | None:
    """None if Spark and DuckDB agree, else what differs."""
    import __spark_entry__
    ORACLE = __spark_entry__.oracle_sql()
    frame = __spark_entry__.queries()[name](spark, sf_dir)
    got_columns, got = rows_of(frame.columns, frame.collect())
    if name not in ORACLE:
        return None if got else "no rows"
    relation = db.execute(ORACLE[name])
    want_columns, want = rows_of([d[0] for d in relation.description], relation.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    got_types = {f.name: TYPES[f.dataType.simpleString()] for f in frame.schema}
    want_types = {d[0]: str(d[1]) for d in relation.description}
    if got_types != want_types:
        return f"types {got_types} != {want_types}"
    if got != want:
        extra, missing = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} rows, expected {len(want)}; extra {sorted(extra, key=repr)[:3]}; missing {sorted(missing, key=repr)[:3]}"
    return None


if __name__ == "__main__":
    import __spark_entry__
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, db = session(), connect(sf)
    bad = 0
    for query in sys.argv[2:] or list(__spark_entry__.queries()):
        began = time.time()
        try:
            problem = compare(spark, db, query, sf)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{query:28s} {time.time() - began:6.1f}s {problem or 'ok'}", flush=True)
    print("failed:", bad)
