"""Inputs the tests share."""

import pytest
from pyspark.sql import Row, functions as F


def documents(spark, rows, **extra):
    """Documents of (doc_id, text, lang, source) and other columns, in more than one partition."""
    schema = "doc_id long, text string, lang string, source string"
    frame = spark.createDataFrame([Row(*(list(r) + [None] * (4 - len(r)))) for r in rows], schema)
    for name, value in extra.items():
        frame = frame.withColumn(name, F.lit(value))
    return frame.repartition(3) if rows else frame


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def corpus(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
