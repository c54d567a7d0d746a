"""Top-k reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tidemark.plans.admission import AdmissionError
from tidemark.session import committed_numbers


def top_k(frame: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows under ``order``; each task keeps ``k`` rows, nothing is fully sorted."""
    if k is None or k <= 0:
        raise AdmissionError("ORDER BY needs a positive LIMIT")
    return frame.orderBy(*order).limit(k)


class RunningTopK:
    """Top k of everything a stream has delivered so far, for ``foreachBatch``.

    Batch ``n`` merges its own top k with the k rows stored by the batch before and stores the result
    under its own number, so running a batch again gives the same rows.
    """

    def __init__(self, path: str, order: list[Column], k: int):
        self.path, self.order, self.k = path, order, k

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        best = top_k(batch, self.order, self.k)
        earlier = [n for n in committed_numbers(spark, self.path, "epoch=") if n < batch_id]
        if earlier:
            stored = spark.read.parquet(f"{self.path}/epoch={earlier[-1]}")
            best = top_k(best.unionByName(stored), self.order, self.k)
        best.write.mode("overwrite").parquet(f"{self.path}/epoch={batch_id}")

    def read(self, spark) -> DataFrame:
        return spark.read.parquet(f"{self.path}/epoch={committed_numbers(spark, self.path, 'epoch=')[-1]}")
