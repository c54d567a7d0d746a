"""A stream's output as ordered frames that consumers read from a cursor.

Each micro-batch is one epoch: its rows are written under ``data/epoch=N`` (running the batch again
overwrites them), then one barrier row is written, stating that everything through that point is
durable. Rows beyond the last barrier are not visible. The driver handles numbers of epochs, never rows.

A journal with a key writes a base by itself, the newest row per key, whenever ``compact_every`` epochs have gathered since
the last one; so what a read of the newest rows costs depends on the keys and not on how many epochs there have been.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.session import committed_numbers, numbered_files, remove, write_text
from tidemark.sources.definitions import SUBSCRIPTION_CLOSED, SUBSCRIPTION_FAILED, EventError
from tidemark.sources.tables import latest_per_key

BARRIER = "sequence bigint, epoch bigint, checkpoint_id bigint, through_sequence bigint, row_count bigint"


COMPACT_EVERY = 16


class Journal:
    def __init__(self, spark: SparkSession, path: str, key: list[str] | None = None, compact_every: int = COMPACT_EVERY):
        self.spark = spark
        self.path = path
        self.key = key
        self.compact_every = compact_every

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        """Record one micro-batch; use as the ``foreachBatch`` function."""
        seen = Observation()
        counted = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(f"{self.path}/data/epoch={epoch}")
        rows = int(seen.get["rows"])
        # Data frame 2n, barrier 2n + 1; an empty batch has no data frame and confirms what came before.
        through = 2 * epoch if rows else self._through_before(epoch)
        barrier = self.spark.range(1).selectExpr(
            f"CAST({2 * epoch + 1} AS BIGINT) sequence", f"CAST({epoch} AS BIGINT) epoch",
            f"CAST({epoch} AS BIGINT) checkpoint_id", f"CAST({through} AS BIGINT) through_sequence",
            f"CAST({rows} AS BIGINT) row_count")
        barrier.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/barriers/n={epoch}")
        base = self._base()
        if self.key and epoch - (-1 if base is None else base) >= self.compact_every:
            self.compact(self.key)

    def _through_before(self, epoch: int) -> int:
        earlier = [n for n in self.epochs() if n < epoch]
        if not earlier:
            return -1
        return self.spark.read.schema(BARRIER).parquet(f"{self.path}/barriers/n={earlier[-1]}").head()["through_sequence"]

    def epochs(self) -> list[int]:
        """Epochs that have a barrier, in order."""
        return committed_numbers(self.spark, f"{self.path}/barriers", "n=")

    def barriers(self) -> DataFrame:
        return self.spark.read.schema(BARRIER).parquet(f"{self.path}/barriers").select(
            "sequence", "epoch", "checkpoint_id", "through_sequence", "row_count")

    def frames(self) -> DataFrame:
        """All frames in ``sequence`` order of reading: a data frame per non-empty epoch, a barrier per epoch."""
        barriers = self.barriers()
        none = F.lit(None).cast("bigint")
        data = barriers.filter("row_count > 0").select(
            F.lit("data").alias("kind"), (F.col("sequence") - 1).alias("sequence"), "epoch",
            none.alias("checkpoint_id"), none.alias("through_sequence"), "row_count")
        return data.unionByName(barriers.select(
            F.lit("barrier").alias("kind"), "sequence", "epoch", "checkpoint_id", "through_sequence",
            none.alias("row_count")))

    def batches(self, after: int = -1, through: int | None = None) -> DataFrame:
        """Rows of the epochs in ``(after, through]`` with their ``epoch``, without barriers."""
        epochs = self.epochs()
        if not epochs:
            raise EventError(SUBSCRIPTION_FAILED, f"nothing has been delivered to {self.path}")
        last = epochs[-1] if through is None else min(through, epochs[-1])
        return self._rows([e for e in epochs if after < e <= last] or epochs[-1:]).filter((F.col("epoch") > after) & (F.col("epoch") <= last))

    def _rows(self, epochs: list[int]) -> DataFrame:
        """Rows of the given epochs; only their folders are listed, and one file tells the schema."""
        schema = self.spark.read.parquet(f"{self.path}/data/epoch={epochs[-1]}").schema.add("epoch", "long")
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/epoch={e}" for e in epochs])

    def appended(self, schema, through: int | None = None) -> DataFrame:
        """Rows of all epochs up to ``through`` of a journal whose epochs only add rows; none if nothing was delivered."""
        epochs = self.epochs()
        if not epochs:
            return self.spark.createDataFrame([], schema)
        last = epochs[-1] if through is None else min(through, epochs[-1])
        self._require_whole(epochs, -1)
        rows = self.spark.read.schema(StructType([*schema.fields, StructField("epoch", LongType())])).parquet(f"{self.path}/data")
        return rows.filter(F.col("epoch") <= last).drop("epoch")

    def _require_whole(self, epochs: list[int], after: int) -> None:
        if epochs and epochs[0] > after + 1:
            raise EventError(SUBSCRIPTION_FAILED, f"epochs of {self.path} from {after + 1} to {epochs[0] - 1} have expired")

    def _bases(self) -> list[int]:
        """Numbers of the bases, each the last epoch that the base takes in."""
        return committed_numbers(self.spark, f"{self.path}/base", "through=")

    def _base(self) -> int | None:
        done = self._bases()
        return done[-1] if done else None

    def latest(self, key: list[str], through: int | None = None) -> DataFrame:
        """The newest row per key, as of the epoch ``through`` if it is given: a compacted base, if there is one, and the
        epochs after it."""
        epochs = [e for e in self.epochs() if through is None or e <= through]
        bases = [b for b in self._bases() if through is None or b <= through]
        if not bases:
            if through is not None:
                self._require_whole(epochs or self.epochs(), -1)
                return latest_per_key(self.batches(-1, through), key, [F.col("epoch").desc()]).drop("epoch")
            return latest_per_key(self.batches(), key, [F.col("epoch").desc()]).drop("epoch")
        rows = self.spark.read.parquet(f"{self.path}/base/through={bases[-1]}").withColumn("epoch", F.lit(bases[-1]).cast("bigint"))
        newer = [e for e in epochs if e > bases[-1]]
        if newer:
            self._require_whole(newer, bases[-1])
            rows = rows.unionByName(self._rows(newer))
        return latest_per_key(rows, key, [F.col("epoch").desc()]).drop("epoch")

    def newest_epoch(self, through: int | None = None) -> DataFrame:
        """The rows of the last epoch, or of ``through``: the whole result when each epoch holds all of it."""
        epochs = self.epochs()
        last = next((e for e in reversed(epochs) if through is None or e <= through), None)
        if last is None:
            raise EventError(SUBSCRIPTION_FAILED, f"{self.path} has no epoch {'yet' if not epochs else f'up to {through}'}")
        return self.batches(last - 1, last).drop("epoch")

    def compact(self, key: list[str]) -> None:
        """Write the newest row per key as the base that ``latest`` starts from, so that old epochs can be dropped.

        The base before it stays, for readers that have begun with it.
        """
        epochs, bases = self.epochs(), self._bases()
        if not epochs or bases[-1:] == epochs[-1:]:
            return
        self.latest(key).write.mode("overwrite").parquet(f"{self.path}/base/through={epochs[-1]}")
        for old in bases[:-1]:
            remove(self.spark, f"{self.path}/base/through={old}")

    def expire(self, before: int, keyed: bool = False) -> None:
        """Drop the rows and barriers of epochs below ``before``; of a ``keyed`` journal only those that its base takes in."""
        gone = [e for e in self.epochs() if e < before]
        if keyed and gone and gone[-1] > (-1 if self._base() is None else self._base()):
            raise EventError(SUBSCRIPTION_FAILED, f"epoch {gone[-1]} of {self.path} is in no base yet: compact first")
        for epoch in gone:
            remove(self.spark, f"{self.path}/data/epoch={epoch}")
            remove(self.spark, f"{self.path}/barriers/n={epoch}")


class Subscription:
    """A consumer's position in a journal: at least once, in whole epochs.

    A consumer with a ``name`` keeps its position with the journal, one small file a position: whoever opens that name next,
    in this process or in another, goes on behind the last acknowledged epoch. One without a name starts at ``cursor``.
    """

    def __init__(self, journal: Journal, cursor: int = -1, name: str | None = None):
        if name is not None and not name.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"a consumer's name has letters, digits, - and _ only, not {name!r}")
        self.journal = journal
        self.name = name
        self.cursor = max([cursor, *self._kept()])
        self._closed = False

    @property
    def _folder(self) -> str:
        return f"{self.journal.path}/consumers/{self.name}"

    def _kept(self) -> list[int]:
        return numbered_files(self.journal.spark, self._folder) if self.name else []

    def lag(self) -> int:
        """Epochs with a barrier that this consumer has not read."""
        return len([e for e in self.journal.epochs() if e > self.cursor])

    def _pending(self) -> list[int]:
        if self._closed:
            raise EventError(SUBSCRIPTION_CLOSED, "the subscription is closed")
        pending = [e for e in self.journal.epochs() if e > self.cursor]
        if pending and pending[0] > self.cursor + 1:
            self._closed = True
            raise EventError(SUBSCRIPTION_FAILED, f"{pending[0] - self.cursor - 1} epochs expired before they were read")
        return pending

    def poll(self) -> DataFrame | None:
        """Rows from the cursor to the last barrier, or None if there is nothing new.

        The cursor moves only on ``acknowledge``, so rows polled and then lost are delivered again.
        """
        pending = self._pending()
        return self.journal.batches(self.cursor, pending[-1]) if pending else None

    def acknowledge(self, through_epoch: int) -> None:
        """The epochs up to ``through_epoch`` have been dealt with; never moves back."""
        if through_epoch <= self.cursor:
            return
        if self.name is not None:
            write_text(self.journal.spark, f"{self._folder}/{through_epoch}", "")
            for old in self._kept():
                if old < through_epoch:
                    remove(self.journal.spark, f"{self._folder}/{old}")
        self.cursor = through_epoch

    def consume(self, write: Callable[[DataFrame, int], object]) -> int:
        """Hand each pending epoch's rows and number to ``write`` and acknowledge it when ``write`` has returned; returns how many.

        An epoch whose ``write`` fails, or whose consumer is lost before the acknowledgement, is handed out again; a ``write``
        that replaces what it wrote for the same epoch thus has each row once. Epochs without rows are acknowledged only.
        """
        pending = self._pending()
        filled = {e for e, n in self._counts(pending) if n}
        for epoch in pending:
            if epoch in filled:
                write(self.journal.batches(epoch - 1, epoch).drop("epoch"), epoch)
            self.acknowledge(epoch)
        return len(pending)

    def _counts(self, epochs: list[int]) -> list[tuple[int, int]]:
        if not epochs:
            return []
        barriers = self.journal.barriers().filter(F.col("epoch").between(epochs[0], epochs[-1]))
        return [tuple(r) for r in barriers.select("epoch", "row_count").collect()]

    def close(self) -> None:
        self._closed = True
