"""As-of joins: each left row with the latest right row of its key at or before its event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.event_time import interval, seconds_of, time_bucket
from tidemark.operators.joins import check_distinct_names, check_join_keys


def asof_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], left_ts: str, right_ts: str,
              tie: str, retention: str | None = None, slice: str = "1 hour") -> DataFrame:
    """Left outer as-of join of static tables.

    Among right rows with the same key and time the greatest ``tie`` wins; a right row at exactly the
    left row's time counts. With ``retention`` a right row older than that is no longer seen. NULL keys
    match nothing.

    Both sides are cut into slices of event time. Within a key and slice they are sorted together and the last right
    row is carried forward: no candidate pairs, and no task sorts more than one key's rows of one slice. Each
    slice starts with the last right row of the key's slices before it; one row per key and slice is all that crosses slices.
    """
    check_join_keys(left, right, on)
    check_distinct_names(left, right)
    tagged = _tagged(left, right, on, left_ts, right_ts, tie, seconds_of(slice))
    keys = [f"_key{i}" for i in range(len(on))]
    started = tagged.unionByName(_seeds(tagged, keys), allowMissingColumns=True)
    order = Window.partitionBy(*keys, "_slice").orderBy("_ts", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    carried = F.last("_right", ignorenulls=True).over(order)
    if retention is not None:
        fresh = F.col("_found._at") >= F.col("_ts") - interval(retention)
        found = F.when(fresh, F.col("_found"))
    else:
        found = F.col("_found")
    matched = started.withColumn("_found", carried).filter(F.col("_side") == 1).withColumn("_found", found)
    return matched.select(*[F.col(f"_left.{c}").alias(c) for c in left.columns],
                          *[F.col(f"_found.{c}").alias(c) for c in right.columns])


def _tagged(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str, tie: str, width: int) -> DataFrame:
    """Both sides in one shape: right rows (side 0) sort before left rows (side 1) of the same time."""
    l_keys = [F.col(l).alias(f"_key{i}") for i, (l, _) in enumerate(on)]
    r_keys = [F.col(r).alias(f"_key{i}") for i, (_, r) in enumerate(on)]
    usable = F.col(right_ts).isNotNull()
    for _, r in on:
        usable = usable & F.col(r).isNotNull()
    tie_type = right.schema[tie].dataType
    probes = left.select(
        *l_keys, F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"), F.lit(None).cast(tie_type).alias("_tie"),
        time_bucket(left_ts, left, width).alias("_slice"),
        F.struct(*left.columns).alias("_left"))
    history = right.filter(usable).select(
        *r_keys, F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"),
        time_bucket(right_ts, right, width).alias("_slice"),
        F.struct(*right.columns, F.col(right_ts).alias("_at")).alias("_right"))
    return probes.unionByName(history, allowMissingColumns=True)


def _seeds(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """For each slice of a key that holds left rows, the key's last right row of the slices before it."""
    newest = F.max_by(F.struct("_ts", "_tie", "_right"), F.when(F.col("_side") == 0, F.struct("_ts", "_tie")))
    heads = tagged.groupBy(*keys, "_slice").agg(newest.alias("_newest"), F.min("_side").alias("_least"), F.max("_side").alias("_most"))
    heads = heads.withColumn("_newest", F.when(F.col("_least") == 0, F.col("_newest")))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    seeds = heads.withColumn("_seed", F.last("_newest", ignorenulls=True).over(before)).filter(F.col("_seed").isNotNull() & (F.col("_most") == 1))
    return seeds.select(*keys, "_slice", F.col("_seed._ts").alias("_ts"), F.lit(0).alias("_side"),
                        F.col("_seed._tie").alias("_tie"), F.col("_seed._right").alias("_right"))
