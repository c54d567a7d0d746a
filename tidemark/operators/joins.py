"""Bounded event-time interval joins, for static tables and for streams.

``right.ts BETWEEN left.ts AND left.ts + bound`` on equal keys. An equi-join on the key alone would
send every row of a hot key to one task and compare all its pairs, so time is part of the join key:
rows meet in buckets of twice the bound. One side has a single home bucket; each row of the other
side visits the one or two buckets its partners can be in. A pair meets exactly once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.event_time import interval, seconds_of, time_bucket
from tidemark.plans.admission import AdmissionError
from tidemark.sources.definitions import without_heartbeats

KEY_TYPES = (T.StringType, T.LongType)
HOWS = ("inner", "left", "right", "full", "anti")


def check_join_keys(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> None:
    """Keys are VARCHAR or BIGINT columns whose types agree position by position."""
    if not on:
        raise AdmissionError("a join needs at least one equality key; cross joins are not admitted")
    for l_key, r_key in on:
        l_type, r_type = left.schema[l_key].dataType, right.schema[r_key].dataType
        if type(l_type) is not type(r_type) or not isinstance(l_type, KEY_TYPES):
            raise AdmissionError(
                f"join key {l_key} {l_type.simpleString()} = {r_key} {r_type.simpleString()}: "
                "keys must be string or bigint and of one type")


def check_distinct_names(left: DataFrame, right: DataFrame) -> None:
    shared = sorted(set(left.columns) & set(right.columns))
    if shared:
        raise AdmissionError(f"alias the columns both sides have: {', '.join(shared)}")


def interval_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], left_ts: str, right_ts: str,
                  bound: str, how: str = "inner", salts: tuple[int, int] = (1, 1)) -> DataFrame:
    """Join rows whose right event time lies in ``[left_ts, left_ts + bound]``.

    All columns of both sides come back (``anti``: only the left ones), so they must have distinct
    names. On streams, rows without a partner appear once the other side's watermark has passed every
    moment a partner could still arrive. NULL keys never match.

    Skew within one key and bucket: on static tables adaptive execution splits both sides of the inner join, and rows
    without a partner are found by a scan in slices of time, in which no side is held whole. On streams
    ``salts = (l, r)`` spreads each bucket's left rows over ``l`` and its right rows
    over ``r`` parts, at the price of as many copies of the other side. Where that spreads the side an outer join does not keep,
    a row has a copy in each of that side's parts, and is without a partner if every copy has come out without one; pairs then
    come from an inner join of their own.
    """
    if how not in HOWS:
        raise ValueError(f"how must be one of {HOWS}, got {how!r}")
    left, right = without_heartbeats(left), without_heartbeats(right)
    check_join_keys(left, right, on)
    check_distinct_names(left, right)
    names = left.columns + right.columns
    spec = (on, left_ts, right_ts, bound)
    if not (left.isStreaming or right.isStreaming):
        if how == "anti":
            return _unmatched_left(left, right, *spec)
        home, visiting = _right_visits(left, right, *spec, salts)
        joined = home.join(visiting, _condition(*spec), "inner").select(*names)
        if how in ("left", "full"):
            joined = joined.unionByName(_unmatched_left(left, right, *spec), allowMissingColumns=True)
        if how in ("right", "full"):
            joined = joined.unionByName(_unmatched_right(left, right, *spec), allowMissingColumns=True)
        return joined
    if (how in ("left", "anti") and salts[1] > 1) or (how == "right" and salts[0] > 1) or (how == "full" and salts != (1, 1)):
        parts = []
        if how != "anti":
            home, visiting = _right_visits(left, right, *spec, salts)
            parts.append(home.join(visiting, _condition(*spec), "inner").select(*names))
        if how != "right":
            few = right.select(*dict.fromkeys([*[r for _, r in on], right_ts]))
            home, visiting = _right_visits(left, few, *spec, salts)
            parts.append(_in_no_part(home.join(visiting, _condition(*spec), "left"), "_right_bucket", "_left_salt", left, left_ts, 0, salts[1]))
        if how in ("right", "full"):
            few = left.select(*dict.fromkeys([*[l for l, _ in on], left_ts]))
            visiting, home = _left_visits(few, right, *spec, salts)
            parts.append(_in_no_part(visiting.join(home, _condition(*spec), "right"), "_left_bucket", "_right_salt", right, right_ts, seconds_of(bound), salts[0]))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(*(left.columns if how == "anti" else names))
    if how == "full":
        # Spark's streaming full outer join pairs NULL keys, and only one side of a bucketed join
        # can be kept whole. So: all left rows with their partners, then right rows without one, for
        # which the state needs no more than the left rows' keys and times.
        matched = interval_join(left, right, *spec, "left")
        few = left.select(*dict.fromkeys([*[l for l, _ in on], left_ts]))
        visiting, home = _left_visits(few, right, *spec, salts)
        lonely = visiting.join(home, _condition(*spec), "right").filter(F.col("_left_bucket").isNull())
        return matched.unionByName(lonely.select(*right.columns), allowMissingColumns=True)
    if how == "right":
        visiting, home = _left_visits(left, right, *spec, salts)
        return visiting.join(home, _condition(*spec), "right").select(*names)
    home, visiting = _right_visits(left, right, *spec, salts)
    if how == "inner":
        return home.join(visiting, _condition(*spec), "inner").select(*names)
    matched = home.join(visiting, _condition(*spec), "left")
    if how == "anti":
        return matched.filter(F.col("_right_bucket").isNull()).select(*left.columns)
    return matched.select(*names)


def _in_no_part(joined: DataFrame, other_bucket: str, own_salt: str, kept: DataFrame, ts: str, earlier: int, parts: int) -> DataFrame:
    """Streamed rows that none of their ``parts`` copies found a partner for; repeated rows come back as often as they are.

    The engine moves event time behind a join as slowly as its left side is final, ``bound`` behind the watermark; right rows are final
    at it, so theirs is set back by as much (``earlier``) while they are counted.
    """
    due = (F.col(ts) - F.expr(f"INTERVAL '{earlier}' SECOND")).alias("_due", metadata=kept.schema[ts].metadata)
    own = [F.col(c).alias(c, metadata={}) if c == ts else F.col(c) for c in kept.columns]
    rows = joined.filter(F.col(other_bucket).isNull()).select(due, *own, own_salt)
    lonely = rows.groupBy("_due", *kept.columns).agg(F.collect_set(own_salt).alias("_cells"), F.count(F.lit(1)).alias("_copies"))
    times = F.explode(F.sequence(F.lit(1), (F.col("_copies") / parts).cast("int")))
    back = [F.col(c).alias(c, metadata=kept.schema[ts].metadata) if c == ts else F.col(c) for c in kept.columns]
    return lonely.filter(F.size("_cells") == parts).withColumn("_time", times).select(*back)


def _condition(on: list[tuple[str, str]], left_ts: str, right_ts: str, bound: str) -> Column:
    condition = (F.col("_left_bucket") == F.col("_right_bucket")) & (F.col("_left_salt") == F.col("_right_salt"))
    for l_key, r_key in on:
        condition = condition & (F.col(l_key) == F.col(r_key))
    return condition & F.col(right_ts).between(F.col(left_ts), F.col(left_ts) + interval(bound))


def _right_visits(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str, bound: str, salts: tuple[int, int]):
    width = 2 * seconds_of(bound)
    left = _salted(left, "_left_salt", salts[0], salts[1], own_first=True)
    right = _salted(right, "_right_salt", salts[1], salts[0], own_first=False)
    home = left.withColumn("_left_bucket", time_bucket(left_ts, left, width))
    reach = F.array(time_bucket(right_ts, right, width, -seconds_of(bound)), time_bucket(right_ts, right, width))
    return home, right.withColumn("_right_bucket", F.explode(F.array_distinct(reach)))


def _left_visits(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str, bound: str, salts: tuple[int, int]):
    width = 2 * seconds_of(bound)
    left = _salted(left, "_left_salt", salts[0], salts[1], own_first=True)
    right = _salted(right, "_right_salt", salts[1], salts[0], own_first=False)
    reach = F.array(time_bucket(left_ts, left, width), time_bucket(left_ts, left, width, seconds_of(bound)))
    visiting = left.withColumn("_left_bucket", F.explode(F.array_distinct(reach)))
    return visiting, right.withColumn("_right_bucket", time_bucket(right_ts, right, width))


def _salted(side: DataFrame, name: str, own: int, other: int, own_first: bool) -> DataFrame:
    """Number the cell(s) of the ``own`` x ``other`` grid a row goes to: its own part, with every part of the other side."""
    if own == other == 1:
        return side.withColumn(name, F.lit(0))
    part = F.pmod(F.xxhash64(*side.columns), F.lit(own)).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.lit(other - 1))) if other > 1 else F.lit(0)
    parted = side.withColumns({"_part": part}).withColumn("_other", others)
    cell = F.col("_part") * other + F.col("_other") if own_first else F.col("_other") * own + F.col("_part")
    return parted.withColumn(name, cell).drop("_part", "_other")


def _unmatched_left(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str, bound: str) -> DataFrame:
    """Static left rows without a partner: those whose next right row is more than ``bound`` away."""
    return _unmatched(left, right, on, left_ts, right_ts, seconds_of(bound), -1)


def _unmatched_right(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str, bound: str) -> DataFrame:
    """Static right rows without a partner: those whose last left row is more than ``bound`` before."""
    return _unmatched(right, left, [(r, l) for l, r in on], right_ts, left_ts, seconds_of(bound), 1)


def _unmatched(kept: DataFrame, other: DataFrame, on, kept_ts: str, other_ts: str, bound: int, way: int) -> DataFrame:
    """Rows of ``kept`` that the nearest row of ``other`` behind them (``way`` 1) or ahead of them (-1) is too far from.

    Rows of both sides are sorted together within key and slice of twice the bound, and the nearest time is carried along. A row of
    ``other`` goes to its own slice and, if rows of the neighbouring one reach it, to that one too; nothing else crosses slices.
    """
    keys = [f"_key{i}" for i in range(len(on))]
    width = 2 * bound
    rows = kept.select(*[F.col(k).alias(n) for (k, _), n in zip(on, keys, strict=True)], F.col(kept_ts).alias("_ts"), F.lit(1).alias("_side"),
                       time_bucket(kept_ts, kept, width).alias("_slice"), F.struct(*kept.columns).alias("_row"))
    for _, o in on:
        other = other.filter(F.col(o).isNotNull())
    places = F.array_distinct(F.array(time_bucket(other_ts, other, width), time_bucket(other_ts, other, width, way * bound)))
    partners = other.filter(F.col(other_ts).isNotNull()).select(*[F.col(o).alias(n) for (_, o), n in zip(on, keys, strict=True)], F.col(other_ts).alias("_ts"),
                                                                F.lit(0).alias("_side"), F.explode(places).alias("_slice"), F.col(other_ts).alias("_near"))
    order = Window.partitionBy(*keys, "_slice").orderBy(F.col("_ts").asc() if way > 0 else F.col("_ts").desc(), "_side")
    near = F.last("_near", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    scanned = rows.unionByName(partners, allowMissingColumns=True).withColumn("_near", near).filter(F.col("_side") == 1)
    reach = F.expr(f"INTERVAL '{bound}' SECOND")
    close = F.col("_near") >= F.col("_ts") - reach if way > 0 else F.col("_near") <= F.col("_ts") + reach
    return scanned.filter(~F.coalesce(close, F.lit(False))).select("_row.*")
