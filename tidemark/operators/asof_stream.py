"""As-of join of two streams, on the engine's keyed state and event-time timers.

Rows are grouped by key and slice of event time, a slice being as long as rows are retained (or a part of that). A left row belongs to its own
slice; a right row to its own and to those that can still see it, in which only the last one of each batch is kept. A timer
fires when the watermark has passed the first left row that waits, and what has become final then is matched. Right
rows behind the watermark are reduced to the last one at the same time, and a slice that is over is cleared, so idle keys leave nothing
behind and cost nothing in between. The engine keeps the watermark, the state and its checkpoints.

A group costs several calls between Python and the engine, whatever it holds. Where there are many keys of few rows each, keys can
share groups; the rows in state then carry their keys, and each key is matched for itself.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.event_time import as_wall_clock, seconds_of
from tidemark.operators.joins import check_distinct_names, check_join_keys
from tidemark.operators.stateful import NO_TIME, mark, micros, require_watermark, row_of, row_text
from tidemark.plans.admission import AdmissionError
from tidemark.sources.definitions import without_heartbeats

RIGHT, LEFT, VISITOR = 0, 1, 2
SENT = ["_side", "_keys", "_at", "_has_tie", "_number", "_word", "_row"]  # the last columns of a group, which come without their names
OPEN, HISTORY = "at long, row string", "at long, has_tie int, number long, word string, row string"
# In groups that several keys share: up to PACK rows in one, column by column, since each row of state is pickled by itself.
PACK = 1000
OPEN_PACK = "keys array<string>, at array<long>, row array<string>"
HISTORY_PACK = "keys array<string>, at array<long>, has_tie array<int>, number array<long>, word array<string>, row array<string>"


def asof_stream(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], left_ts: str, right_ts: str, tie: str,
                retention: str, slices: int = 1, salts: int = 1, shared: int | None = None) -> DataFrame:
    """Left rows with the latest right row of their key at or before them that is no older than ``retention``.

    Append mode. A left row appears once the smaller of the two watermarks has passed it; among equal times the greatest
    ``tie`` (BIGINT or VARCHAR) wins. NULL keys match nothing. Rows behind the watermark, or without an event time, take no
    part and come out at once with ``_late`` true and the other side NULL; right rows with a NULL key are dropped.

    A hot key is spread over ``slices`` parts of the retention, and its left rows over ``salts`` parts; each right row goes to ``salts``
    times one more than ``slices`` groups.

    By default each key has groups of its own. With ``shared`` the keys of a slice are dealt over that many groups by hash: the number of
    groups then depends on the time span and not on the keys, and a batch reads the state of those groups it brings rows for. A
    group's state, a slice's rows over ``shared``, is in memory at once. A checkpoint goes on with the same choice only.
    """
    require_watermark(left, left_ts, "an as-of join of streams")
    require_watermark(right, right_ts, "an as-of join of streams")
    left, right = without_heartbeats(left), without_heartbeats(right)
    check_join_keys(left, right, on)
    check_distinct_names(left, right)
    tie_type = right.schema[tie].dataType
    if not isinstance(tie_type, T.LongType | T.StringType):
        raise AdmissionError(f"tie-break {tie} must be bigint or string")
    kept = seconds_of(retention) * 1_000_000
    width = -(-kept // slices)
    number, word = (F.col(tie), F.lit("")) if isinstance(tie_type, T.LongType) else (F.lit(0), F.col(tie))
    own = F.floor(F.col("_at") / width).cast("long")
    rows = _tagged(left, [l for l, _ in on], left_ts, F.lit(0), F.lit(0), F.lit("")).select(
        "*", F.lit(LEFT).alias("_side"), own.alias("_slice"), F.pmod(F.xxhash64("_row"), F.lit(salts)).alias("_salt"))
    for _, r in on:
        right = right.filter(F.col(r).isNotNull())
    places = F.transform(F.sequence(F.lit(0), F.lit(slices)), lambda i: F.struct((own + i).alias("slice"), F.when(i == 0, RIGHT).otherwise(VISITOR).alias("side")))
    places = F.when(F.col("_at") == NO_TIME, F.slice(places, 1, 1)).otherwise(places)
    visits = _tagged(right, [r for _, r in on], right_ts, F.col(tie).isNotNull().cast("int"), number, word).withColumn("_place", F.explode(places))
    visits = visits.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    side = F.when((F.col("_place.side") == RIGHT) & (F.col("_salt") > 0), VISITOR).otherwise(F.col("_place.side"))
    rows = rows.unionByName(visits.select("*", side.alias("_side"), F.col("_place.slice").alias("_slice")).drop("_place"))
    names = [f"_key{i}" for i in range(len(on))]
    if shared is None:
        # A NULL in a group's key would reach Python as another type, so it is a mark of its own.
        blanks = {n: F.coalesce(n, F.lit("" if rows.schema[n].dataType == T.StringType() else 0)) for n in names}
        rows = rows.withColumn("_without", sum((F.col(n).isNull().cast("int") * 2 ** i for i, n in enumerate(names)), F.lit(0))).withColumns(blanks)
        rows, group = rows.withColumn("_keys", F.lit("")), [*names, "_without", "_slice", "_salt"]
    else:
        rows = rows.withColumn("_keys", F.to_json(F.struct(*names))).withColumn("_group", F.pmod(F.xxhash64("_keys"), F.lit(shared)))
        group = ["_group", "_slice", "_salt"]
    groups = rows.select(*group, mark(), *SENT).groupBy(*group)
    found = groups.transformWithStateInPandas(_Asof(kept, width, shared is not None), "_left string, _right string, _late boolean", "Append", "EventTime")
    return found.select(row_of("_left", as_wall_clock(left).schema).alias("_left"), row_of("_right", as_wall_clock(right).schema).alias("_right"),
                        "_late").select("_left.*", "_right.*", "_late")


def _tagged(side: DataFrame, keys: list[str], ts: str, has_tie: Column, number: Column, word: Column) -> DataFrame:
    clock = as_wall_clock(side.withColumn("_at", micros(ts)))
    return clock.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_at", has_tie.cast("int").alias("_has_tie"),
                        F.coalesce(number.cast("long"), F.lit(0)).alias("_number"), F.coalesce(word, F.lit("")).alias("_word"),
                        row_text(clock.drop("_at")).alias("_row"))


class _Asof(StatefulProcessor):
    """A slice of one key, or of the keys that share a group: left rows that wait, and the right rows they may still need.

    Rows begin with their keys' text; it is kept in state where keys share a group and is empty elsewhere.
    """

    def __init__(self, kept: int, width: int, shared: bool):
        self.kept, self.width, self.shared = kept, width, shared

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", OPEN_PACK if self.shared else OPEN)
        self.history = handle.getListState("history", HISTORY_PACK if self.shared else HISTORY)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting, right, visitors, late = [], [], {}, []
        for chunk in rows:
            for side, keys, at, has_tie, number, word, row in zip(*(chunk.iloc[:, i].tolist() for i in range(-len(SENT), 0)), strict=True):
                if at < passed:
                    if side != VISITOR:
                        late.append((row, None, True) if side == LEFT else (None, row, True))
                elif side == LEFT:
                    waiting.append((keys, at, row))
                else:
                    entry = (keys, at, has_tie, number, word, row)
                    if self._own(key, at):
                        right.append(entry)
                    else:
                        visitors[keys] = max(visitors.get(keys, entry), entry)
        right += visitors.values()
        if waiting:
            self.open.appendList(self._stored(waiting))
        if right:
            self.history.appendList(self._stored(right))
        if waiting or right:
            self.handle.registerTimer((min(w[1] for w in waiting) if waiting else max(r[1] for r in right)) // 1000)
        if late:
            yield _out(late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        passed, waiting, right = watermark * 1000, self._sorted(self.open), self._sorted(self.history)
        history = {keys: list(rows) for keys, rows in groupby(right, itemgetter(0))}
        found, rest, needed = [], [], []
        for keys, group in groupby(waiting, itemgetter(0)):
            rows, seen = list(group), history.get(keys, [])
            known = [r[1] for r in seen]
            final = bisect_right(rows, passed - 1, key=itemgetter(1))
            for _, at, row in rows[:final]:
                place = bisect_right(known, at) - 1
                found.append((row, seen[place][5] if place >= 0 and known[place] >= at - self.kept else None, False))
            rest += rows[final:]
        over = watermark >= self._end(key)
        if not over:
            for rows in history.values():
                needed += rows[max(0, bisect_right(rows, passed - 1, key=itemgetter(1)) - 1):]
            first = min((w[1] for w in rest), default=None)
            self.handle.registerTimer(max(self._end(key) if first is None else first // 1000, watermark + 1))
        _keep(self.open, self._stored(rest), len(waiting) - len(rest))
        _keep(self.history, self._stored(needed), len(right) - len(needed))
        if found:
            yield _out(found)

    def _stored(self, rows: list[tuple]) -> list[tuple]:
        if not self.shared:
            return [r[1:] for r in rows]
        return [tuple(map(list, zip(*rows[i:i + PACK], strict=True))) for i in range(0, len(rows), PACK)]

    def _sorted(self, state) -> list[tuple]:
        if not self.shared:
            return sorted(("", *r) for r in state.get())
        return sorted(row for pack in state.get() for row in zip(*pack, strict=True))

    def _own(self, key, at: int) -> bool:
        return at // self.width == key[-2]

    def _end(self, key) -> int:
        return -(-(key[-2] + 1) * self.width // 1000)

    def close(self) -> None: ...


def _keep(state, rows: list[tuple], gone: int) -> None:
    if gone and rows:
        state.put(rows)
    elif gone:
        state.clear()


def _out(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["_left", "_right", "_late"])
