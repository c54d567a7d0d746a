"""Checks on streaming queries before they start.

Spark itself refuses sorts on streams, unbounded outer joins and appended aggregates without a
watermark. It starts, and then lets state grow without limit, on an inner stream-stream join that has
no watermark or no time range; cross and theta joins fail only once the query runs. These are refused
here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

WATERMARK_KEY = "spark.watermarkDelayMs"
# Comparison node -> what it says about its first operand.
BOUNDS = {"GreaterThan": "from", "GreaterThanOrEqual": "from", "LessThan": "to", "LessThanOrEqual": "to"}


class AdmissionError(ValueError):
    """The query would need unbounded state or has a shape that streams do not support."""


def check_stream_plan(frame: DataFrame) -> DataFrame:
    """Returns ``frame`` if every part of it can run with bounded state."""
    if frame.isStreaming:
        # Optimized, because that is where BETWEEN and filters over a join become join conditions.
        optimizer = frame.sparkSession._jsparkSession.sessionState().optimizer()
        _check(optimizer.execute(frame._jdf.queryExecution().analyzed()))
    return frame


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _check(plan, limited: bool = False) -> None:
    name = plan.nodeName()
    if name == "Sort" and plan.isStreaming() and not limited:
        raise AdmissionError("ORDER BY without LIMIT is not supported on unbounded streams")
    if name == "Join":
        children = _items(plan.children())
        if all(child.isStreaming() for child in children):
            _check_join(plan, *children)
    for child in _items(plan.children()):
        _check(child, limited=name in ("GlobalLimit", "LocalLimit"))


def _check_join(join, left, right) -> None:
    if join.condition().isEmpty():
        raise AdmissionError("cross joins of two streams are not supported")
    l_ids, r_ids = _ids(left.output()), _ids(right.output())
    l_times, r_times = _event_times(left.output()), _event_times(right.output())
    if not l_times or not r_times:
        raise AdmissionError("both sides of a stream-stream join need a watermark")
    equal, bounds = False, set()
    for c in _conjuncts(join.condition().get()):
        if c.nodeName() != "EqualTo" and c.nodeName() not in BOUNDS:
            continue
        one, two = (_ids(side.references().toSeq()) for side in _items(c.children()))
        if c.nodeName() == "EqualTo":
            equal |= bool(one & l_ids and two & r_ids) or bool(one & r_ids and two & l_ids)
        elif one & l_times and two & r_times:
            bounds.add(BOUNDS[c.nodeName()])
        elif one & r_times and two & l_times:
            bounds.add("to" if BOUNDS[c.nodeName()] == "from" else "from")
    if not equal:
        raise AdmissionError("a stream-stream join needs an equality key")
    if len(bounds) < 2:
        raise AdmissionError("a stream-stream join needs a time range between the two event times, closed at both ends")


def _conjuncts(expression) -> list:
    if expression.nodeName() == "And":
        return [c for child in _items(expression.children()) for c in _conjuncts(child)]
    return [expression]


def _ids(attributes) -> set[int]:
    return {a.exprId().id() for a in _items(attributes)}


def _event_times(attributes) -> set[int]:
    return {a.exprId().id() for a in _items(attributes) if a.metadata().contains(WATERMARK_KEY)}
