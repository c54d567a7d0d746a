"""Event-time tables and streams on Spark."""

from tidemark.operators.aggregates import closed_windows, keyed, tumble
from tidemark.operators.asof import asof_join
from tidemark.operators.asof_stream import asof_stream
from tidemark.operators.joins import interval_join
from tidemark.operators.topk import RunningTopK, top_k
from tidemark.plans.admission import AdmissionError, check_stream_plan
from tidemark.session import clear_workspaces
from tidemark.sources.conform import conform_or_fail, conform_rows
from tidemark.sources.definitions import Catalog, EventError, Field, Sink, Source, Stream, Table, sql_stream
from tidemark.sources.inline import values
from tidemark.sources.landing import Writer
from tidemark.sources.tables import KeyedTable, upsert
from tidemark.streaming.journal import Journal, Subscription
from tidemark.streaming.late import split_late
from tidemark.streaming.listener import Delivery, Listener, per_batch
from tidemark.streaming.run import Progress, Runner, current_watermark, drain, replay, start

__all__ = [
    "AdmissionError", "Catalog", "Delivery", "EventError", "Field", "Journal", "KeyedTable", "Listener", "Progress",
    "RunningTopK", "Runner", "Sink", "Source", "Stream", "Subscription", "Table", "Writer", "asof_join", "asof_stream",
    "check_stream_plan", "clear_workspaces", "closed_windows", "conform_or_fail", "conform_rows", "current_watermark",
    "drain", "interval_join", "keyed", "per_batch", "replay", "split_late", "sql_stream", "start", "top_k", "tumble", "upsert", "values",
]
