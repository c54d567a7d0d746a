"""The registered queries: each operator over the given tables, with the SQL it must equal."""

from tidemark.registry import aggregates, delivery, joins, scans  # noqa: F401  (they register themselves)
from tidemark.registry.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
