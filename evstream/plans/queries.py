"""All registered queries and their SQL twins."""

from evstream.plans import run_queries, sink_queries, stream_queries, table_queries  # noqa: F401  (register)
from evstream.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
