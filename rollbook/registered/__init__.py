"""The operators as named queries over the given tables, each with the SQL it must equal."""

from . import aggregates, filters, jobs, joins, merges, ordering, scalars, sources, streams
from .registry import QUERIES, SQL

__all__ = [
    "QUERIES",
    "SQL",
    "aggregates",
    "filters",
    "jobs",
    "joins",
    "merges",
    "ordering",
    "scalars",
    "sources",
    "streams",
]
