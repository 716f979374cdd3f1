"""Operators of a training-data pipeline. Nothing else in the library imports them."""

from . import queries
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "queries"]
