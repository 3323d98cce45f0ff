"""Queries over the given tables, each with the same question in plain SQL."""

from driver_queries import documents, drug, functions, loads, music, quality  # noqa: F401  (they register themselves)
from driver_queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
