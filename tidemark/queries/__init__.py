"""Queries over the sample tables, each beside the SQL it must agree with."""

from tidemark.queries import enrich, ingest, loads, promotion, report, runs  # noqa: F401  (they register queries)
from tidemark.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
