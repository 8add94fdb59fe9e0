"""Registered queries: every operator on the given tables, beside the same query in plain SQL."""

from millrace.queries import clean, io, marts, measures, mining, transform, validate, warehouse  # noqa: F401
from millrace.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
