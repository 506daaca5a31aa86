"""Registered queries with their SQL checks."""

from tickerlake.registry import cleaning, pages, relational, reports, scoring, storage, timeseries  # noqa: F401
from tickerlake.registry.core import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
