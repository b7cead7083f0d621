"""Registered queries and their SQL counterparts over the driver's tables."""

from catalog import groups, jobs, landing, plans, rows, timeline, versions  # noqa: F401
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
