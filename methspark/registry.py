"""Queries and their SQL by operator key."""

from __future__ import annotations

from .plans import more  # noqa: F401  registers its queries
from .plans.queries import ORACLE, QUERIES

ENTRY = "read_level_metrics"

__all__ = ["ENTRY", "ORACLE", "QUERIES"]
