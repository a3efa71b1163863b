"""All queries: importing this module registers them."""

from __future__ import annotations

from . import cleaning, graphs, projections, relational, stages  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
