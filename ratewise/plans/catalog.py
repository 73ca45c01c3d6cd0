"""All named queries.  Importing a plan module registers its queries."""

from __future__ import annotations

from ratewise.plans import content, loading, maintenance, models, realtime, search, serving, statistics, streams  # noqa: F401
from ratewise.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
