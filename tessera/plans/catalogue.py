"""The query catalogue: name -> query, and name -> SQL of the same rows."""

from __future__ import annotations

from tessera.plans import cohort_queries, quality_queries, text_queries  # noqa: F401  they register
from tessera.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
