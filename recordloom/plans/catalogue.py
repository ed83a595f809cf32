"""All registered queries."""

from __future__ import annotations

from recordloom.plans import (  # noqa: F401
    ledger_queries,
    record_queries,
    storage_queries,
    text_queries,
)
from recordloom.plans.registry import ORACLES, QUERIES, Query

__all__ = ["ORACLES", "QUERIES", "Query"]
