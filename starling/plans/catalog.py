"""All registered queries."""

from starling.plans import (  # noqa: F401
    analytics_queries,
    curate_queries,
    ingest_queries,
    storage_queries,
)
from starling.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
