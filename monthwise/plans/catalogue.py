"""Imports every query module, which fills the registry."""

from monthwise.plans import (  # noqa: F401
    feature_queries,
    forecast_queries,
    ingest_queries,
    model_queries,
    monthly_queries,
    replay_queries,
    source_queries,
    stream_queries,
)
from monthwise.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
