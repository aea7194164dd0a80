"""All registered queries; importing the query modules registers them."""

from __future__ import annotations

from caretide.plans import (  # noqa: F401
    evaluation_queries,
    explore_queries,
    feature_queries,
    model_queries,
    serving_queries,
    source_queries,
)
from caretide.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
