"""All registered queries."""

from caresift.plans import (  # noqa: F401
    evolve_queries,
    metric_queries,
    model_queries,
    scoring_queries,
    selection_queries,
    table_queries,
    text_queries,
)
from caresift.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
