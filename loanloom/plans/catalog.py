"""All registered queries; importing the modules fills the registry."""

from loanloom.plans import (  # noqa: F401
    decision_queries,
    detail_queries,
    encode_queries,
    model_queries,
    quality_queries,
    ranking_queries,
    scoring_queries,
    stats_queries,
)
from loanloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
