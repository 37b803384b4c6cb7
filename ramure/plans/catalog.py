"""Importing this module registers every query."""

from ramure.plans import (  # noqa: F401
    analytics_queries, evaluation_queries, learning_queries, level_queries, model_queries, request_queries, text_queries,
)
from ramure.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
