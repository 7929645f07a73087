"""Loads every query module, which fills the registry."""

from reviewlens.plans import (  # noqa: F401
    balance_queries,
    dashboard_queries,
    evaluation_queries,
    learning_queries,
    moderation,
    policy_queries,
    profile_queries,
    similarity_queries,
    source_queries,
    stream_queries,
    text_queries,
)
from reviewlens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
