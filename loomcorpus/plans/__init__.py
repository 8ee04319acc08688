"""All registered queries and their checking SQL."""

from loomcorpus.plans import analytics_queries, catalogue_queries, knowledge_queries, more_queries, rule_queries, storage_queries  # noqa: F401
from loomcorpus.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
