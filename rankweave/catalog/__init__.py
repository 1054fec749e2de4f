"""Registered queries, by area."""

from rankweave.catalog import evaluation, formats, learning, ranking_features, retrieval, training
from rankweave.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "evaluation", "formats", "learning", "ranking_features", "retrieval", "training"]
