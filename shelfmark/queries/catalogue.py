"""All registered queries."""

from shelfmark.queries import cleaning, deduping, filtering, joining, rollups, scores, texts  # noqa: F401
from shelfmark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
