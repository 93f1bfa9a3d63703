"""All registered queries, each with its answer in SQL where SQL can express it."""

from duebook.catalog import facts, features, landing, privacy, quality, skew  # noqa: F401
from duebook.catalog.registry import ANSWERS, QUERIES

__all__ = ["ANSWERS", "QUERIES"]
