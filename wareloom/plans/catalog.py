"""All named queries in one place."""

from wareloom.plans import queries_boost, queries_clean, queries_model, queries_profile, queries_tables  # noqa: F401
from wareloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
