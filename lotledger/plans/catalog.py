"""All registered queries."""

from . import page_queries, state_queries, vehicle_queries  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
