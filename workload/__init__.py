"""Queries over the test tables, each beside an independent SQL statement of its result."""

from .registry import ORACLE, QUERIES
from . import history, indices, layers, market, payloads, reports  # noqa: F401  (fill the registry)

__all__ = ["ORACLE", "QUERIES"]
