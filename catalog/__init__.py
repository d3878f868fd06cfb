"""Runnable examples of every operator on the test tables, with SQL to check them by."""

from catalog import cleaning, edges, files, joins, profiles, relations, schema  # noqa: F401
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
