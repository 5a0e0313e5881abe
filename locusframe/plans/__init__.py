"""Registered queries by subject."""

from . import assembly_queries, format_queries, interval_queries, read_queries, scaffold_queries, variant_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
