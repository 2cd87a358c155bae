"""Registered queries with their SQL twins."""

from streamgauge.catalog.registry import all_oracles, all_queries

__all__ = ["all_oracles", "all_queries"]
