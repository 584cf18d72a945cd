"""Registered queries on the given tables."""

from vellum.plans import listing_queries, reader_queries, register_queries, relation_queries, report_line_queries, report_queries  # noqa: F401
from vellum.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
