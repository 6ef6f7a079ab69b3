"""Queries over the given tables, one or more per operator, with their SQL."""

from __future__ import annotations

from . import basics, grouping, jobs, landing, quality  # noqa: F401
from .registry import QUERIES, SQL


def all_queries():
    return QUERIES


def all_sql():
    return SQL
