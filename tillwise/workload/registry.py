"""The runnable queries and the SQL each one is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .tables import Data

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
CTES: dict[str, str] = {}


def define(**ctes: str) -> None:
    """Named SQL relations, each of which may use the ones before it."""
    for name, body in ctes.items():
        CTES[name] = body.strip()


def expand(body: str) -> str:
    """Put the relations a statement mentions in front of it."""
    used: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                visit(CTES[name])

    visit(body)
    if not used:
        return body.strip()
    parts = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in CTES if n in used)
    text = body.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {parts},\n{text[5:]}"
    return f"WITH {parts}\n{text}"


def query(name: str, sql: str | None = None) -> Callable:
    """Register a query on the tables; ``sql`` states the expected rows independently."""

    def register(fn: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is taken")
        QUERIES[name] = lambda spark, sf_dir: fn(Data(spark, sf_dir))
        if sql is not None:
            SQL[name] = expand(sql)
        return fn

    return register
