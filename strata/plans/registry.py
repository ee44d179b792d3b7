"""Query registry shared by the catalog modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..specs import SplitSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Periods of the stand-in data (order years 1995-2001).
STANDIN_SPLIT = SplitSpec(1995, 1998, 1999, 2001, None, None, None, enforce_counts=False)


def register(name: str, sql: str | None = None):
    """Register a query (and its DuckDB oracle, when SQL can express it)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def d6(expr: str) -> str:
    """DuckDB side of the 6-place rounding applied to every double."""
    return f"round(CAST({expr} AS DOUBLE), 6) + 0.0"
