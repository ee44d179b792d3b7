"""Registered queries (Spark plan + DuckDB oracle per operator)."""

from . import (catalog, io_queries, metric_queries, model_queries, resample_queries,  # noqa: F401
               iterative_queries, validation_queries,
               survival_queries)  # modules register their queries on import
from .registry import ORACLE, QUERIES  # noqa: F401
