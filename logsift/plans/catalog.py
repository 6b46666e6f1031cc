"""Registry of named queries: a Spark builder and, where SQL can express it,
an independent DuckDB oracle.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables (nothing sampled, capped or filtered to keep checks cheap).
Computed columns carry the same names on both sides; doubles are rounded to
6 places on both sides where float summation order could differ.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    section: str


REGISTRY: dict[str, Query] = {}


def query(key: str, section: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``."""

    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, sql, section)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import the modules that register queries, then return the registry."""
    from logsift.plans import (  # noqa: F401
        q_alerts, q_io, q_parse, q_reports, q_runs, q_streaming,
    )

    return REGISTRY
