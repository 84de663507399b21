"""Every registered query of the library with the SQL that it must equal."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from docflow.runtime import shipped

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = ("text_queries", "quality_queries", "structure_queries", "document_queries", "metric_queries", "image_queries", "model_queries")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with its oracle."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = shipped(f)
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def load() -> None:
    for m in MODULES:
        import_module(f"docflow.plans.{m}")


def queries() -> dict[str, Query]:
    load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load()
    return dict(ORACLES)
