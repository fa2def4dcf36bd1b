"""Registry of named queries: a Spark builder and, where SQL can say it, DuckDB SQL.

Every builder takes ``(spark, sf_dir)`` and reads the driver tables (or data Spark derives
from them), so its work grows with the tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    doc: str


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql.strip() if sql else None, (fn.__doc__ or "").strip())
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # importing the catalog modules fills QUERIES
    from quarry.plans import catalog  # noqa: F401
    return QUERIES
