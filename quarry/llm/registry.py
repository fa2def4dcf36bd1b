"""Queries of this package: ``(spark, sf_dir)`` builders and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn
    return deco
