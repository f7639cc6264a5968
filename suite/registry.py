"""Where queries and their SQL are listed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def half_up_sql(expr: str, decimals: int = 6) -> str:
    return f"floor(({expr}) * 1e{decimals} + 0.5) / 1e{decimals}"


def values_sql(name: str, columns: str, rows: list[tuple]) -> str:
    """A literal table as a common table expression."""
    def item(v) -> str:
        return "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(item(v) for v in r) + ")" for r in rows)
    return f"{name}({columns}) AS (VALUES {body})"
