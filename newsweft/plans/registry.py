"""Registered queries: name -> (DataFrame function, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
FIXTURES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
FIXTURE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def fixture(sql: str | None = None):
    """As ``query``, for rules checked on boundary rows written out beside them: run by the tests, not part of the catalogue."""

    def add(f):
        FIXTURES[f.__name__] = f
        if sql:
            FIXTURE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal(columns: str, rows: list[tuple]) -> str:
    """SQL for literal rows, for queries over fixed boundary rows: ``columns`` as ``name TYPE, ..``."""

    def one(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool) or not isinstance(v, str):
            return str(v)
        return "'" + v.replace("'", "''") + "'"

    named = [c.split() for c in columns.split(",")]
    body = ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)
    return f"SELECT {', '.join(f'CAST({n} AS {t}) AS {n}' for n, t in named)} FROM (VALUES {body}) v({', '.join(n for n, _ in named)})"
