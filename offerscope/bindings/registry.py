"""Registered queries: a Spark callable and, where SQL can state it, an independent SQL text for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Pieces of SQL text shared by the comparison queries.
def half_up(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(30,10)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str, digits: int = 1) -> str:
    return half_up(f"(CAST(100 AS DOUBLE) * ({part}) / ({whole}))", digits)


def ranked(source: str, keys: str, value: str) -> str:
    """A table with the rank and the group size of every non-NULL value."""
    by = f"PARTITION BY {keys}" if keys else ""
    select = f"{keys}, " if keys else ""
    return (f"(SELECT {select}{value} AS v, ROW_NUMBER() OVER ({by} ORDER BY {value}) AS rn,"
            f" COUNT(*) OVER ({by}) AS cnt FROM {source} WHERE {value} IS NOT NULL)")


MIDDLE = "rn IN ((cnt + 1) // 2, (cnt + 2) // 2)"


def nearest(p: float) -> str:
    return f"MAX(CASE WHEN rn = CAST(FLOOR({p} * (cnt - 1) + 0.5) AS BIGINT) + 1 THEN v END)"
