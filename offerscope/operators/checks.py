"""Constraint checks reported as rows, since files enforce none."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def column_rules(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """Violations of row conditions, all counted in one pass: rule name -> condition that must hold."""
    counts = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    pairs = ", ".join(f"'{name}', `{name}`" for name in rules)
    return counts.select(F.lit(table).alias("table"), F.expr(f"stack({len(rules)}, {pairs}) AS (rule, violations)"))


def not_null(*columns: str) -> dict[str, Column]:
    return {f"{c} not null": F.col(c).isNotNull() for c in columns}


def primary_key(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Key values met more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table"), F.lit(f"primary key ({', '.join(keys)})").alias("rule"), "violations")


def foreign_key(df: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Rows whose key has no parent."""
    parents = parent.select(F.col(parent_key or key).alias(key))
    orphans = df.where(F.col(key).isNotNull()).select(key).join(parents, key, "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table"), F.lit(f"foreign key ({key})").alias("rule"), "violations")


def report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
