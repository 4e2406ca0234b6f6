"""Keep-first deduplication as a map-side-combined aggregate.

``row_number() = 1`` sorts every copy of a key in one task; ``max_by`` keeps one row per key and map task, so a
key shared by a third of the table costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def keep_best(df: DataFrame, keys: Sequence[str], preference: Column) -> DataFrame:
    """One whole row per key: the one with the greatest ``preference`` (an orderable column or struct)."""
    row = F.struct(*[F.col(c) for c in df.columns])
    best = df.groupBy(*keys).agg(F.max_by(row, preference).alias("_best"))
    return best.select("_best.*")


def oldest_then_latest_arrival(date: str, arrival: Sequence[str]) -> Column:
    """Preference of the oldest date, undated rows last, and on equal dates the latest arrival."""
    return F.struct(
        F.col(date).isNotNull().alias("dated"),
        (-F.unix_date(date)).alias("age"),
        *[F.col(a) for a in arrival])


def two_pass(df: DataFrame, first: Sequence[str], second: Sequence[str], preference: Column, row: Sequence[str]) -> DataFrame:
    """Keep one row per ``first`` key, then one per ``second`` key; ``row`` names columns that tell the rows apart.

    The passes stay separate: a row dropped by the first must not win the second. Both work on keys, preference and ``row``
    alone; the other columns, texts among them, are fetched at the end for the rows that stay, and move once at most.
    """
    narrow = df.select(*dict.fromkeys([*first, *second, *row]), preference.alias("_preference"))
    best = keep_best(keep_best(narrow, first, F.col("_preference")), second, F.col("_preference"))
    return df.join(best.select(*row), list(row), "left_semi")
