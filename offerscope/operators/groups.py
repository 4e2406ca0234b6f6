"""Group summaries: shares, totals, rankings, pivots, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from offerscope.functions.text import percent


def share_within(df: DataFrame, groups: Sequence[str], by: str, count: str = "n", share: str = "share_pct",
                 digits: int = 1) -> DataFrame:
    """Rows per (groups, by) and their percentage inside ``groups``; the window runs over the aggregate."""
    counted = df.groupBy(*groups, by).agg(F.count(F.lit(1)).alias(count))
    whole = F.sum(count).over(Window.partitionBy(*groups))
    return counted.withColumn(share, percent(F.col(count), whole, digits))


def with_grand_total(df: DataFrame, group: str, by: Sequence[str], total_label: str, measure: Column,
                     name: str = "n") -> DataFrame:
    """One aggregate per (group, by) plus one over all groups labelled ``total_label``.

    ``is_total`` marks the total rows so that nobody adds them to the groups; a NULL group is never taken for one.
    """
    spec = [F.col(group), *[F.col(b) for b in by]]
    totals = [F.col(b) for b in by]
    out = df.groupingSets([spec, totals], *spec).agg(F.grouping(group).alias("is_total"), measure.alias(name))
    label = F.when(F.col("is_total") == 1, F.lit(total_label)).otherwise(F.col(group))
    return out.withColumn(group, label).withColumn("is_total", F.col("is_total") == 1)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Report of the first ``n`` rows with their rank; the order must be total."""
    best = df.orderBy(*order).limit(n)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)))


def top_n_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int,
                    rank: str = "rank") -> DataFrame:
    """First ``n`` rows of each group; the planner cuts each map task to ``n`` rows before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*groups).orderBy(*order))) \
             .where(F.col(rank) <= n)


def rank_within(df: DataFrame, groups: Sequence[str], order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """Competition ranking: ties share a rank and leave a gap."""
    return df.withColumn(rank, F.rank().over(Window.partitionBy(*groups).orderBy(*order)))


def rank_by(df: DataFrame, groups: Sequence[str], value: str, rank: str = "rank") -> DataFrame:
    """Competition ranking by falling ``value`` where many rows tie: equal values are counted first, so that only a
    group's distinct values are ordered, and the rows look their rank up. Groups and values must not be NULL."""
    counts = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_rows"))
    above = Window.partitionBy(*groups).orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select(*groups, value, (F.coalesce(F.sum("_rows").over(above), F.lit(0)) + 1).cast("int").alias(rank))
    return df.join(ranks, [*groups, value])


def weighted_mean(df: DataFrame, groups: Sequence[str], value: str, weight: str, name: str) -> DataFrame:
    return df.groupBy(*groups).agg(
        F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias(name))


def fixed_bins(df: DataFrame, value: str, start: float, stop: float, width: float) -> DataFrame:
    """Counts per half-open bin of ``width`` in [start, stop]; the last bin includes ``stop``."""
    last = stop - width
    low = F.least(F.floor((F.col(value) - start) / width) * width + start, F.lit(last))
    return (df.where(F.col(value).between(start, stop))
            .groupBy(low.cast("double").alias("bin_start")).agg(F.count(F.lit(1)).alias("n")))


def crosstab(df: DataFrame, group: str, by: str, categories: Sequence[str]) -> DataFrame:
    """Row-normalised cross table in percent; categories never met are 0."""
    counts = [F.count_if(F.col(by) == c).alias(f"_{i}") for i, c in enumerate(categories)]
    table = df.groupBy(group).agg(F.count(F.lit(1)).alias("_all"), *counts)
    return table.select(group, *[percent(F.col(f"_{i}"), F.col("_all"), 4).alias(c)
                                 for i, c in enumerate(categories)])


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted if n is None else top_n(counted, [F.desc("n"), F.asc(column)], n).drop("rank")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """A repeatable sample of ``n`` rows: those with the smallest digest of (key, seed)."""
    draw = F.md5(F.concat_ws(":", F.col(key), F.lit(str(seed))))
    return df.orderBy(draw, F.col(key)).limit(n)


def share_of_total(df: DataFrame, groups: Sequence[str], measures: Sequence[Column], total: Column,
                   count: str = "n", share: str = "share_pct", digits: int = 2) -> DataFrame:
    """Group sizes with their percentage in ``total`` (a scalar), beside other measures."""
    out = df.groupBy(*groups).agg(F.count(F.lit(1)).alias(count), *measures)
    return out.withColumn(share, percent(F.col(count), total, digits))
