"""Exact order statistics without gathering a group in one task.

``median`` and ``percentile`` keep every distinct value of a group in one reducer. Here values are first counted
per *value bucket*: a monotone integer that splits each power of two into ``2**bits`` slices. Bucket counts are
combined on the map side, so a group holding a third of the table still arrives as a few thousand rows. Their running
totals tell which bucket holds a wanted rank. The values of that bucket alone are counted exactly, and the bucket is split once more,
by the next mantissa bits, so that many distinct values within a narrow range spread over tasks; only the distinct values of
the one slice that holds the rank are put in order. A slice spans less than 6e-8 of its values.

The input is read a second time for the rows of the wanted buckets only. The planner joins the two: it broadcasts the
wanted buckets if their measured size allows, and else meets them with the few rows of those buckets by a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

SLICE_BITS = 12
_KEY = ["_group"]


def value_bucket(value: Column, bits: int = SLICE_BITS) -> Column:
    """Monotone bucket number of a double: exponent first, then ``bits`` bits of the mantissa."""
    endless = F.abs(value) == float("inf")
    size = F.when(~endless, F.abs(value))
    exponent = F.floor(F.log2(size))
    fraction = size / F.pow(F.lit(2.0), exponent) - 1
    slices = 1 << bits
    number = (exponent + 1100) * slices + F.floor(fraction * slices)
    return F.when(value == 0, F.lit(0).cast("long")).when(endless, F.signum(value).cast("long") * 4000 * slices).when(value > 0, number).otherwise(-number)


def fine_slice(value: Column, bits: int = SLICE_BITS) -> Column:
    """Monotone number of a double inside its bucket: the ``bits`` mantissa bits that follow those of the bucket."""
    size = F.when(F.abs(value) != float("inf"), F.abs(value))
    scaled = (size / F.pow(F.lit(2.0), F.floor(F.log2(size))) - 1) * (1 << bits)
    number = F.floor((scaled - F.floor(scaled)) * (1 << bits)).cast("int")
    return F.coalesce(F.when(value > 0, number).when(value < 0, -number), F.lit(0))


@dataclass(frozen=True)
class Quantile:
    """One statistic: the wanted ranks as functions of the group size, and the share of the upper one.

    ``kind`` is ``median`` (mean of the two middle ranks), ``nearest`` (rank floor(p(n-1)+0.5)+1) or ``linear``
    (interpolated between neighbours).
    """

    name: str
    kind: str = "median"
    p: float = 0.5

    def ranks(self, n: Column) -> tuple[Column, Column]:
        n = n.cast("long")
        if self.kind == "median":
            return _div(n + 1, 2), _div(n + 2, 2)
        position = F.lit(self.p) * (n - 1)
        if self.kind == "nearest":
            rank = (F.floor(position + 0.5) + 1).cast("long")
            return rank, rank
        return (F.floor(position) + 1).cast("long"), (F.ceil(position) + 1).cast("long")

    def value(self, low: Column, high: Column, n: Column) -> Column:
        if self.kind == "median":
            return (low + high) / 2
        if self.kind == "nearest":
            return low
        position = F.lit(self.p) * (n - 1)
        return low + (high - low) * (position - F.floor(position))


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("long")


def _rank_columns(stats: Sequence[Quantile], n: Column) -> list[tuple[str, Column]]:
    out = []
    for i, q in enumerate(stats):
        low, high = q.ranks(n)
        out += [(f"_lo{i}", low), (f"_hi{i}", high)]
    return out


def prefix_counts(hist: DataFrame, groups: Sequence[str], value: str = "value", count: str = "count",
                  bits: int = SLICE_BITS) -> DataFrame:
    """Adds ``_upto`` (rows of the group with a value <= this one) and ``_n`` (rows of the group) to a histogram.

    ``hist`` holds one row per (groups, value). Values are put in order per (group, bucket, slice), slices per bucket, buckets
    per group; the numbers of slices and buckets are bounded by the bits they take.
    """
    keys = [*groups, "_bucket"]
    number = F.col(value).cast("double")
    spread = hist.withColumns({"_bucket": value_bucket(number, bits), "_fine": fine_slice(number, bits)})
    slices = spread.groupBy(*keys, "_fine").agg(F.sum(count).alias("_in_slice"))
    totals = slices.groupBy(*keys).agg(F.sum("_in_slice").alias("_in_bucket"))
    per_group = Window.partitionBy(*groups)
    totals = totals.select(*keys, _sum_before("_in_bucket", per_group.orderBy("_bucket")).alias("_before"),
                           F.sum("_in_bucket").over(per_group).alias("_n"))
    slices = slices.withColumn("_inside", _sum_before("_in_slice", Window.partitionBy(*keys).orderBy("_fine")))
    slices = slices.join(totals, keys).select(*keys, "_fine", (F.col("_before") + F.col("_inside")).alias("_before"), "_n")
    inside = Window.partitionBy(*keys, "_fine").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (spread.join(slices, [*keys, "_fine"])
            .withColumn("_upto", F.col("_before") + F.sum(count).over(inside))
            .drop("_bucket", "_fine", "_before"))


def _sum_before(count: str, window) -> Column:
    """Sum over the rows before this one."""
    return F.sum(count).over(window.rowsBetween(Window.unboundedPreceding, 0)) - F.col(count)


def pick_ranks(ranked: DataFrame, groups: Sequence[str], stats: Sequence[Quantile], value: str = "value",
               count: str = "count") -> DataFrame:
    """Order statistics of a histogram carrying ``_upto`` and ``_n``: one row per group, plus its size ``n``."""
    n, upto = F.col("_n"), F.col("_upto")
    wanted = _rank_columns(stats, n)
    hits = [F.max(F.when((upto >= r) & (upto - F.col(count) < r), F.col(value))).alias(c) for c, r in wanted]
    near = reduce(lambda a, b: a | b, [(upto >= r) & (upto - F.col(count) < r) for _, r in wanted])
    picked = ranked.where(near).groupBy(*groups).agg(F.max(n).alias("n"), *hits)
    return _finish(picked, groups, stats)


def _finish(picked: DataFrame, groups: Sequence[str], stats: Sequence[Quantile]) -> DataFrame:
    return picked.select(*groups, "n", *[
        q.value(F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col("n")).alias(q.name) for i, q in enumerate(stats)])


def histogram(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """(groups, value, count) of the non-NULL values, combined on the map side."""
    rows = df.select(*groups, F.col(value).cast("double").alias("value"))
    rows = rows.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return rows.groupBy(*groups, "value").agg(F.count(F.lit(1)).alias("count"))


def quantiles(df: DataFrame, groups: Sequence[str], value: str, stats: Sequence[Quantile],
              bits: int = SLICE_BITS) -> DataFrame:
    """Exact statistics of ``value`` per group: (groups..., n, one column per statistic). NULL and NaN take no part."""
    keys = list(groups)
    rows = _null_safe(df, keys).select("_group", F.col(value).cast("double").alias("value"))
    rows = rows.where(F.col("value").isNotNull() & ~F.isnan("value"))
    rows = rows.withColumn("_bucket", value_bucket(F.col("value"), bits))
    totals = rows.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("_in_part"))
    per_group = Window.partitionBy("_group")
    totals = totals.withColumns({"_before": _sum_before("_in_part", per_group.orderBy("_bucket")),
                                 "_n": F.sum("_in_part").over(per_group)})
    near = rows.join(_holding(totals, stats).select("_group", "_bucket", "_before", "_n"), ["_group", "_bucket"])
    hist = near.groupBy("_group", "_bucket", "_before", "_n", "value").agg(F.count(F.lit(1)).alias("count"))

    # Once more inside the bucket.
    hist = hist.withColumn("_fine", fine_slice(F.col("value"), bits))
    slices = hist.groupBy("_group", "_bucket", "_fine", "_n", F.col("_before").alias("_base")).agg(F.sum("count").alias("_in_part"))
    slices = slices.withColumn("_before", F.col("_base") + _sum_before(
        "_in_part", Window.partitionBy("_group", "_bucket").orderBy("_fine")))
    holding = _holding(slices, stats).select("_group", "_bucket", "_fine", F.col("_before").alias("_base"))
    inside = Window.partitionBy("_group", "_bucket", "_fine").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = hist.join(holding, ["_group", "_bucket", "_fine"]).withColumn("_upto", F.col("_base") + F.sum("count").over(inside))
    return _restore(pick_ranks(ranked, _KEY, stats), keys)


def _holding(parts: DataFrame, stats: Sequence[Quantile]) -> DataFrame:
    """The parts that hold a wanted rank."""
    begin, end = F.col("_before"), F.col("_before") + F.col("_in_part")
    holds = [(end >= r) & (begin < r) for _, r in _rank_columns(stats, F.col("_n"))]
    return parts.where(reduce(lambda a, b: a | b, holds))


# Grouping keys may be NULL and joins drop NULL keys: groups travel as one struct whose fields may be NULL.
def _null_safe(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    packed = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))
    return df.withColumn("_group", packed)


def _restore(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col("_group")[k].alias(k) for k in keys], *[c for c in df.columns if c != "_group"])


def median(df: DataFrame, groups: Sequence[str], value: str, name: str = "median") -> DataFrame:
    return quantiles(df, groups, value, [Quantile(name)])


QUARTILES_NEAREST = (Quantile("q1", "nearest", 0.25), Quantile("median"), Quantile("q3", "nearest", 0.75))
BOX = (Quantile("q1", "linear", 0.25), Quantile("median", "linear", 0.5), Quantile("q3", "linear", 0.75))
