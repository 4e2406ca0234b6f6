"""Median of a measure among baskets with an item against those without it.

The baskets *without* an item are never listed. With ``T(v)`` the number of measured baskets up to value ``v``
and ``w(v)`` those holding the item, the k-th basket without it sits at global rank ``k + w*``, where ``w*`` is the
largest ``w(v)`` among values with ``T(v) - w(v) < k``. So two look-ups per item in the global order replace the
items x baskets grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from offerscope.functions.text import round_half_up
from offerscope.operators.quantiles import Quantile, pick_ranks, prefix_counts

RANK_BLOCKS = 4096


def with_and_without(baskets: DataFrame, links: DataFrame, basket: str, item: str, value: str) -> DataFrame:
    """(item, n_with, n_without, median_with, median_without); items with an empty side are left out.

    ``baskets`` is unique on ``basket`` and ``links`` on (basket, item).
    """
    measured = baskets.where(F.col(value).isNotNull()).select(basket, F.col(value).cast("double").alias("value"))
    overall = measured.groupBy("value").agg(F.count(F.lit(1)).alias("count"))
    overall = prefix_counts(overall.withColumn("_all", F.lit(0)), ["_all"])
    overall = overall.select("value", "count", F.col("_upto").alias("upto_all"), F.col("_n").alias("n_all"))

    cited = links.select(basket, item).join(measured, basket)
    cited = cited.groupBy(item, "value").agg(F.count(F.lit(1)).alias("count"))
    cited = prefix_counts(cited, [item])
    with_item = pick_ranks(cited, [item], [Quantile("median_with")]).withColumnRenamed("n", "n_with")

    # Global ranks of the middle baskets without the item.
    both = cited.join(overall.select("value", "upto_all", "n_all"), "value")
    missing = F.col("n_all") - F.col("_n")
    low, high = Quantile("_").ranks(missing)
    without_upto = F.col("upto_all") - F.col("_upto")

    def global_rank(k: Column) -> Column:
        return F.max(k) + F.coalesce(F.max(F.when(without_upto < k, F.col("_upto"))), F.lit(0))

    wanted = both.where(missing > 0).groupBy(item).agg(
        F.max(missing).alias("n_without"), F.max("n_all").alias("n_all"),
        global_rank(low).alias("low"), global_rank(high).alias("high"))
    without = values_at_ranks(overall, wanted, item)
    return with_item.join(without, item).select(
        item, "n_with", "n_without", "median_with", ((F.col("_low") + F.col("_high")) / 2).alias("median_without"))


def values_at_ranks(overall: DataFrame, wanted: DataFrame, item: str) -> DataFrame:
    """Values found at the global ranks ``low`` and ``high`` of each item.

    Ranks are cut into blocks and both sides meet on the block number: a value row covers the blocks its copies
    span, which adds at most ``RANK_BLOCKS`` rows in all.
    """
    width = F.greatest(F.lit(1), F.floor(F.col("n_all") / RANK_BLOCKS)).cast("long")
    first = F.floor((F.col("upto_all") - F.col("count")) / width)
    last = F.floor((F.col("upto_all") - 1) / width)
    steps = overall.select("value", F.col("upto_all").alias("upto"), "count",
                           F.explode(F.sequence(first, last)).alias("block"))
    asked = wanted.select(item, "n_without", "n_all", F.explode(F.array("low", "high")).alias("rank"), "low", "high")
    asked = asked.distinct().withColumn("block", F.floor((F.col("rank") - 1) / width))
    found = asked.join(steps, "block").where((F.col("rank") <= F.col("upto"))
                                             & (F.col("rank") > F.col("upto") - F.col("count")))
    return found.groupBy(item, "n_without").agg(
        F.max(F.when(F.col("rank") == F.col("low"), F.col("value"))).alias("_low"),
        F.max(F.when(F.col("rank") == F.col("high"), F.col("value"))).alias("_high"))


def premium(baskets: DataFrame, links: DataFrame, basket: str, item: str, value: str,
            minimum: int = 10) -> DataFrame:
    """Difference of the two medians, absolute and in percent, for items met in ``minimum`` measured baskets."""
    sides = with_and_without(baskets, links, basket, item, value).where(F.col("n_with") >= minimum)
    gap = F.col("median_with") - F.col("median_without")
    return sides.select(
        item, "n_with", "n_without",
        round_half_up(F.col("median_with"), 0).alias("median_with"),
        round_half_up(F.col("median_without"), 0).alias("median_without"),
        round_half_up(gap, 0).alias("premium"),
        round_half_up(F.try_divide(100.0 * gap, F.col("median_without")), 1).alias("premium_pct"))
