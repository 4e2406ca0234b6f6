"""Co-occurrence of items in baskets: pair counts, confidence, lift."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from offerscope.functions.text import round_half_up


def item_sets(links: DataFrame, basket: str, item: str) -> DataFrame:
    """Distinct item sets with the number of baskets holding exactly that set.

    A basket set has at most one entry per catalogue item. Baskets are merged by content before any pair is
    built, so the work downstream depends on how many different sets exist, not on how many baskets.
    """
    sets = links.groupBy(basket).agg(F.array_sort(F.collect_set(item)).alias("items"))
    return sets.groupBy("items").agg(F.count(F.lit(1)).alias("baskets"))


def pair_counts(links: DataFrame, basket: str, item: str, minimum: int = 1) -> DataFrame:
    """(item_a, item_b, n) with item_a < item_b, baskets holding both."""
    sets = item_sets(links, basket, item).where(F.size("items") > 1)
    heads = sets.select("baskets", "items", F.posexplode("items").alias("at", "item_a"))
    tails = heads.select("baskets", "item_a",
                         F.explode(F.slice("items", F.col("at") + 2, F.size("items"))).alias("item_b"))
    return (tails.groupBy("item_a", "item_b").agg(F.sum("baskets").alias("n"))
            .where(F.col("n") >= minimum))


def pair_lift(links: DataFrame, basket: str, item: str, total, minimum: int = 5) -> DataFrame:
    """Adds ``pct_a_with_b`` (confidence) and ``lift`` to the pairs met at least ``minimum`` times.

    ``total`` is the number of baskets including empty ones, as a scalar column. Links must be unique.
    """
    frequency = links.groupBy(item).agg(F.count(F.lit(1)).alias("freq"))
    pairs = pair_counts(links, basket, item, minimum)
    pairs = pairs.join(frequency.select(F.col(item).alias("item_a"), F.col("freq").alias("n_a")), "item_a")
    pairs = pairs.join(frequency.select(F.col(item).alias("item_b"), F.col("freq").alias("n_b")), "item_b")
    together = F.col("n").cast("double")
    return pairs.select(
        "item_a", "item_b", "n",
        round_half_up(100.0 * together / F.col("n_a"), 1).alias("pct_a_with_b"),
        round_half_up(together * total / (F.col("n_a") * F.col("n_b")), 2).alias("lift"))
