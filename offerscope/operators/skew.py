"""Joins and counts that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def salted_join(facts: DataFrame, lookup: DataFrame, key: str, spread_by: Sequence[str], how: str = "inner",
                salts: int = 16) -> DataFrame:
    """Join a fact side with hot keys to a lookup side with unique keys.

    The facts of one key are spread over ``salts`` tasks by a hash of ``spread_by``; each lookup row is
    repeated once per salt. Without a hint the planner still broadcasts the lookup when its measured size allows.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(how)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def spread(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows dealt over all cores by a hash of ``by``, ahead of costly work on texts.

    Inputs of few files, and exchanges that adaptive execution shrinks by their bytes, leave such work to a few tasks. The number is
    given, so it is not shrunk again.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *by)


def spread_if_uneven(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``spread``, but rows that are read from files and lie evenly over the tasks already stay where they are: their texts are not moved.

    Only the rows of each task are counted, without a column. What has been moved before is dealt again, as its tasks may have been joined.
    """
    counted = df.select(F.spark_partition_id().alias("task"))
    if "Exchange" in counted._jdf.queryExecution().executedPlan().toString():
        return spread(df, by)
    rows, most = counted.groupBy("task").agg(F.count(F.lit(1)).alias("rows")).agg(F.sum("rows"), F.max("rows")).first()
    return spread(df, by) if (most or 0) * df.sparkSession.sparkContext.defaultParallelism > 1.5 * (rows or 0) else df


def explode_computed(df: DataFrame, keep: Sequence[str], elements: Column, name: str) -> DataFrame:
    """(keep..., element) rows of an array that is costly to compute.

    A plain ``explode`` makes the optimizer add a "not empty" filter and push it down, which computes the array
    twice. The outer form does not; the rows of empty arrays are dropped afterwards.
    """
    return df.select(*keep, F.explode_outer(elements).alias(name)).where(F.col(name).isNotNull())
