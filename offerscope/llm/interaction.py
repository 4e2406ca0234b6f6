"""Filter interaction audit: what every filter removes, at every place of every order in which filters could be applied.

One narrow pass gives each document a mask with one bit per failed filter. Documents with the same part, mask and labels are counted
together, so a part has 2^filters cells at most, however many documents it holds. Each cell folds across the literal array of
orders: `aggregate` walks one order and keeps whether an earlier filter already failed, `transform` does so for every order. A cell
gives one weighted struct per order and step (600 for five filters); the structs of a part are added up place by place.

A text is a copy if the same text has a smaller id. Texts are told apart by their SHA-256; only the digest moves. The smallest id of
every digest comes from an aggregate that combines on the map side, and documents look themselves up by (id, digest), so a text that a
third of the table shares does not meet in one task.

Defined cases: a null text is empty; a null part is the empty string; a null id is larger than every id, so it is a copy if an id has
the text, and has no label; repeated labels of an id count once, and either row may set a flag; rows that repeat an id and its text are
no copies of each other; very long texts stay in their row; no documents give no rows; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
STEPS = "array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions of a text that is never null, by letter, in the order of the mask's bits."""
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
        "C": 100 * (F.length(text) - F.length(F.translate(text, UPPER, ""))).cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def _mask(failures: dict[str, Column]) -> Column:
    """One bit per failure."""
    return reduce(lambda a, b: a + b, [F.when(fails, 1 << bit).otherwise(0) for bit, fails in enumerate(failures.values())])


def cells(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail. Bits follow the letters A to E."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                     F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.withColumn("words", F.array_remove(F.split("t", SPACES), ""))
    rows = rows.select("id", "part", F.unhex(F.sha2("t", 256)).alias("digest"),
                       _mask(text_failures(F.col("t"), F.col("words"))).alias("mask"))
    first = rows.groupBy("digest").agg(F.min("id").alias("first")).withColumnRenamed("digest", "of").withColumn("is_first", F.lit(True))
    flags = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    marked = rows.join(flags, "id", "left").join(
        first, F.col("id").eqNullSafe(F.col("first")) & (F.col("digest") == F.col("of")), "left")
    copy = F.when(F.col("is_first").isNull(), 1 << 4).otherwise(0)
    return marked.groupBy("part", (F.col("mask") + copy).alias("mask")).agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))


def _weighted(mask: Column, bit: Column, gone: Column, n: Column, good: Column, toxic: Column) -> Column:
    """What one cell adds at one step."""
    fails = mask.bitwiseAND(bit) != 0
    removed, zero = fails & ~gone, F.lit(0).cast("long")
    values = (F.when(~fails & ~gone, n), F.when(removed, n), F.when(fails & gone, n), F.when(mask == bit, n),
              F.when(removed, good), F.when(removed, toxic))
    return F.struct(*[v.otherwise(zero).alias(c) for c, v in zip(COUNTS, values)])


def audit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step, zeros included, with the counts of the step and the filter's Shapley sum."""
    letters = "ABCDE"
    names = ["".join(p) for p in permutations(letters)]
    orders = F.array(*[F.array(*[F.lit(1 << letters.index(x)) for x in name]) for name in names])
    mask, n, good, toxic = (F.col(c) for c in ("mask", "n", "good", "toxic"))

    def walk(order: Column) -> Column:
        return F.aggregate(
            order, F.struct(F.lit(False).alias("gone"), F.array().cast(STEPS).alias("steps")),
            lambda so_far, bit: F.struct(
                (so_far["gone"] | (mask.bitwiseAND(bit) != 0)).alias("gone"),
                F.concat(so_far["steps"], F.array(_weighted(mask, bit, so_far["gone"], n, good, toxic))).alias("steps")),
            lambda done: done["steps"])

    folded = cells(df, labels, id_col, text, part).select("part", F.posexplode(F.flatten(F.transform(orders, walk))).alias("at", "step"))
    sums = folded.groupBy("part", "at").agg(*[F.sum(f"step.{c}").alias(c) for c in COUNTS])
    order = F.element_at(F.array(*map(F.lit, names)), (F.floor(F.col("at") / len(letters)) + 1).cast("int"))
    step = F.col("at") % len(letters) + 1
    placed = sums.select("part", order.alias("filter_order"), step.cast("int").alias("step"), *COUNTS)
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    everywhere = Window.partitionBy("part", letter)
    return placed.select("part", "filter_order", "step", *COUNTS, F.sum("removed").over(everywhere).alias("shapley"))
