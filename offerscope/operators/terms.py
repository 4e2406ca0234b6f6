"""Characteristic terms per group: TF-IDF over uni- and bigrams, averaged per group."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from offerscope.functions.text import WORD, round_half_up, strip_accents
from offerscope.operators import termblocks as B
from offerscope.operators.groups import top_n_per_group
from offerscope.operators.skew import explode_computed, spread, spread_if_uneven
from offerscope.session import stored

# What cuts a text into segments, and a token.
BREAKS = ",.;:!?()\n•|"
SEGMENT_BREAK = r"[,.;:!?()\n•|]+"
TOKEN = rf"(?<![{WORD}])[a-z][a-z0-9+#/\-]*[a-z0-9+#]"


def tokens_by_segment(text: Column, stopwords: Iterable[str]) -> Column:
    """Tokens of each segment, stop words removed, repeats kept."""
    stop = sorted(stopwords)
    segments = F.split(strip_accents(F.lower(text)), SEGMENT_BREAK)
    found = F.transform(segments, lambda s: F.regexp_extract_all(s, F.lit(TOKEN), F.lit(0)))
    if not stop:
        return found
    return F.transform(found, lambda tokens: F.filter(tokens, lambda t: ~t.isin(stop)))


def tokens_and_breaks(text: Column) -> Column:
    """Tokens of the whole text, stop words and repeats kept, with what cuts it into segments between them. No token starts or ends
    otherwise than inside its segment, as no sign of a break is part of a token or of a word."""
    return F.regexp_extract_all(strip_accents(F.lower(text)), F.lit(f"{TOKEN}|{SEGMENT_BREAK}"), F.lit(0))


def grams(segments: Column) -> Column:
    """Uni- and bigrams; a bigram never crosses a segment break but may bridge a removed stop word."""
    def of(tokens: Column) -> Column:
        pairs = F.zip_with(F.slice(tokens, 1, F.size(tokens) - 1), F.slice(tokens, 2, F.size(tokens) - 1),
                           lambda a, b: F.concat(a, F.lit(" "), b))
        return F.when(F.size(tokens) > 1, F.concat(tokens, pairs)).otherwise(tokens)

    return F.flatten(F.transform(segments, of))


def term_frequencies(docs: DataFrame, doc: str, group: str, text: str, stopwords: Iterable[str]) -> DataFrame:
    """(doc, group, term, tf)

    Texts move once, to the task of their document, and are counted there; rows of (document, term) do not move.
    """
    segments = tokens_by_segment(F.coalesce(F.col(text), F.lit("")), stopwords)
    rows = explode_computed(spread(docs.select(doc, group, text), [doc]), [doc, group], grams(segments), "term")
    return rows.groupBy(doc, group, "term").agg(F.count(F.lit(1)).alias("tf"))


def mean_tfidf(docs: DataFrame, doc: str, group: str, text: str, stopwords: Iterable[str], min_df: int = 3,
               max_df: float = 0.6, min_group: int = 3) -> DataFrame:
    """(group, term, score): mean over all documents of the group of the L2-normalised weight.

    Weight (1 + ln tf) * (ln((1+N)/(1+df)) + 1); terms outside [min_df, max_df*N] are no part of the vocabulary.

    Texts are tokenised once, where they lie if the tasks have their share, and stored in packed blocks. Rows of (document, term) never
    move: a block tells each part of the terms its own distinct ones, gets their document frequencies back, and sums the weights of its
    documents by group and term. Rows that share a document share its length, in whatever blocks they are. Null and empty texts are
    documents without terms; no documents, or no term inside the bounds, give no rows.
    """
    spark, kind = docs.sparkSession, docs.select(F.col(doc).alias("doc"), F.col(group).alias("group")).schema
    stop = frozenset(stopwords)
    rows = spread_if_uneven(docs.select(doc, group, text), [doc]).select(
        F.col(doc).alias("doc"), F.col(group).alias("group"), tokens_and_breaks(F.coalesce(F.col(text), F.lit(""))).alias("tokens"))
    packed = _struct("block long", ("docs", T.ArrayType(kind["doc"].dataType)), ("groups", T.ArrayType(kind["group"].dataType)),
                     "places long, words binary, size int, ids binary, lengths binary")
    blocks = stored(rows.mapInArrow(B.packer(to_arrow_schema(packed), BREAKS, stop, B.PLACES), packed), "term-blocks", large_rows=True)
    n_docs, places, n_blocks = blocks.agg(F.sum(F.size("docs")), F.sum("places"), F.count(F.lit(1))).first()
    n_docs = float(n_docs or 0)

    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-(places or 0) // B.TERMS_PER_PART))
    by_part, by_block = [max(least, parts), "part"], [max(least, n_blocks), "block"]
    # The numbers are given: packed rows are small for the work they carry, so adaptive execution would join them into few tasks.
    told, sent = _struct(B.TOLD), _struct(B.SENT)
    frequencies = blocks.select("block", "groups", "words", "size", "ids", "lengths").mapInArrow(B.teller(to_arrow_schema(told), parts), told) \
        .repartition(*by_part).groupBy("part").applyInArrow(B.counter(to_arrow_schema(sent), min_df, max_df * n_docs), sent)
    frequencies = stored(frequencies, "frequencies", large_rows=True)

    def met(some: DataFrame, received: DataFrame):
        return some.select("block", "groups", "words", "size", "ids", "lengths").repartition(*by_block).groupBy("block") \
            .cogroup(received.repartition(*by_block).groupBy("block"))

    placed = blocks.select("block", F.posexplode("docs").alias("row", "doc"))
    several = placed.groupBy("doc").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1).select(F.col("doc").alias("shared"))
    shared = stored(placed.join(several, F.col("doc").eqNullSafe(F.col("shared")), "left_semi"), "shared-documents")
    received = frequencies
    if not shared.isEmpty():
        square = _struct("block long, row long, square double")
        squares = met(blocks.join(shared.select("block").distinct(), "block", "left_semi"), frequencies) \
            .applyInArrow(B.squarer(to_arrow_schema(square), parts, n_docs), square).join(shared, ["block", "row"])
        squares = stored(squares.select("block", "row", "doc", "square"), "squares")
        whole = squares.groupBy(F.col("doc").alias("shared")).agg(F.sum("square").alias("square"))
        lengths = squares.drop("square").join(whole, F.col("doc").eqNullSafe(F.col("shared"))).select("block", F.col("row").cast("long").alias("row"), "square")
        received = frequencies.unionByName(lengths.groupBy("block").applyInArrow(B.collector(to_arrow_schema(sent)), sent))

    added = _struct("part int, block long, size int, names binary, numbers binary", ("groups", T.ArrayType(kind["group"].dataType)))
    out = _struct(("group", kind["group"].dataType), "term string, w double")
    summed = met(blocks, received).applyInArrow(B.scorer(to_arrow_schema(added), parts, n_docs), added) \
        .repartition(*by_part).groupBy("part").applyInArrow(B.adder(to_arrow_schema(out)), out)

    # Stored, so that the planner knows its size and moves no sums to meet it.
    sizes = stored(blocks.select(F.explode("groups").alias("group")).groupBy("group").agg(F.count(F.lit(1)).alias("docs"))
                   .where(F.col("docs") >= min_group), "group-sizes")
    return summed.join(sizes, "group").select(F.col("group").alias(group), "term", (F.col("w") / F.col("docs")).alias("score")) \
        .where(F.col("score") > 0)


def _struct(*parts: str | tuple[str, T.DataType]) -> T.StructType:
    """A schema out of texts and of single fields whose type the input decides."""
    fields: list[T.StructField] = []
    for part in parts:
        fields += T.StructType.fromDDL(part).fields if isinstance(part, str) else [T.StructField(*part)]
    return T.StructType(fields)


def top_terms(docs: DataFrame, doc: str, group: str, text: str, stopwords: Iterable[str], n: int = 25,
              min_df: int = 3, max_df: float = 0.6, redundancy: float = 0.9) -> DataFrame:
    """(group, term, tfidf_score, rank): the ``n`` best terms of each group.

    Out of the 3n best, a single word already carried by a bigram scoring at least ``redundancy`` times as much is
    dropped. Order: score, then term, both descending; scores are compared at ten digits so that the order does
    not hang on the order of summation.
    """
    scored = mean_tfidf(docs, doc, group, text, stopwords, min_df, max_df)
    scored = scored.withColumn("_order", round_half_up(F.col("score"), 10))
    order = [F.desc("_order"), F.desc("term")]
    best = stored(top_n_per_group(scored, [group], order, 3 * n, rank="_place"), "best-terms")
    carried = (best.where(F.contains("term", F.lit(" ")))
               .select(group, F.explode(F.split("term", " ")).alias("term"), "_order")
               .groupBy(group, "term").agg(F.max("_order").alias("_carrier")))
    kept = best.join(carried, [group, "term"], "left").where(
        F.contains("term", F.lit(" ")) | F.col("_carrier").isNull()
        | (F.col("_carrier") < redundancy * F.col("_order")))
    ranked = top_n_per_group(kept, [group], order, n)
    return ranked.select(group, "term", round_half_up(F.col("score"), 5).alias("tfidf_score"), "rank")
