"""From raw documents to packed training sequences: quality rules, near duplicates, repeated passages, packing.

Every stage reads what its predecessor wrote; all but the last return the columns of documents, whatever those are.

Defined cases: null and empty texts fail the quality rules; a null id is kept where its text is; of rows that repeat id and text one
stays; texts of any length are judged and cut whole; ties between copies go to the smallest id; an empty table gives no rows; further
columns, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerscope.llm import hyperminhash, packing, quality, substring
from offerscope.llm.common import stored, table

#: SQL has no hashed n-gram model, HyperMinHash or tokenizer: the stages are tested against brute force.
ORACLE_SQL = None


#: Rows of one Arrow batch: long texts lie in the JVM, in Arrow and as Python bytes at once, so batches of the default 10,000 rows are large.
BATCH_ROWS = "2000"


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or fall below the threshold go; the filter is narrow."""
    _small_batches(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.passes(model)(F.col("text").cast("binary")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that share 80 % of their five-word shingles, directly or over others, the smallest id stays, once.

    The SimHash balls of operator 5 propose pairs first; they cannot tell this similarity alone (see README), so the sketches of
    operator 13 find the rest, and full sets decide. Texts without words are copies of each other. Rows without an id, which cannot
    be named as copies, stay.
    """
    _small_batches(spark)
    found = hyperminhash.near_duplicates(docs, width=5, simhash_radius=3)
    blank = F.broadcast(found.where("n_shingles = 0").agg(F.min("doc_id").alias("least")))  # one row
    first = found.crossJoin(blank).select(F.when(F.col("n_shingles") == 0, F.col("least")).otherwise(F.col("component_id")).alias("doc_id"))
    first = first.where("doc_id is not null").distinct()
    named = docs.where("doc_id is not null").join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id is null")).select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in repeated windows go. A text that loses words keeps the others, joined by single spaces; other texts are untouched."""
    _small_batches(spark)
    found = substring.remove_repeats(docs, names=("__n_words", "__n_removed", "__kept"))
    cut = F.col("__n_removed") > 0
    new = {"text": F.when(cut, F.col("__kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut, F.length("__kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.withColumns(new).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence of 2048 ids."""
    import public_tokenizers

    _small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("repeated passages", repeated_passages),
          ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
