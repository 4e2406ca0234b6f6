"""Landing zone: append-only JSON lines, one folder per source."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from offerscope import schemas

# Columns that put the records in their order of arrival: file, block, line.
ARRIVAL = ("_file", "_block", "_line")


def read_landing(spark: SparkSession, raw_dir: str, on_bad_line: str = "FAILFAST") -> DataFrame:
    """All records below ``raw_dir`` (``*.jsonl`` and ``*.json``); blank lines are skipped, missing keys are NULL."""
    reader = (spark.read.schema(schemas.RAW).option("mode", on_bad_line)
              .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*"))
    return with_arrival(reader.json(raw_dir))


def read_marked(spark: SparkSession, raw_dir: str) -> DataFrame:
    """As ``read_landing``, but a line that is no record, or has a field of another type, is kept as text in ``_bad_line``."""
    schema = T.StructType([*schemas.RAW.fields, T.StructField("_bad_line", T.StringType())])
    reader = (spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad_line")
              .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*"))
    return with_arrival(reader.json(raw_dir))


def bad_lines(marked: DataFrame) -> DataFrame:
    """(file_name, record, line): the lines that are no records, and what could be read of them.

    All fields are read here: a reader that needs few of them does not notice a wrong type in the others.
    """
    record = F.to_json(F.struct(*schemas.RAW.fieldNames()))
    return marked.where(F.col("_bad_line").isNotNull()).select(
        F.col("_raw_file").alias("file_name"), record.alias("record"), F.col("_bad_line").alias("line"))


def with_arrival(df: DataFrame) -> DataFrame:
    """Adds the file name and the arrival columns to a file-backed DataFrame."""
    return df.select("*", F.col("_metadata.file_name").alias("_raw_file"),
                     F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_line"))


def write_landing(offers: DataFrame, raw_dir: str, stamp: datetime | None = None) -> None:
    """Appends the records of each source below its own time-stamped folder, as JSON lines."""
    stamp = stamp or datetime.now(timezone.utc)
    known = [c for c in schemas.RAW.fieldNames() if c in offers.columns]
    rows = offers.select(*known).withColumn("landing", F.col("source"))
    if "collected_at" not in known:
        rows = rows.withColumn("collected_at", F.lit(stamp.isoformat(timespec="seconds")))
    rows = rows.withColumn("stamp", F.lit(stamp.strftime("%Y%m%d_%H%M%S")))
    rows.write.mode("append").partitionBy("landing", "stamp").json(raw_dir)


def as_raw(df: DataFrame, *more: str) -> DataFrame:
    """The 21 raw columns in order and with their types, absent ones NULL, then the columns named in ``more``."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.RAW.fields], *more)
