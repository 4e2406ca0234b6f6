"""What several operators share: Arrow batch mapping and tables stored in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerscope.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table below the shared checkpoint folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply a function to each Arrow batch of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(run, schema)


def batch_of(schema: pa.Schema, *columns: object) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
         "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a plain DDL string; works inside tasks, where no session is."""
    return pa.schema([(name, TYPES[kind]) for name, kind in (column.split() for column in ddl.split(", "))])


def text_bytes(text: str = "text") -> F.Column:
    """A text as UTF-8 bytes; null stays null. Bytes split on exactly 0x20 and 0x09-0x0D, and lower() touches A-Z only."""
    return F.col(text).cast("binary")


def partitions_for(df: DataFrame, rows: int, rows_each: int) -> int:
    """Enough shuffle partitions for so many rows each, never fewer than the session asks for."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_each))
