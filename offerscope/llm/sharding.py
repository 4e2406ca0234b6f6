"""Jump consistent hashing: shards from stable keys, and gapless slots inside every shard.

`assign` is narrow: key and shard count alone decide. Going from n to n + 1 shards moves only the rows that go into shard n.
`with_slots` numbers the rows of each shard 0, 1, ... without sorting or gathering a shard: every task counts its own rows per
shard, prefix sums of those counts give the task's first slot.

Defined cases: a null key counts as -1; repeated rows and equal keys share a shard and get slots of their own; an empty table
gives no rows; other columns, very long texts among them, pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from offerscope.llm.common import stored

# Fixed value: multiplier of the published generator.
MULTIPLIER = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every 64-bit key, by the published recurrence, all keys at once."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    shard = np.full(len(state), -1, dtype=np.int64)
    following = np.zeros(len(state), dtype=np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = following[moving]
        state[moving] = state[moving] * MULTIPLIER + np.uint64(1)
        step = float(1 << 31) / ((state[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        following[moving] = ((shard[moving] + 1) * step).astype(np.int64)
        moving = moving[following[moving] < shards]
    return shard


def assign(key: str | Column, shards: int) -> Column:
    """The shard of a long key as an int column."""
    if shards < 1:
        raise ValueError("shards must be positive")

    @F.pandas_udf("int")
    def pick(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(dtype=np.int64), shards).astype(np.int32))

    return pick(F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit(-1)).cast("long"))


def with_slots(df: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Add a slot that runs gapless from 0 in every shard. Rows are stored once with the number they have in their task."""
    fields = [f for f in df.schema.fields if f.name != slot]
    part_col, nth_col, first_col, count_col = _unused(df.columns, "part", "nth", "first", "count")
    wide = StructType([*fields, StructField(part_col, LongType()), StructField(nth_col, LongType())])

    def number(batches):
        part, counts = TaskContext.get().partitionId(), {}
        for batch in batches:
            shards = batch.column(batch.schema.get_field_index(shard)).to_numpy(zero_copy_only=False)
            nth = np.empty(len(shards), dtype=np.int64)
            for s in np.unique(shards):
                at = np.flatnonzero(shards == s)
                nth[at] = counts.get(s, 0) + np.arange(len(at))
                counts[s] = counts.get(s, 0) + len(at)
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.full(len(shards), part, dtype=np.int64)), pa.array(nth)],
                names=[*batch.schema.names, part_col, nth_col])

    rows = stored(df.select(*[F.col(f"`{f.name}`") for f in fields]).mapInArrow(number, wide), "shards")
    before = Window.partitionBy(shard).orderBy(part_col).rowsBetween(Window.unboundedPreceding, -1)
    firsts = rows.groupBy(part_col, shard).agg(F.count("*").alias(count_col)).select(
        part_col, shard, F.coalesce(F.sum(count_col).over(before), F.lit(0)).alias(first_col))
    out = rows.join(firsts, [part_col, shard])
    return out.select(*[F.col(f"`{f.name}`") for f in fields], (F.col(first_col) + F.col(nth_col)).alias(slot))


def _unused(taken: list[str], *names: str) -> list[str]:
    """The names, with as many underscores before them as keep them apart from those taken."""
    taken, out = {t.lower() for t in taken}, []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def write_shards(df: DataFrame, path: str, key: str, shards: int) -> None:
    """Write the rows as one folder per shard."""
    df.withColumn("shard", assign(key, shards)).write.partitionBy("shard").parquet(path)
