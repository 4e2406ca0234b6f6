"""Removal of word sequences that occur more than once, found by difference-cover anchors.

A window is `window` words in a row. Every word covered by a window that starts anywhere else too goes. Hashing all windows would
move one row per word. Instead shorter anchor windows are hashed at positions of a difference cover only: for any two positions
there is a common shift below the period that takes both to cover positions, so two equal windows always share an aligned
anchor (period - 1 + anchor length = window). Around anchors that occur twice the match is extended: the full windows there are
hashed and counted.

Rows move in buckets of documents. A bucket tells each of its hashes once, with a count, and gets back which of them repeat, so
a passage that a third of all documents share costs one row per bucket. The texts are shuffled once (the exchange is reused).

Hashes of anchors only propose; windows are compared by 64-bit hashes of their words.

Defined cases: a null or empty text has no words and stays as it is; repeated rows count as documents of their own, so their long
passages go from all of them, and rows equal in every column share a bucket; null ids are carried; very long texts are hashed whole, with
their bucket's other texts in slices; an empty table gives no rows; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import AtomicType, BinaryType, LongType, StructField, StructType

from offerscope.llm.common import arrow_schema, batch_of, partitions_for

# Perfect difference sets, period -> cover positions.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
BUCKET_BYTES, SLICE_WORDS = 8 << 20, 200_000
#: Hashes of one part when repeated ones are sought, and bytes of text that give one anchor.
ROWS_EACH, BYTES_PER_ANCHOR = 2_000_000, 25
HASHED = "h long, bucket int, n int"
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _period(window: int) -> int:
    """The longest period that leaves anchors of at least a third of the window."""
    return max((p for p in COVERS if window - p + 1 >= max(1, window // 3)), default=1)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * K1 + b
    x ^= x >> np.uint64(29)
    x *= K2
    return x ^ (x >> np.uint64(32))


def _ahead(values: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(values)
    out[:max(0, len(values) - by)] = values[by:]
    return out


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from every position on, by doubling; meaningless where fewer are left."""
    level, span, at, out = words, 1, 0, None
    while size:
        if size & 1:
            out = _ahead(level, at) if out is None else _mix(out, _ahead(level, at))
            at += span
        size >>= 1
        if size:
            level, span = _mix(level, _ahead(level, span)), span * 2
    return out


class Slice:
    """Words of some documents in one line, with their hashes and the number of words left in the document."""

    def __init__(self, docs: list[list[bytes]]):
        self.lengths = np.array([len(d) for d in docs], dtype=np.int64)
        n = int(self.lengths.sum())
        self.hashes = np.fromiter((h for d in docs for h in map(xxhash.xxh64_intdigest, d)), dtype=np.uint64, count=n)
        self.first = np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.position = np.arange(n) - self.first
        self.left = np.repeat(self.lengths, self.lengths) - self.position

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Cover positions with room for an anchor, and the anchors' hashes."""
        period = _period(window)
        size = window - period + 1
        cover = np.isin(np.arange(period), COVERS.get(period, (0,)))
        at = np.flatnonzero(cover[self.position % period] & (self.left >= size))
        return at, window_hashes(self.hashes, size)[at]

    def windows(self, window: int, repeated: np.ndarray) -> np.ndarray:
        """Hashes of the windows that hold one of the repeated anchors."""
        at, anchors = self.anchors(window)
        at = at[found(anchors, repeated)]
        begin = np.maximum(at - _period(window) + 1, self.first[at])
        steps = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        np.add.at(steps, begin, 1)
        np.add.at(steps, at + 1, -1)
        near = (np.cumsum(steps[:-1]) > 0) & (self.left >= window)
        return window_hashes(self.hashes, window)[near]

    def covered(self, window: int, repeated: np.ndarray) -> np.ndarray:
        """Which words lie in a repeated window."""
        at = np.flatnonzero(self.left >= window)
        at = at[found(window_hashes(self.hashes, window)[at], repeated)]
        steps = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        steps[at] += 1
        np.add.at(steps, at + window, -1)
        return np.cumsum(steps[:-1]) > 0


def found(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Membership in a sorted array."""
    if not len(among):
        return np.zeros(len(values), dtype=bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def _slices(texts: pa.ChunkedArray) -> Iterator[tuple[int, list[list[bytes]]]]:
    docs, n, first = [], 0, 0
    for i, text in enumerate(texts):
        docs.append((text.as_py() or b"").split())
        n += len(docs[-1])
        if n >= SLICE_WORDS:
            yield first, docs
            docs, n, first = [], 0, i + 1
    if docs:
        yield first, docs


def _told(hashes: list[np.ndarray], bucket: int) -> pa.Table:
    """Each hash of a bucket once, with its count (2 stands for more)."""
    values, counts = np.unique(np.concatenate([*hashes, np.zeros(0, dtype=np.uint64)]), return_counts=True)
    schema = arrow_schema(HASHED)
    return pa.Table.from_batches([batch_of(schema, pa.array(values.view(np.int64)), np.full(len(values), bucket, dtype=np.int32),
                                           np.minimum(counts, 2).astype(np.int32))], schema)


def _repeated(hashes: DataFrame, parts: int) -> DataFrame:
    """(h, bucket) of the hashes that occur twice or more; a hash has one row per bucket at most. A task holds one part."""
    schema = arrow_schema("h long, bucket int")

    def run(batches):
        got = list(batches)
        if not got:
            return
        h, bucket, n = (np.concatenate([b.column(i).to_numpy() for b in got]) for i in range(3))
        order = np.argsort(h, kind="stable")
        h, bucket, n = h[order], bucket[order], n[order]
        starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, dtype=np.int64)
        twice = np.repeat(np.add.reduceat(n, starts) >= 2, np.diff(np.r_[starts, len(h)])) if len(h) else np.zeros(0, dtype=bool)
        yield batch_of(schema, h[twice], bucket[twice])

    return hashes.repartition(parts, "h").mapInArrow(run, "h long, bucket int")


def remove_repeats(df: DataFrame, window: int = 35, id_col: str = "doc_id", text: str = "text",
                   names: tuple[str, str, str] = ("n_words", "n_removed", "kept")) -> DataFrame:
    """All columns of the rows, with the number of words, of removed words, and the kept words joined by single spaces.

    The three added columns get the given names and replace columns of those names.
    """
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets, parts = partitions_for(df, size, BUCKET_BYTES), partitions_for(df, size // BYTES_PER_ANCHOR, ROWS_EACH)
    carried = [c for c in df.columns if c not in names or c in (id_col, text)]
    inner = [f"c{i}" for i in range(len(carried))]
    at_text = carried.index(text) + 1
    # Rows that are equal in id and text spread by their other columns.
    plain = [f"`{f.name}`" for f in df.schema.fields if isinstance(f.dataType, AtomicType) and f.name not in (id_col, text)]
    rows = df.select(F.pmod(F.xxhash64(id_col, text, *plain), F.lit(buckets)).cast("int").alias("bucket"),
                     *[F.col(f"`{c}`").alias(i) for c, i in zip(carried, inner)])
    result = StructType([*rows.schema.fields[1:], StructField("n_words", LongType()), StructField("n_removed", LongType()),
                         StructField("kept", BinaryType())])
    result_arrow = to_arrow_schema(result)

    def texts(table: pa.Table) -> pa.ChunkedArray:
        return table.column(at_text).cast(pa.binary())

    def anchors(table: pa.Table) -> pa.Table:
        return _told([Slice(docs).anchors(window)[1] for _, docs in _slices(texts(table))], table.column(0)[0].as_py())

    def asked(table: pa.Table) -> np.ndarray:
        return np.sort(table.column(0).to_numpy()).view(np.uint64) if table.num_rows else np.zeros(0, dtype=np.uint64)

    def unsigned(table: pa.Table) -> np.ndarray:
        return np.sort(asked(table))

    def extended(table: pa.Table, repeated: pa.Table) -> pa.Table:
        if not table.num_rows or not repeated.num_rows:
            return arrow_schema(HASHED).empty_table()
        among = unsigned(repeated)
        return _told([Slice(docs).windows(window, among) for _, docs in _slices(texts(table))], table.column(0)[0].as_py())

    def cut(table: pa.Table, repeated: pa.Table) -> pa.Table:
        among, n_words, n_removed, kept = unsigned(repeated), [], [], []
        for _, docs in _slices(texts(table)):
            covered = Slice(docs).covered(window, among) if len(among) else None
            at = 0
            for words in docs:
                gone = covered[at:at + len(words)] if covered is not None else ()
                removed = int(np.sum(gone))
                at += len(words)
                n_words.append(len(words))
                n_removed.append(removed)
                kept.append(b" ".join([w for w, g in zip(words, gone) if not g] if removed else words))
        columns = [table.column(i).combine_chunks() for i in range(1, table.num_columns)]
        return pa.Table.from_arrays([*columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                     pa.array(kept, pa.binary())], schema=result_arrow)

    grouped = rows.groupBy("bucket")
    shared = _repeated(grouped.applyInArrow(anchors, HASHED), parts)
    windows = _repeated(grouped.cogroup(shared.groupBy("bucket")).applyInArrow(extended, HASHED), parts)
    done = grouped.cogroup(windows.groupBy("bucket")).applyInArrow(cut, result)
    return done.select(*[F.col(i).alias(c) for c, i in zip(carried, inner)], F.col("n_words").alias(names[0]),
                       F.col("n_removed").alias(names[1]), F.col("kept").cast("string").alias(names[2]))
