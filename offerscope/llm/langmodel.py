"""Language-model scores: cross-entropy difference between a target and a background model.

Both are bigram models over all words of the corpus, so they differ in their counts only. Target counts come from all trusted
documents, background counts from every document. P(w | v) = (c(v, w) + m P(w)) / (c(v) + m),
with c(v) the words that follow v, and P(w) = (c(w) + 1) / (n + vocabulary); the start of a text is a context of its own. A
document's score is the mean over its words of target loss minus background loss: the lower, the more it resembles the target.

No word and no bigram is left out. Documents move in buckets: a bucket tells each of its words and bigrams once, with counts, gets
back the totals that differ from its own counts, and scores its documents. So a bigram that every document holds costs one row per
bucket, and nothing but the sums over all words goes to the driver. Words and bigrams are told apart by 64-bit
hashes, one bit of which marks words; n of them are expected to give n^2 / 2^64 false matches.

Defined cases: a null or empty text has no words and score 0; without trusted documents the models are equal and every score is 0;
repeated rows each get a row; a null id is carried and never labelled; ties of scores stay ties; very long texts are scored whole; an empty
table gives no rows; other columns are ignored. Rows are dealt to buckets by id and text alone, so a table that is computed again after
a loss, in whatever order, gives the same buckets; only rows that repeat both share one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerscope.llm.common import arrow_schema, batch_of, partitions_for, stored, text_bytes
from offerscope.llm.quality import labelled_sample

PSEUDO = 20.0
SCORES = "doc_id long, n_words long, target_loss double, background_loss double, score double"
#: n and t count in all and in trusted texts; n_last and t_last are a word's counts as last word of a text.
COUNTS = ("n", "t", "n_last", "t_last")
#: `size` hashes of one part of the hash range and one bucket in rising order, with their counts. Loose rows take twice the disk.
PACKED = "part int, bucket int, size int, packed binary"
BUCKET_BYTES, ROWS_EACH = 16 << 20, 2_000_000
#: Bucket numbers of the rows that hold the totals of all words, and the size of the vocabulary.
TOTALS, SIZE = -1, -2
#: Part number of the rows that hold a bucket's trusted ids.
TRUSTED = -1
START = np.uint64(0x94D049BB133111EB)
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * K1 + b
    x ^= x >> np.uint64(29)
    x *= K2
    return x ^ (x >> np.uint64(32))


class Bucket:
    """Words and bigrams of some documents: every distinct one with its counts, and its place for every position."""

    def __init__(self, texts: pa.ChunkedArray, trusted: np.ndarray):
        hashed = []
        for text in texts:
            words = (text.as_py() or b"").split()
            hashed.append(np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words)))
        self.lengths = np.array([len(x) for x in hashed], dtype=np.int64)
        word = np.concatenate([*hashed, np.zeros(0, dtype=np.uint64)])
        del hashed
        some, ends = self.lengths > 0, np.cumsum(self.lengths)
        self.first, last = (ends - self.lengths)[some], (ends - 1)[some]
        before = np.r_[START, word[:-1]] if len(word) else word.copy()
        before[self.first] = START
        pair = _mix(before, word) & ~np.uint64(1)
        del before
        self.words, self.word = self._places(word | np.uint64(1))
        del word
        self.pairs, self.pair = self._places(pair)
        good, ended = np.repeat(trusted, self.lengths), self.word[last]
        self.single = [np.bincount(x, minlength=len(self.words)) for x in (self.word, self.word[good], ended, ended[trusted[some]])]
        self.joint = [np.bincount(x, minlength=len(self.pairs)) for x in (self.pair, self.pair[good])]

    @staticmethod
    def _places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found, place = np.unique(keys, return_inverse=True)
        return found, place.astype(np.int32)

    def take(self, h: np.ndarray, totals: np.ndarray) -> None:
        """Totals in place of the bucket's own counts."""
        words = (h & np.uint64(1)).astype(bool)
        for known, counts, chosen in ((self.words, self.single, words), (self.pairs, self.joint, ~words)):
            at = np.searchsorted(known, h[chosen])
            for c, total in zip(counts, totals):
                c[at] = total[chosen]

    def losses(self, kind: int, n: int, starts: int, vocabulary: int) -> np.ndarray:
        """Mean loss per document under the model of all (0) or of trusted texts (1)."""
        single, ended = self.single[kind], self.single[kind + 2]
        out = np.zeros(len(self.lengths))
        if len(self.word):
            context = np.r_[0, (single - ended)[self.word[:-1]]]
            context[self.first] = starts
            loss = np.log(context + PSEUDO)
            del context
            p = (single[self.word] + 1.0) / (n + vocabulary)
            loss -= np.log(self.joint[kind][self.pair] + PSEUDO * p)
            out[self.lengths > 0] = np.add.reduceat(loss, self.first)
        return out / np.maximum(1, self.lengths)


def _pack(part: int, bucket: int, h: np.ndarray, counts: list[np.ndarray]) -> tuple[int, int, int, bytes]:
    """Steps between the hashes, and the counts, ordered by byte: leading bytes are nearly all zero."""
    data = np.stack([np.diff(h, prepend=np.uint64(0)).view(np.int64), *counts])
    data = data.view(np.uint8).reshape(len(data), len(h), 8).transpose(0, 2, 1).tobytes()
    return part, bucket, len(h), pa.compress(data, codec="zstd", asbytes=True)


def _unpack(size: int, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = 1 + len(COUNTS)
    data = np.frombuffer(pa.decompress(packed, 8 * width * size, codec="zstd"), dtype=np.uint8).reshape(width, 8, size)
    data = np.ascontiguousarray(data.transpose(0, 2, 1)).view(np.int64).reshape(width, size)
    return np.cumsum(data[0].view(np.uint64), dtype=np.uint64), data[1:]


def _table(rows: list[tuple]) -> pa.Table:
    schema = arrow_schema(PACKED)
    return pa.Table.from_batches([batch_of(schema, *(zip(*rows) if rows else [()] * len(schema)))], schema)


def _changed(told: pa.Table) -> pa.Table:
    """Totals of every hash for each bucket that counts less than all, and the totals over all words of the part."""
    part, numbers, sizes = told.column(0)[0].as_py(), told.column(1).to_numpy(), told.column(2).to_numpy()
    h = np.zeros(sizes.sum(), dtype=np.uint64)
    own = np.zeros((len(COUNTS), len(h)), dtype=np.int64)
    at = 0
    for size, packed in zip(sizes.tolist(), told.column(3)):
        h[at:at + size], own[:, at:at + size] = _unpack(size, packed.as_py())
        at += size
    order = np.argsort(h, kind="stable")
    h, own, bucket = h[order], own[:, order], np.repeat(numbers, sizes)[order]
    starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    sums = np.add.reduceat(own, starts, axis=1)
    words = (h[starts] & np.uint64(1)).astype(bool)
    one = np.zeros(1, dtype=np.uint64)
    rows = [_pack(part, TOTALS, one, [s[words].sum(keepdims=True) for s in sums]),
            _pack(part, SIZE, one, [np.array([words.sum()])] * len(COUNTS))]
    full = np.repeat(sums, np.diff(np.r_[starts, len(h)]), axis=1)
    more = np.flatnonzero((full != own).any(axis=0))
    more = more[np.argsort(bucket[more], kind="stable")]
    for some in np.split(more, np.flatnonzero(np.diff(bucket[more])) + 1):
        if len(some):
            rows.append(_pack(part, int(bucket[some[0]]), h[some], list(full[:, some])))
    return _table(rows)


def _trusted(ids: pa.Table) -> pa.Table:
    """The trusted ids of a bucket, packed."""
    known = np.unique(ids.column(1).to_numpy())
    return _table([(TRUSTED, ids.column(0)[0].as_py(), len(known), known.tobytes())])


def score(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Losses per word under both models, and their difference, for every row.

    Trusted ids come to the buckets of their documents by a join of ids alone; texts move to their buckets only.
    """
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = partitions_for(df, size, BUCKET_BYTES)
    rows = df.select(F.pmod(F.xxhash64(id_col, text), F.lit(buckets)).cast("int").alias("bucket"), F.col(id_col).cast("long").alias("id"),
                     text_bytes(text).alias("text"))
    ids = labelled_sample(labels).where("trusted").select(F.col("__id").alias("id"))
    trusted = stored(rows.select("bucket", "id").join(ids, "id").select("bucket", "id").groupBy("bucket").applyInArrow(_trusted, PACKED), "trusted")
    grouped = rows.groupBy("bucket")
    schema, parts = arrow_schema(SCORES), partitions_for(df, size // 6, ROWS_EACH)
    edges = np.array([(i << 64) // parts for i in range(1, parts)], dtype=np.uint64)

    def bucket_of(table: pa.Table, sent: pa.Table) -> Bucket:
        known = [p.as_py() for part, p in zip(sent.column(0).to_pylist(), sent.column(3)) if part == TRUSTED]
        known = np.frombuffer(b"".join(known), dtype=np.int64)
        ids = table.column(1)
        return Bucket(table.column(2), ids.is_valid().to_numpy() & np.isin(ids.fill_null(0).to_numpy(), known))

    def tell(table: pa.Table, sent: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _table([])
        b, number, rows = bucket_of(table, sent), table.column(0)[0].as_py(), []
        none = np.zeros(len(b.pairs), dtype=np.int64)
        for keys, counts in ((b.words, b.single), (b.pairs, [*b.joint, none, none])):
            ends = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
            rows += [_pack(part, number, keys[x:y], [c[x:y] for c in counts]) for part, (x, y) in enumerate(zip(ends, ends[1:])) if x < y]
        return _table(rows)

    told = grouped.cogroup(trusted.groupBy("bucket")).applyInArrow(tell, PACKED).groupBy("part")
    totals = stored(told.applyInArrow(_changed, PACKED), "totals")
    sums = {TOTALS: np.zeros(len(COUNTS), dtype=np.int64), SIZE: np.zeros(len(COUNTS), dtype=np.int64)}
    for r in totals.where("bucket < 0").collect():  # two rows per part
        sums[r["bucket"]] += _unpack(r["size"], r["packed"])[1][:, 0]
    n, n_near, starts, starts_near = map(int, sums[TOTALS])
    vocabulary = int(sums[SIZE][0])

    def judge(table: pa.Table, sent: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        b = bucket_of(table, sent)
        for part, count, packed in zip(sent.column(0).to_pylist(), sent.column(2).to_pylist(), sent.column(3)):
            if part != TRUSTED:
                b.take(*_unpack(count, packed.as_py()))
        far = b.losses(0, n, starts, vocabulary)
        near = b.losses(1, n_near, starts_near, vocabulary) if n_near else far
        return pa.Table.from_batches([batch_of(schema, table.column(1).combine_chunks(), b.lengths, near, far, near - far)], schema)

    return grouped.cogroup(totals.where("bucket >= 0").union(trusted).groupBy("bucket")).applyInArrow(judge, SCORES)
