"""Alignment of two tokenizers: which tokens of one overlap which tokens of the other, and how common each pair of ids is.

Both tokenizers split the same bytes, a space and the text. The tokens of a slice of documents lie in two lines with their byte ends.
One state vector holds a pointer into either line for every lane; each step links the two tokens under all pointers at once, marks a cut
where they end together, and moves the pointer of the token that ends first (both at a cut). Finished lanes are compacted away. A
lane is a document, or a part of one between two common ends: long documents are entered at several places, found by moving
pointers in the same way, so that a very long text does not leave one lane running alone.

How many documents hold a pair is counted over the whole corpus. Documents lie in stored buckets of bounded size; a bucket tells each of its
pairs once, with its number of documents, and gets the totals of its pairs back. So a pair that every document holds costs
one row per bucket. The highest count of each id of the first tokenizer is the only table that is broadcast; it has one row per id
of the vocabulary.

Defined cases: a null or empty text has no tokens, and so has a text whose tokens' bytes of either tokenizer do not give a space and the
text back (a normalised or replaced character): zeros and an empty digest; a tie of counts makes every tied pair a best one; repeated rows are documents
of their own and count so; a null id is carried; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerscope.llm.common import arrow_schema, batch_of, in_batches, stored, text_bytes

#: Bytes of one slice of documents and of one lane, and distinct pairs of one bucket of documents.
SLICE_BYTES, LANE_BYTES, BUCKET_PAIRS = 2 << 20, 1024, 4_000_000
ALIGNED = "bucket long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"
FOUND = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevel:
    """A byte-level vocabulary file. Its merges rise with the ids, so the ids are the ranks of a faster library."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        letters, special = _byte_letters(), {t["content"] for t in whole["added_tokens"]}
        vocabulary = {t: i for t, i in whole["model"]["vocab"].items() if t not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in whole["model"]["merges"]]
        ids = [vocabulary[a + b] for a, b in merges]
        if ids != sorted(ids):
            raise ValueError("the merges do not rise with the ids")
        self.bytes = [b""] * (max(whole["model"]["vocab"].values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes([letters[c] for c in token])
        self.coder = tiktoken.Encoding("line", pat_str=pattern, mergeable_ranks={self.bytes[i]: i for i in vocabulary.values()},
                                       special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.coder.encode_ordinary(" " + t) for t in texts]


class Pieces:
    """A sentence piece model, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(self.model.get_piece_size())
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in ((i, self.model.id_to_piece(i)) for i in size)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    """Both tokenizers, the byte lengths of their tokens, and the ids as text with each mark that may follow them."""

    def __init__(self, path_a: str, pattern: str, path_b: str):
        self.a, self.b = ByteLevel(path_a, pattern), Pieces(path_b)
        self.width = len(self.b.bytes)
        if len(self.a.bytes) * self.width >= 1 << 32:
            raise ValueError("pairs of ids do not fit 32 bits")
        self.length_a, self.length_b = (np.array([len(x) for x in side.bytes], dtype=np.int64) for side in (self.a, self.b))
        self.words = [f"{i}{mark}".encode() for i in range(len(self.a.bytes)) for mark in ",|"]
        self.words += [f"{i}{mark}".encode() for i in range(self.width) for mark in (",", ";", "")]

    def __call__(self, texts: list[bytes | None]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, keys, counts) of every text; keys are its pairs in rising order."""
        raw = [(t or b"").decode("utf-8", "replace") for t in texts]
        some = [i for i, t in enumerate(raw) if t]
        coded_a, coded_b = (side.encode([raw[i] for i in some]) for side in (self.a, self.b))
        good = [(i, x, y) for i, x, y in zip(some, coded_a, coded_b)
                if b"".join(map(self.a.bytes.__getitem__, x)) == (line := b" " + texts[i])
                and b"".join(map(self.b.bytes.__getitem__, y)) == line]
        none = np.zeros(0, dtype=np.uint32)
        out = [(0, 0, 0, 0, "", none, none)] * len(texts)
        if good:
            for (i, _, _), row in zip(good, self._aligned([x for _, x, _ in good], [y for _, _, y in good])):
                out[i] = row
        return out

    def _aligned(self, docs_a: list[list[int]], docs_b: list[list[int]]) -> list[tuple]:
        n_a, n_b = (np.array([len(d) for d in docs], dtype=np.int64) for docs in (docs_a, docs_b))
        a, b = (np.fromiter((i for d in docs for i in d), dtype=np.int64, count=int(n.sum())) for docs, n in ((docs_a, n_a), (docs_b, n_b)))
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        i, j, cut = linked(ends_a, ends_b, *lanes(ends_a, ends_b, first_a, first_b))
        doc = np.repeat(np.arange(len(n_a)), n_a)[i]
        n_links, n_groups = (np.bincount(d, minlength=len(n_a)) for d in (doc, doc[cut]))
        pairs, counts = np.unique((doc.astype(np.uint64) << np.uint64(32)) | (a[i] * self.width + b[j]).astype(np.uint64), return_counts=True)
        at = np.searchsorted(pairs, np.arange(len(n_a) + 1, dtype=np.uint64) << np.uint64(32))
        keys, counts = pairs.astype(np.uint32), counts.astype(np.uint32)
        words = self._written(a, b, np.sort(i[cut]), np.sort(j[cut]), first_b + n_b - 1)
        begin = first_a + first_b
        digests = [hashlib.sha256(b"".join(map(self.words.__getitem__, words[x:x + n].tolist()))).hexdigest()
                   for x, n in zip(begin, n_a + n_b)]
        return [(int(p), int(q), int(g), int(n), h, keys[x:y], counts[x:y])
                for p, q, g, n, h, x, y in zip(n_a, n_b, n_groups, n_links, digests, at, at[1:])]

    def _written(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, last_b: np.ndarray) -> np.ndarray:
        """Ids of both lines group by group, as places in `words`: the ids of a group's first line, then those of its second."""
        ends_a, ends_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        ends_a[cut_a], ends_b[cut_b] = 1, 1
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        before_b, upto_a = np.r_[0, cut_b + 1], cut_a + 1
        mark = ends_b.copy()
        mark[last_b] = 2
        out = np.zeros(len(a) + len(b), dtype=np.int64)
        out[np.arange(len(a)) + before_b[group_a]] = 2 * a + ends_a
        out[np.arange(len(b)) + upto_a[group_b]] = 2 * len(self.length_a) + 3 * b + mark
        return out


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray,
          lane_bytes: int = LANE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Pointers at which lanes begin: those of the documents, and common ends about every `lane_bytes` bytes."""
    aim = np.arange(lane_bytes, int(ends_a[-1]), lane_bytes)
    i, j = np.searchsorted(ends_a, aim), np.searchsorted(ends_b, aim)
    seeking = np.arange(len(aim))
    while len(seeking):
        x, y = ends_a[i[seeking]], ends_b[j[seeking]]
        i[seeking] += x < y
        j[seeking] += y < x
        seeking = seeking[x != y]
    start_a, where = np.unique(np.r_[first_a, i + 1], return_index=True)
    start_b = np.r_[first_b, j + 1][where]
    inside = start_a < len(ends_a)
    return start_a[inside], start_b[inside]


def linked(ends_a: np.ndarray, ends_b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, cut) of every overlap of a token of either line, step by step over all lanes; cut: both tokens end there."""
    i, j, stop = start_a.copy(), start_b.copy(), np.r_[start_a[1:], len(ends_a)]
    out_i, out_j, out_cut = [], [], []
    while len(i):
        x, y = ends_a[i], ends_b[j]
        out_i.append(i)
        out_j.append(j)
        out_cut.append(x == y)
        i, j = i + (x <= y), j + (y <= x)
        running = i < stop
        if not running.all():
            i, j, stop = i[running], j[running], stop[running]
    return np.concatenate(out_i), np.concatenate(out_j), np.concatenate(out_cut)


@lru_cache(maxsize=1)
def _aligner(path_a: str, pattern: str, path_b: str) -> Aligner:
    """One for all tasks of a worker process."""
    return Aligner(path_a, pattern, path_b)


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Steps between keys, and counts, ordered by byte: leading bytes are nearly all zero."""
    data = np.stack([np.diff(keys, prepend=np.uint32(0)), counts])
    return data.view(np.uint8).reshape(2, len(keys), 4).transpose(0, 2, 1).tobytes()


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(packed, dtype=np.uint8).reshape(2, 4, len(packed) // 8)
    data = np.ascontiguousarray(data.transpose(0, 2, 1)).view(np.uint32).reshape(2, len(packed) // 8)
    return np.cumsum(data[0], dtype=np.uint32), data[1]


def _slices(texts: pa.Array):
    """Runs of texts of about `SLICE_BYTES`."""
    some, size = [], 0
    for text in texts:
        some.append(text.as_py())
        size += len(some[-1] or b"")
        if size >= SLICE_BYTES:
            yield some
            some, size = [], 0
    if some:
        yield some


def aligned(df: DataFrame, path_a: str, pattern: str, path_b: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with its tokens' counts, groups and packed pairs, in buckets of bounded size; stored."""
    schema = arrow_schema(ALIGNED)

    def run(batches):
        align, bucket, size = _aligner(path_a, pattern, path_b), TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            at = 0
            for texts in _slices(batch.column(1)):
                rows = align(texts)
                buckets = []
                for row in rows:
                    if size >= BUCKET_PAIRS:
                        bucket, size = bucket + 1, 0
                    size += len(row[5])
                    buckets.append(bucket)
                yield batch_of(schema, buckets, batch.column(0).slice(at, len(rows)), *(list(c) for c in zip(*(r[:5] for r in rows))),
                               [_pack(r[5], r[6]) for r in rows])
                at += len(rows)

    return stored(df.select(F.col(id_col).cast("long"), text_bytes(text)).mapInArrow(run, ALIGNED), "aligned")


def _told(documents: DataFrame) -> DataFrame:
    """(bucket, key, n): each pair of a bucket once, with its number of documents."""
    ddl = "bucket long, key long, n long"
    schema = arrow_schema(ddl)

    def tell(bucket: int, keys: list[np.ndarray]):
        values, counts = np.unique(np.concatenate(keys), return_counts=True)
        for at in range(0, len(values), 1 << 20):
            part = slice(at, at + (1 << 20))
            yield batch_of(schema, np.full(len(values[part]), bucket), values[part].astype(np.int64), counts[part].astype(np.int64))

    def run(batches):
        current, keys = None, []
        for batch in batches:
            for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != current and keys:
                    yield from tell(current, keys)
                    keys = []
                current = bucket
                keys.append(_unpack(packed.as_py())[0])
        if keys:
            yield from tell(current, keys)

    return documents.select("bucket", "pairs").mapInArrow(run, ddl)


def align(df: DataFrame, path_a: str, pattern: str, path_b: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: tokens of both sides, groups, links, links to the best partner of an id, and the sum of the links' counts."""
    width = _aligner(path_a, pattern, path_b).width
    documents = aligned(df, path_a, pattern, path_b, id_col, text)
    total = F.sum("n").over(Window.partitionBy("key"))
    counted = stored(_told(documents).select("bucket", "key", total.alias("total")), "pair-counts")
    first = F.floor(F.col("key") / width)
    highest = counted.groupBy(first.alias("a")).agg(F.max("total").alias("most"))  # one row per id at most
    sent = counted.withColumn("a", first).join(F.broadcast(highest), "a").select(
        "bucket", "key", "total", (F.col("total") == F.col("most")).alias("best"))
    found = arrow_schema(FOUND)

    def judge(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return found.empty_table()
        keys, totals, best = (pairs.column(c).to_numpy() for c in (1, 2, 3))
        order = np.argsort(keys, kind="stable")
        keys, totals, best = keys[order], totals[order], best[order]
        n_best, count_sum = [], []
        for packed in docs.column(7):
            mine, counts = _unpack(packed.as_py())
            at, counts = np.searchsorted(keys, mine.astype(np.int64)), counts.astype(np.int64)
            n_best.append(int((counts * best[at]).sum()))
            count_sum.append(int((counts * totals[at]).sum()))
        columns = [docs.column(c).combine_chunks() for c in range(1, 6)]
        return pa.Table.from_batches([batch_of(found, *columns, n_best, count_sum, docs.column(6).combine_chunks())], found)

    return documents.groupBy("bucket").cogroup(sent.groupBy("bucket")).applyInArrow(judge, FOUND)
