"""Packing by concatenating and cutting: token ids of all documents in one line, cut every `length` ids.

First pass: tokenise, store ids with the running total inside the task. The totals of the tasks, one number each, are summed up to
give every task's first global offset. Second pass: a piece is what a document has in one window; it is found from the document's
offset alone, so nothing is shuffled. `sequences` builds the windows: those inside one task locally, those over a boundary
from the partial records that the tasks on both sides emit.

Texts are tokenised by chunks between ASCII white space, which no token crosses; a worker keeps the ids of chunks it has met.

Defined cases: a null or empty text is the end id alone; repeated rows are documents of their own; a null id is carried; an empty
table gives no rows; other columns are ignored. Only the last sequence can be shorter; it is padded unless its length is a power
of two.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerscope.llm.common import arrow_schema, batch_of, in_batches, stored, text_bytes

#: Chunks whose ids a worker keeps; beyond that it starts anew. Punctuation that is cut off a chunk's end.
CACHE, TAILS = 800_000, b".,!?;:"
#: Letters that composition leaves alone and that lower() maps one to one.
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True  # their strings in a text are ordinary text
    return loaded


def byte_ranks(path: str) -> tuple[dict[bytes, int], dict[int, int]] | None:
    """The merges of a byte-level BPE with word ends as ranks of byte strings (a word end is byte 0), and each rank's id.

    None for a tokenizer of another kind. Ranks of joined bytes say the same as ranks of pairs (a test proves it for the file).
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    if model["type"] != "BPE" or model.get("end_of_word_suffix") != "</w>" or model.get("continuing_subword_prefix"):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}

    def raw(token: str) -> bytes:
        return bytes(letters[c] for c in token.removesuffix("</w>")) + b"\0" * token.endswith("</w>")

    ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 0]): 256 + b for b in range(1, 256)}
    for i, merge in enumerate(model["merges"]):
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        ranks.setdefault(raw(left) + raw(right), 512 + i)
    ids = {ranks[key]: number for token, number in model["vocab"].items() if (key := raw(token)) in ranks}
    return ranks, ids


class Encoder:
    """Ids of texts as packed unsigned integers, chunk by chunk.

    Words of plain Latin letters need no more than lower case, so they go to the merges directly, all new ones at once; anything else
    goes through the whole tokenizer.
    """

    def __init__(self, path: str, cache: int = CACHE):
        import tiktoken

        self.tokenizer, self.cache, self.kept = _tokenizer(path), cache, {}
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        ranked = byte_ranks(path)
        self.merges = None
        if ranked:
            ranks, ids = ranked
            self.merges = tiktoken.Encoding("words", pat_str="[^\\x00]+\\x00", mergeable_ranks=ranks, special_tokens={})
            self.ids, self.ends = np.zeros(max(ranks.values()) + 1, dtype=self.dtype), np.zeros(max(ranks.values()) + 1, dtype=bool)
            for key, rank in ranks.items():
                self.ids[rank], self.ends[rank] = ids.get(rank, 0), key.endswith(b"\0")

    def __call__(self, texts: list[bytes | None]) -> list[bytes]:
        if len(self.kept) > self.cache:
            self.kept.clear()
        chunks = [(t or b"").split() for t in texts]
        found = [list(map(self.kept.get, doc)) for doc in chunks]
        self._learn({c for doc, ids in zip(chunks, found) if None in ids for c, i in zip(doc, ids) if i is None})
        return [b"".join([self.kept[c] if i is None else i for c, i in zip(doc, ids)] if None in ids else ids)
                for doc, ids in zip(chunks, found)]

    def _learn(self, new: set[bytes]) -> None:
        """Punctuation after an ASCII letter or digit is a token run of its own, so word and tail are encoded apart."""
        kept, cut, plain, other = self.kept, [], set(), set()
        for chunk in new:
            word = chunk.rstrip(TAILS)
            if word != chunk:
                if word[-1:].isalnum():
                    tail = chunk[len(word):]
                    cut.append((chunk, word, tail))
                    if tail not in kept:
                        other.add(tail)
                    if word in kept:
                        continue
                else:
                    word = chunk
            (plain if self.merges and PLAIN(word.decode("utf-8", "replace")) else other).add(word)
        words = list(plain)
        for at in range(0, len(words), 50_000):
            some = words[at:at + 50_000]
            line = "\0".join([w.decode() for w in some]).lower() + "\0"
            ranks = np.array(self.merges.encode_ordinary(line), dtype=np.int64)
            packed, width = self.ids[ranks].tobytes(), self.dtype.itemsize
            ends = ((np.flatnonzero(self.ends[ranks]) + 1) * width).tolist()
            kept.update(zip(some, [packed[a:b] for a, b in zip([0, *ends], ends)]))
        words = list(other)
        for at in range(0, len(words), 50_000):
            some = words[at:at + 50_000]
            coded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in some], add_special_tokens=False)
            kept.update((w, np.array(e.ids, dtype=self.dtype).tobytes()) for w, e in zip(some, coded))
        for chunk, word, tail in cut:
            kept[chunk] = kept[word] + kept[tail]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One for all tasks of a worker process."""
    return Encoder(path)


def tokens(df: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, within, doc_id, n, ids): every document's ids with the end id, and its offset inside its task; stored."""
    ddl = "part long, within long, doc_id long, n long, ids binary"
    schema = arrow_schema(ddl)

    def run(batches):
        part, at, encode = TaskContext.get().partitionId(), 0, _encoder(path)
        end = np.array([end_id], dtype=encode.dtype).tobytes()
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                ids = [x + end for x in encode(batch.column(1).to_pylist())]
                n = np.array([len(x) // encode.dtype.itemsize for x in ids], dtype=np.int64)
                within = at + np.cumsum(n) - n
                at += int(n.sum())
                yield batch_of(schema, np.full(len(n), part), within, batch.column(0), n, ids)

    return stored(df.select(F.col(id_col).cast("long"), text_bytes(text)).mapInArrow(run, ddl), "tokens")


def offsets(stored_tokens: DataFrame) -> dict[int, int]:
    """First global offset of every task: prefix sums of one total per task."""
    totals = stored_tokens.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    starts = np.cumsum([0, *(r["n"] for r in totals)])
    return {r["part"]: int(s) for r, s in zip(totals, starts)}


def _ids(values: list[bytes], counts: np.ndarray) -> list[np.ndarray]:
    return [np.frombuffer(v, dtype=f"<u{len(v) // n}").astype("<u4") for v, n in zip(values, counts)]


def pieces(stored_tokens: DataFrame, length: int = 2048) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence."""
    schema, first = arrow_schema(PIECES), offsets(stored_tokens)

    def cut(batch: pa.RecordBatch):
        part, within, n = (batch.column(i).to_numpy() for i in (0, 1, 3))
        start = np.array([first[p] for p in part], dtype=np.int64) + within
        windows = (start + n - 1) // length - start // length + 1
        row = np.repeat(np.arange(len(n)), windows)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        sequence = start[row] // length + nth
        begin = np.maximum(start[row], sequence * length)
        size = np.minimum(start[row] + n[row], (sequence + 1) * length) - begin
        local, ids = begin - start[row], _ids(batch.column(4).to_pylist(), n)
        sums = [zlib.crc32(ids[r][a:a + s]) for r, a, s in zip(row, local, size)]
        yield batch_of(schema, batch.column(2).take(pa.array(row)), local, size, sums, n[row], sequence, begin % length)

    return in_batches(stored_tokens.select("part", "within", "doc_id", "n", "ids"), cut, PIECES)


def sequences(stored_tokens: DataFrame, length: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids): the windows themselves, the last one padded unless its length is a power of two."""
    ddl = "sequence_id long, offset long, ids array<int>"
    schema, first = arrow_schema(ddl), offsets(stored_tokens)

    def windows(batch: pa.RecordBatch):
        # Documents of a batch lie one after the other, so it gives whole windows and at most two partial ones.
        if not batch.num_rows:
            return
        part, within, n = (batch.column(i).to_numpy() for i in (0, 1, 3))
        ids = _ids(batch.column(4).to_pylist(), n)
        begin = np.array([first[p] for p in part], dtype=np.int64) + within
        order = np.argsort(begin)
        runs = np.split(order, np.flatnonzero(begin[order][1:] != (begin + n)[order][:-1]) + 1)
        for run in runs:
            line, at = np.concatenate([ids[i] for i in run]), int(begin[run[0]])
            cuts = [0, *range(length - at % length, len(line), length), len(line)]
            spans = [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
            yield batch_of(schema, [(at + a) // length for a, _ in spans], [(at + a) % length for a, _ in spans],
                           [line[a:b].astype(np.int32) for a, b in spans])

    records = in_batches(stored_tokens.select("part", "within", "doc_id", "n", "ids"), windows, ddl)
    whole = records.where(F.size("ids") == length).select("sequence_id", "ids")
    joined = records.where(F.size("ids") < length).groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
    every = whole.union(joined).withColumn("n_tokens", F.size("ids"))
    power = F.expr("bit_count(n_tokens) = 1")
    padded = F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(length) - F.col("n_tokens")))
    return every.select("sequence_id", "n_tokens", F.when(power, F.col("ids")).otherwise(padded).alias("ids"))


def pack(df: DataFrame, path: str, length: int = 2048, end_id: int = 1, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """All documents in sequences of `length` ids: one row per piece."""
    return pieces(tokens(df, path, end_id, id_col, text), length)
