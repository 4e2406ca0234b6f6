"""Byte-level BPE: ranked merges folded over byte arrays by Spark's higher-order functions, and decoding.

A word is one match of the tokenizer's pattern. Every stretch of its bytes that is a token of the rank map names a merge; the word's
merges, sorted by rank, are folded over it one after the other, each replacing all its occurrences from left to right. One pass is
enough: a token is always built from the same two tokens, and by rising ranks (a test proves both for the vocabulary), so a merge
never makes an earlier one possible. The rank map is a literal of the plan, laid out in hash buckets. During the fold a byte is
the character of that number and a token the character 256 + id, so a merge is a replacement of two characters by one.

The corpus is counted once to find its distinct words. The most frequent ones (`DICTIONARY` at most, a bounded table) are folded
by Spark and handed to the tasks as a dictionary. Other words are folded where they stand, the rare words of 500 texts at once: in
every round each word merges its lowest-ranked pair of neighbours, in array operations over all words. Ids are decoded in Python: a
look-up in a literal costs the higher-order functions microseconds, see the README for figures. Nothing is dropped and no text is
shuffled. The pattern must take a space and the letters after it as one word, as the usual ones do.

Defined cases: a null or empty text has no ids (both digests are of nothing); repeated rows each get a row; a null id is carried;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerscope.llm.common import arrow_schema, batch_of, stored, text_bytes

DICTIONARY = 1 << 17
#: Distinct chunks a task counts before it tells their words, and chunks whose ids it keeps.
COUNTED, CHUNKS = 200_000, 250_000
SLOTS = 1 << 16
#: Bytes of a word that is folded together with others, words folded at once, and the rank of a pair that is no token.
SHORT, TOGETHER, NONE = 64, 4096, (1 << 31) - 1
#: A text without this is cut before every space; elsewhere white space may stand on both sides of a space.
MAYBE_NO_CUT = re.compile(r" (?:\s|$)")


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def halves(token: bytes, known: dict[bytes, int]) -> list[bytes]:
    """The two tokens that a token is merged from; more if its merges do not lead there by rising ranks."""
    limit, parts, last = known[token], [token[i:i + 1] for i in range(len(token))], -1
    while len(parts) > 2:
        rank, at = min((known.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= limit or rank < last:
            break
        parts[at:at + 2], last = [parts[at] + parts[at + 1]], rank
    return parts


def _literal(value: object, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value, separators=(",", ":"))), kind)


def _mark(rank: int) -> str:
    """The character of a token; surrogates are left out."""
    return chr(256 + rank if 256 + rank < 0xD800 else 256 + rank + 0x800)


def _cell(pairs: np.ndarray, cells: int) -> np.ndarray:
    """Cell of every pair by its hash; `cells` is a power of two."""
    return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & (cells - 1)


@dataclass(frozen=True)
class Merges:
    """The rank map of a vocabulary, and what each merge replaces by what."""

    known: dict[bytes, int]
    pairs: list[str]
    marks: list[str]
    longest: int
    keys: np.ndarray  # left * tokens + right in the cell of its hash or the next free one; a free cell holds -1
    made: np.ndarray

    def fold(self, word: bytes) -> list[int]:
        """Ids of one long word, by the steps of `Bpe.encode`; the time does not grow with the square of its length."""
        n = len(word)
        stretches = (word[i:i + k] for i in range(n - 1) for k in range(2, min(self.longest, n - i) + 1))
        line = word.decode("latin-1")
        for rank in sorted(set(map(self.known.get, stretches)) - {None}):
            if self.pairs[rank]:
                line = line.replace(self.pairs[rank], self.marks[rank])
        return [self.known[bytes([c])] if c < 256 else c - 256 if c < 0xD800 else c - 0x900 for c in map(ord, line)]

    def fold_all(self, words: list[bytes]) -> list[bytes]:
        """Ids (packed 32-bit) of many words, none of them empty."""
        out = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        long = next((k for k, i in enumerate(order) if len(words[i]) > SHORT), len(order))
        for begin in range(0, long, TOGETHER):
            part = order[begin:min(begin + TOGETHER, long)]
            for i, ids in zip(part, self._together([words[i] for i in part])):
                out[i] = ids
        for i in order[long:]:
            out[i] = array("i", self.fold(words[i])).tobytes()
        return out

    def _together(self, words: list[bytes]) -> list[bytes]:
        """Rounds over a table with a column per word and a row per byte. A token stands in the row of its first byte; `after` and
        `before` are the rows of its neighbours, row -1 is empty."""
        size, width = len(words), max(map(len, words))
        lengths, rows = np.fromiter(map(len, words), dtype=np.int32, count=size), np.arange(width + 1, dtype=np.int32)[:, None]
        single = np.array([self.known[bytes([b])] for b in range(256)], dtype=np.int64)
        tokens = np.full((width + 1, size), -1, dtype=np.int64)
        tokens[:-1] = single[np.array(words, dtype=f"S{width}").view(np.uint8).reshape(size, width).T]
        tokens[rows >= lengths] = -1
        after, before = np.repeat(rows + 1, size, axis=1), np.repeat(rows - 1, size, axis=1)
        joined = np.full((width + 1, size), NONE, dtype=np.int64)
        joined[:-1] = self.together(tokens[:-1], tokens[1:])
        while len(open_ := np.flatnonzero(joined.min(axis=0) != NONE)):
            left = joined[:, open_].argmin(axis=0)
            right = after[left, open_]
            end, start = after[right, open_], before[left, open_]
            tokens[left, open_], tokens[right, open_] = joined[left, open_], -1
            joined[right, open_], after[left, open_], before[end, open_] = NONE, end, left
            joined[left, open_] = self.together(tokens[left, open_], tokens[end, open_])
            joined[start, open_] = self.together(tokens[start, open_], tokens[left, open_])
        there = tokens.T >= 0
        packed, ends = tokens.T[there].astype("<i4").tobytes(), (4 * there.sum(axis=1).cumsum()).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def together(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that two tokens make, or NONE. -1 is no token."""
        wanted = np.where((left < 0) | (right < 0), -1, left * len(self.pairs) + right).ravel()
        at = _cell(wanted, len(self.keys))
        seen = self.keys[at]
        while len(rest := np.flatnonzero((seen != wanted) & (seen >= 0))):
            at[rest] = (at[rest] + 1) & (len(self.keys) - 1)
            seen[rest] = self.keys[at[rest]]
        return self.made[at].reshape(left.shape)


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    known = ranks(path)
    size = max(known.values()) + 1
    pairs = [""] * size
    for token, rank in known.items():
        if len(token) > 1 and len(two := halves(token, known)) == 2:
            pairs[rank] = "".join(chr(x[0]) if len(x) == 1 else _mark(known[x]) for x in two)
    cuts = ((known.get(token[:i]), known.get(token[i:]), rank) for token, rank in known.items() for i in range(1, len(token)))
    made = {a * size + b: rank for a, b, rank in cuts if a is not None and b is not None}
    keys, values = [-1] * (cells := 1 << (4 * len(made)).bit_length()), [NONE] * cells
    for pair, at in zip(made, _cell(np.array(list(made), dtype=np.int64), cells).tolist()):
        while keys[at] >= 0:
            at = (at + 1) % cells
        keys[at], values[at] = pair, made[pair]
    return Merges(known, pairs, [_mark(i) for i in range(size)], max(map(len, known)), np.array(keys), np.array(values))


class Bpe:
    """Column expressions that encode words."""

    def __init__(self, path: str):
        self.merges = merges(path)
        keys: list[list[str]] = [[] for _ in range(SLOTS)]
        merged: list[list[int]] = [[] for _ in range(SLOTS)]
        for token, rank in self.merges.known.items():
            if self.merges.pairs[rank]:
                slot = zlib.crc32(token) % SLOTS
                keys[slot].append(base64.b64encode(token).decode())
                merged[slot].append(rank)
        self.keys, self.ranks = _literal(keys, "array<array<binary>>"), _literal(merged, "array<array<int>>")
        self.pairs, self.marks = _literal(self.merges.pairs, "array<string>"), _literal(self.merges.marks, "array<string>")
        self.bytes = _literal([self.merges.known[bytes([b])] for b in range(256)], "array<int>")

    def rank(self, stretch: Column) -> Column:
        """The id of a stretch of bytes that merges lead to, else null."""
        slot = F.pmod(F.crc32(stretch), F.lit(SLOTS)).cast("int")
        return F.get(F.get(self.ranks, slot), F.array_position(F.get(self.keys, slot), stretch).cast("int") - 1)

    def encode(self, word: Column) -> Column:
        """Ids of a word given as bytes."""
        n = F.octet_length(word)
        stretches = F.flatten(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.transform(
            F.sequence(F.lit(2), F.least(F.lit(self.merges.longest), n - i + 1)), lambda k: self.rank(F.substring(word, i, k)))))
        merges = F.array_sort(F.array_distinct(F.array_compact(stretches)))
        folded = F.aggregate(merges, F.decode(word, "ISO-8859-1"),
                             lambda line, r: F.replace(line, F.get(self.pairs, r), F.get(self.marks, r)))
        marks = F.transform(F.split(F.when(n > 1, folded).otherwise(F.decode(word, "ISO-8859-1")), ""), F.ascii)
        ids = F.transform(marks, lambda c: F.when(c < 256, F.get(self.bytes, c)).when(c < 0xD800, c - 256).otherwise(c - 0x900))
        return F.when(n == 0, F.array().cast("array<int>")).otherwise(ids)


def chunks(text: str) -> list[str]:
    """Stretches that no word crosses: the text cut before single spaces. All but the first stand without their leading space."""
    parts = text.split(" ")
    if not MAYBE_NO_CUT.search(text):
        return parts
    out = parts[:1]
    for part in parts[1:]:
        before = out[-1]
        if (not before or before[-1].isspace()) and (not part or part[0].isspace()):
            out[-1] = f"{before} {part}"
        else:
            out.append(part)
    return out


def _splitter(pattern: str) -> Callable[[str, str], list[str]]:
    """Words of a chunk after its leading space, if any."""
    import regex

    find = regex.compile(pattern).findall
    return lambda lead, chunk: [lead + chunk] if chunk.isascii() and chunk.isalpha() else find(lead + chunk)


def _texts(batch: pa.RecordBatch, column: int) -> list[str]:
    return [(t or b"").decode("utf-8", "replace") for t in batch.column(column).to_pylist()]


def word_counts(df: DataFrame, pattern: str, text: str = "text") -> DataFrame:
    """(word, n) of every distinct word of all texts; counts are added up per task before the shuffle."""
    ddl = "word binary, n long"
    schema = arrow_schema(ddl)

    def run(batches):
        split, later, first = _splitter(pattern), Counter(), Counter()

        def told():
            words: dict[str, int] = {}
            for counts, lead in ((later, " "), (first, "")):
                for chunk, n in counts.items():
                    for word in split(lead, chunk):
                        words[word] = words.get(word, 0) + n
                counts.clear()
            found = list(words.items())
            for at in range(0, len(found), 50_000):
                part = found[at:at + 50_000]
                yield batch_of(schema, [w.encode() for w, _ in part], [n for _, n in part])

        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                for t in _texts(whole.slice(begin, 500), 0):
                    cut = chunks(t)
                    first[cut[0]] += 1
                    later.update(cut[1:])
                    if len(later) + len(first) > COUNTED:
                        yield from told()
        yield from told()

    return df.select(text_bytes(text)).mapInArrow(run, ddl).groupBy("word").agg(F.sum("n").alias("n"))


def dictionary(counts: DataFrame, bpe: Bpe, limit: int = DICTIONARY) -> dict[bytes, bytes]:
    """Ids (packed 32-bit) of all words above the lowest count that leaves no more than `limit` of them."""
    counts = stored(counts, "words")
    sizes = sorted(((r["n"], r["words"]) for r in counts.groupBy("n").agg(F.count("*").alias("words")).collect()), reverse=True)
    least, total = None, 0
    for n, words in sizes:
        total += words
        if total > limit:
            break
        least = n
    if least is None:
        return {}
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folded = counts.where(F.col("n") >= least).select("word").repartition(tasks).select("word", bpe.encode(F.col("word")).alias("ids")).toArrow()
    return {word: np.array(ids, dtype="<i4").tobytes() for word, ids in zip(folded["word"].to_pylist(), folded["ids"].to_pylist())}


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text", limit: int = DICTIONARY) -> DataFrame:
    """(doc_id, ids) of every row."""
    known = df.sparkSession.sparkContext.broadcast(dictionary(word_counts(df, pattern, text), Bpe(path), limit))
    ddl = "doc_id long, ids array<int>"
    schema = arrow_schema(ddl)

    def run(batches):
        split, words, fold_all = _splitter(pattern), known.value, merges(path).fold_all
        kept, older = {}, {}  # two generations: what is still in use outlives the older one

        def coded(lead: str, parts: list[str]) -> list[bytes]:
            """Ids of chunks; the rare words of all of them are folded at once."""
            cut = [[word.encode() for word in split(lead, part)] for part in parts]
            rare = list({word for line in cut for word in line if word not in words})
            folded = dict(zip(rare, fold_all(rare)))
            return [b"".join([words.get(word) or folded[word] for word in line]) for line in cut]

        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                batch = whole.slice(begin, 500)
                cut = [chunks(t) for t in _texts(batch, 1)]
                if len(kept) >= CHUNKS // 2:
                    kept, older = {}, kept
                new = []
                for chunk in {chunk for _, *later in cut for chunk in later if chunk not in kept}:
                    if (ids := older.get(chunk)) is None:
                        new.append(chunk)
                    else:
                        kept[chunk] = ids
                for at in range(0, len(new), CHUNKS // 8):
                    part = new[at:at + CHUNKS // 8]
                    kept.update(zip(part, coded(" ", part)))
                firsts = coded("", [c[0] for c in cut])
                ids = [np.frombuffer(b"".join([first, *map(kept.__getitem__, c[1:])]), dtype="<i4") for first, c in zip(firsts, cut)]
                yield batch_of(schema, batch.column(0), pa.array(ids, type=pa.list_(pa.int32())))

    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text)).mapInArrow(run, ddl)


def decode(df: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the bytes that an array of ids stands for: the ids' binary pieces, one after the other. Null ids give null."""
    known = ranks(path)
    pieces = [b""] * (max(known.values()) + 1)
    for token, rank in known.items():
        pieces[rank] = token

    @F.arrow_udf("binary")
    def joined(values: pa.Array) -> pa.Array:
        ends, flat, there = values.offsets.to_pylist(), values.values.to_numpy(), values.is_valid().to_pylist()
        return pa.array([b"".join(map(pieces.__getitem__, flat[a:b].tolist())) if valid else None
                         for a, b, valid in zip(ends, ends[1:], there)], type=pa.binary())

    return df.withColumn(name, joined(ids))
