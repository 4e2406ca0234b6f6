"""Terms of many documents in packed blocks: what ``mean_tfidf`` stores, counts and sums without a row per document and term.

A block holds some documents as a sorted list of their words and the places of these words. Terms are numbered by pairs of words, so
the terms of a block are sorted as text wherever their numbers are. A block tells every part of the terms (a hash of the words) its
own terms once, with a count; what comes back has the same order and needs no names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

# Places of words a block may hold; a row takes ROW more, BYTES of text one at least, a longer document a block of its own.
PLACES, ROW, BYTES = 1_200_000, 16, 8
#: Places of words and of pairs of them, so terms at most, that one part may meet.
TERMS_PER_PART = 4_000_000
#: Part number of the rows that bring a block the lengths of documents it shares with other rows.
LENGTHS = -1
#: Schemas between the steps; those that carry values of the documents are completed in ``terms``.
TOLD, SENT = "part int, block long, size int, names binary, numbers binary", "block long, part int, size int, numbers binary"


def pack(*columns: np.ndarray) -> bytes:
    """Integers and doubles of one length, ordered by byte: leading bytes are nearly all the same."""
    data = np.stack([np.ascontiguousarray(c, dtype=None if c.dtype == np.float64 else np.int64).view(np.int64) for c in columns])
    planes = data.view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(size: int, packed: bytes, columns: int = 1) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 8 * size * columns, codec="zstd"), dtype=np.uint8).reshape(columns, 8, size)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int64).reshape(columns, size)


def _lines(texts: Iterable[bytes]) -> pa.StringArray:
    """The lines of texts, each with its line feed."""
    data = b"".join(texts)
    ends = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10) + 1
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(np.r_[0, ends].astype(np.int32)), pa.py_buffer(data))


def _text(data: bytes) -> bytes:
    """Compressed, with its length in front."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _read(text: bytes) -> bytes:
    return pa.decompress(text[8:], int.from_bytes(text[:8], "little"), codec="zstd", asbytes=True)


def _places(tokens: pa.ListArray) -> np.ndarray:
    """Places that each row takes."""
    starts = tokens.offsets.to_numpy().astype(np.int64)
    words = tokens.values
    ends = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset:] if len(words) else np.zeros(1, dtype=np.int32)
    return np.maximum(np.diff(starts), np.diff(ends[starts].astype(np.int64)) // BYTES)


def _packed(table: pa.Table, number: int, breaks: str, stopwords: frozenset[str]) -> dict[str, object]:
    tokens = table.column("tokens").combine_chunks()
    row = np.repeat(np.arange(len(tokens), dtype=np.int32), tokens.value_lengths().to_numpy())
    found = tokens.flatten().dictionary_encode()
    known = found.dictionary.to_pylist()
    words = sorted({w for w in known if w[0] not in breaks} - stopwords)
    place = {w: i for i, w in enumerate(words, 1)}
    ids = np.array([0 if w[0] in breaks else place.get(w, -1) for w in known], dtype=np.int32)[found.indices.to_numpy()]
    del found
    row, ids = row[ids >= 0], ids[ids >= 0]
    return {"block": number, "docs": table.column("doc").combine_chunks(), "groups": table.column("group").combine_chunks(),
            "places": 2 * int(_places(tokens).sum()), "words": _text("".join(w + "\n" for w in words).encode()), "size": len(ids), "ids": pack(ids),
            "lengths": pack(np.bincount(row, minlength=len(tokens)))}


def packer(schema: pa.Schema, breaks: str, stopwords: frozenset[str], places: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (doc, group, tokens with breaks between segments) -> blocks; a block ends where it is full, whatever its documents are."""
    def one(pending: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        block = _packed(pa.Table.from_batches(pending), number, breaks, stopwords)
        arrays = []
        for field in schema:
            value = block[field.name]
            if pa.types.is_list(field.type):
                arrays.append(pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value.cast(field.type.value_type)).cast(field.type))
            else:
                arrays.append(pa.array([value], field.type))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, pending, held = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            ends = np.cumsum(_places(batch.column(batch.schema.get_field_index("tokens"))) + ROW)
            at = 0
            while at < len(ends):
                before = int(ends[at - 1]) if at else 0
                upto = int(np.searchsorted(ends, before + places - held, side="right"))
                if upto == at and not pending:
                    upto = at + 1
                if upto > at:
                    pending.append(batch.slice(at, upto - at))
                    held += int(ends[upto - 1]) - before
                    at = upto
                if at < len(ends):
                    yield one(pending, number)
                    number, pending, held = number + 1, [], 0
        if pending:
            yield one(pending, number)

    return blocks


class Block:
    """The terms of a block in the order of their parts, and for each of its rows the terms with their counts."""

    def __init__(self, words: bytes, size: int, ids: bytes, lengths: bytes, rows: int, parts: int):
        self.words = _read(words).decode().split("\n")[:-1]
        ids = unpack(size, ids)[0]
        row = np.repeat(np.arange(rows), unpack(rows, lengths)[0])
        width = len(self.words) + 1
        pair = (ids[:-1] > 0) & (ids[1:] > 0) & (row[:-1] == row[1:])
        # A term is the number of its first word and that of its second, or 0.
        terms = np.concatenate([ids[ids > 0] * width, ids[:-1][pair] * width + ids[1:][pair]])
        row = np.concatenate([row[ids > 0], row[:-1][pair]])
        del ids, pair
        new = np.ones(len(row), dtype=bool)
        if rows * width * width < 1 << 63:  # in place, as these arrays are the largest of a task
            row *= width * width
            row += terms
            del terms
            row.sort()
            np.not_equal(row[1:], row[:-1], out=new[1:])
            self.row, terms = np.divmod(row[new], width * width)
            self.row = self.row.astype(np.int32)
        else:
            order = np.lexsort((terms, row))
            row, terms = row[order], terms[order]
            new[1:] = (row[1:] != row[:-1]) | (terms[1:] != terms[:-1])
            self.row, terms = row[new], terms[new]
        self.tf = np.diff(np.flatnonzero(new), append=len(row)).astype(np.int32)
        del row, new
        terms, term = np.unique(terms, return_inverse=True)
        self.first, self.second = np.divmod(terms, width)
        hashed = np.array([0, *(zlib.crc32(w.encode()) for w in self.words)], dtype=np.uint64)
        mixed = (hashed[self.first] * np.uint64(0x9E3779B97F4A7C15) + hashed[self.second]) * np.uint64(0xBF58476D1CE4E5B9)
        part = ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        place = np.empty(len(order), dtype=np.int32)
        place[order] = np.arange(len(order))
        self.term, self.first, self.second = place[term], self.first[order], self.second[order]
        self.starts = np.searchsorted(part[order], np.arange(parts + 1))

    def names(self, chosen: np.ndarray) -> pa.Array:
        """The terms at these places, each with a line feed."""
        first, second = pa.array(["", *self.words]), pa.array(["\n", *(f" {w}\n" for w in self.words)])
        return pc.binary_join_element_wise(first.take(pa.array(self.first[chosen])), second.take(pa.array(self.second[chosen])), "")


def _data(names: pa.Array, start: int, end: int) -> bytes:
    offsets = np.frombuffer(names.buffers()[1], dtype=np.int32)
    return memoryview(names.buffers()[2])[offsets[start]:offsets[end]].tobytes()


def _blocks(table: pa.Table | pa.RecordBatch, parts: int) -> Iterator[tuple[int, pa.Array, Block]]:
    column = {name: table.column(name) for name in ("block", "groups", "words", "size", "ids", "lengths")}
    for i in range(table.num_rows):
        groups = column["groups"][i].values
        yield column["block"][i].as_py(), groups, Block(column["words"][i].as_py(), column["size"][i].as_py(), column["ids"][i].as_py(),
                                                        column["lengths"][i].as_py(), len(groups), parts)


def teller(schema: pa.Schema, parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks -> for each part, the block's terms and in how many of its rows they stand."""
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, _, b in _blocks(batch, parts):
                names, counts = b.names(np.arange(len(b.first))), np.bincount(b.term, minlength=len(b.first))
                rows = [(p, number, int(y - x), _text(_data(names, x, y)), pack(counts[x:y]))
                        for p, (x, y) in enumerate(zip(b.starts, b.starts[1:])) if x < y]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)

    return tell


def counter(schema: pa.Schema, least: int, most: float) -> Callable[[pa.Table], pa.Table]:
    """What blocks told a part -> for each block, the document frequency of its terms over all rows; 0 outside the bounds."""
    def count(told: pa.Table) -> pa.Table:
        part, sizes = told.column("part")[0].as_py(), told.column("size").to_pylist()
        term = _lines(_read(x.as_py()) for x in told.column("names")).dictionary_encode()
        own = np.concatenate([unpack(n, x.as_py())[0] for n, x in zip(sizes, told.column("numbers"))])
        code = term.indices.to_numpy()
        df = np.bincount(code, own, minlength=len(term.dictionary)).astype(np.int64)
        df[(df < least) | (df > most)] = 0
        df, ends = df[code], np.cumsum(sizes).tolist()
        sent = [pack(df[y - n:y]) for n, y in zip(sizes, ends)]
        return pa.Table.from_arrays([told.column("block"), pa.array([part] * len(sizes), schema.field("part").type), told.column("size"),
                                     pa.array(sent, schema.field("numbers").type)], schema=schema)

    return count


class Weights:
    """The weights of a block's terms, by row."""

    def __init__(self, b: Block, sent: pa.Table, n_docs: float):
        df = np.zeros(len(b.first), dtype=np.int64)
        self.lengths: list[tuple[int, float]] = []
        for part, size, numbers in zip(sent.column("part").to_pylist(), sent.column("size").to_pylist(), sent.column("numbers")):
            if part == LENGTHS:
                row, square = unpack(size, numbers.as_py(), 2)
                self.lengths.append((row, square.view(np.float64)))
            else:
                df[b.starts[part]:b.starts[part + 1]] = unpack(size, numbers.as_py())[0]
        inside = df[b.term] > 0
        self.row, self.term = b.row[inside], b.term[inside]
        self.w = (1.0 + np.log(b.tf[inside].astype(np.float64))) * (np.log((1.0 + n_docs) / (1.0 + df[self.term])) + 1.0)

    def squares(self, rows: int) -> np.ndarray:
        """Sum of squared weights of each row; of all rows of its document where that has several."""
        out = np.bincount(self.row, self.w * self.w, minlength=rows)
        for row, square in self.lengths:
            out[row] = square
        return out


def squarer(schema: pa.Schema, parts: int, n_docs: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A block and the frequencies of its terms -> (block, row, square)."""
    def square(table: pa.Table, sent: pa.Table) -> pa.Table:
        out = [schema.empty_table()]
        for number, groups, b in _blocks(table, parts):
            squares = Weights(b, sent, n_docs).squares(len(groups))
            out.append(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip((np.full(len(groups), number), np.arange(len(groups)), squares), schema)], schema=schema))
        return pa.concat_tables(out)

    return square


def collector(schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    """(block, row, square) of one block -> one row as blocks get them."""
    def collect(table: pa.Table) -> pa.Table:
        numbers = pack(table.column("row").to_numpy(), table.column("square").to_numpy())
        return pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip((table.column("block")[0].as_py(), LENGTHS, table.num_rows, numbers), schema)], schema=schema)

    return collect


def scorer(schema: pa.Schema, parts: int, n_docs: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A block and the frequencies of its terms -> for each part, the unit weights summed by group and term."""
    def score(table: pa.Table, sent: pa.Table) -> pa.Table:
        out = [schema.empty_table()]
        for number, groups, b in _blocks(table, parts):
            weights = Weights(b, sent, n_docs)
            known = groups.dictionary_encode()
            group = known.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)[weights.row]
            n = max(1, len(known.dictionary))
            unit = weights.w / np.sqrt(weights.squares(len(groups)))[weights.row]
            pairs = weights.term * np.int64(n) + group
            if known.indices.null_count:
                unit, pairs = unit[group >= 0], pairs[group >= 0]
            del weights, group
            pairs, place = np.unique(pairs, return_inverse=True)
            sums = np.bincount(place, unit, minlength=len(pairs))
            del place, unit
            term, group = np.divmod(pairs, n)
            chosen, local = np.unique(term, return_inverse=True)
            names, ends = b.names(chosen), np.searchsorted(chosen, b.starts)
            rows, values = [], []
            for p, (x, y) in enumerate(zip(ends, ends[1:])):
                if x < y:
                    i, j = np.searchsorted(local, [x, y])
                    here, code = np.unique(group[i:j], return_inverse=True)
                    values.append(known.dictionary.take(pa.array(here)))
                    rows.append((p, number, int(j - i), _text(_data(names, x, y)), pack(local[i:j] - x, code, sums[i:j])))
            if rows:
                arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), pa.concat_arrays(values))
                out.append(pa.Table.from_arrays([*arrays, lists.cast(schema.field("groups").type)], schema=schema))
        return pa.concat_tables(out)

    return score


def adder(schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    """What blocks summed for a part -> (group, term, w) over all blocks."""
    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        texts = [_lines([_read(x.as_py())]) for x in table.column("names")]
        names = pa.concat_arrays(texts).dictionary_encode()
        groups = [x.values for x in table.column("groups")]
        known = pa.concat_arrays(groups).dictionary_encode()
        code, value = names.indices.to_numpy(), known.indices.to_numpy()
        n, keys, sums, at, of = len(known.dictionary), [], [], 0, 0
        for size, numbers, lines, own in zip(table.column("size").to_pylist(), table.column("numbers"), texts, groups):
            term, group, w = unpack(size, numbers.as_py(), 3)
            keys.append(code[term + at] * np.int64(n) + value[group + of])
            sums.append(w.view(np.float64))
            at, of = at + len(lines), of + len(own)
        pairs, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate(sums), minlength=len(pairs))
        term, group = np.divmod(pairs, n)
        columns = known.dictionary.take(pa.array(group)), pc.utf8_rtrim(names.dictionary, "\n").take(pa.array(term)), pa.array(total)
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return add
