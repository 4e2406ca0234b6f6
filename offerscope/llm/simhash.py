"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints: majority bits of the XXH64 of word shingles. Two fingerprints within the radius meet on a common variant when each
emits its whole ball of half the radius. An odd radius is made even by leaving out one block of bits, once for every block: one
of the blocks holds a differing bit, so what is left differs in one bit less. For radius 3 and three blocks that is 131 variants
per distinct fingerprint, whatever the number of rows. Variants are shuffled, colliding fingerprints are compared on
all bits, and every bucket gives a spanning forest of its true links (not all pairs): same components, linear output.

Equal fingerprints are one node, so copies cost nothing beyond the first. Components are found by components.py.

Defined cases: a null or empty text has fingerprint zero and links like any other; a text shorter than a shingle is one shingle;
a null id never names a component (a component of null ids only has a null id); repeated rows each get a row; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerscope.llm.common import arrow_schema, batch_of, in_batches, partitions_for, stored, text_bytes
from offerscope.llm.components import components

BITS, BLOCKS, SLICE = 64, 3, 1 << 16
ROWS_EACH = 2_000_000


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) >= width else iter([b" ".join(words)])
    hashes = map(partial(xxhash.xxh64_intdigest, seed=seed), shingles)
    ones, n = np.zeros(BITS, dtype=np.int64), 0
    while len(part := np.fromiter(islice(hashes, SLICE), dtype="<u8")):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of every row; fp holds the 64 bits as a signed long."""
    ddl = "doc_id long, fp long"
    schema = arrow_schema(ddl)

    def run(batch: pa.RecordBatch):
        values = [fingerprint(t, width, seed) for t in batch.column(1).to_pylist()]
        yield batch_of(schema, batch.column(0), pa.array(np.array(values, dtype=np.uint64).view(np.int64)))

    return in_batches(df.select(F.col(id_col).cast("long"), text_bytes(text)), run, ddl)


def _views(radius: int) -> list[tuple[int, int]]:
    """(rotation, bits kept) of every view of a fingerprint that balls are taken in."""
    if radius % 2 == 0:
        return [(0, BITS)]
    ends = [BITS * i // BLOCKS for i in range(BLOCKS + 1)]
    return [(a, BITS - (b - a)) for a, b in zip(ends, ends[1:])]


def variants(fps: np.ndarray, radius: int) -> Iterator[np.ndarray]:
    """Per view the keys of all fingerprints' balls, one row each. The left-out bits carry the number of the view."""
    for number, (rotation, kept) in enumerate(_views(radius)):
        turned = (fps << np.uint64(rotation)) | (fps >> np.uint64(BITS - rotation)) if rotation else fps
        if kept < BITS:
            turned = (turned & np.uint64((1 << kept) - 1)) | np.uint64(number << kept)
        flips = [sum(1 << b for b in c) for size in range(radius // 2 + 1) for c in combinations(range(kept), size)]
        yield turned[:, None] ^ np.array(flips, dtype=np.uint64)[None, :]


def forest(members: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """Spanning links of one bucket: every found member is compared with those not yet reached."""
    rest = members
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            at = reached.pop()
            near = np.bitwise_count(rest ^ at) <= radius
            if near.any():
                yield at, rest[near]
                reached.extend(rest[near])
                rest = rest[~near]


def _meet(keys: np.ndarray, fps: np.ndarray, radius: int) -> np.ndarray:
    """Links of all buckets of a partition, as two columns without repetition."""
    order = np.argsort(keys, kind="stable")
    keys, fps = keys[order], fps[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    two = starts[sizes == 2]
    two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= radius]
    found = [np.stack([fps[two], fps[two + 1]], axis=1)]
    for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
        for at, near in forest(fps[start:start + size], radius):
            found.append(np.stack([np.full(len(near), at, dtype=np.uint64), near], axis=1))
    links = np.concatenate(found)
    return np.unique(np.sort(links, axis=1), axis=0)


def links(nodes: DataFrame, radius: int = 3, partitions: int | None = None) -> DataFrame:
    """(a, b) pairs of distinct fingerprints within the radius that span the same components as all such pairs."""
    spread, met = arrow_schema("key long, fp long"), arrow_schema("a long, b long")

    def emit(batch: pa.RecordBatch):
        fps = batch.column(0).to_numpy().view(np.uint64)
        for at in range(0, len(fps), 4096):
            part = fps[at:at + 4096]
            for keys in variants(part, radius):
                yield batch_of(spread, pa.array(keys.ravel().view(np.int64)),
                               pa.array(np.repeat(part, keys.shape[1]).view(np.int64)))

    def meet(batches):
        got = list(batches)
        if got:
            keys, fps = (np.concatenate([b.column(i).to_numpy() for b in got]).view(np.uint64) for i in (0, 1))
            pairs = _meet(keys, fps, radius).view(np.int64)
            yield batch_of(met, pa.array(pairs[:, 0]), pa.array(pairs[:, 1]))

    keyed = in_batches(nodes.select("fp"), emit, "key long, fp long")
    keyed = keyed.repartition(partitions, "key") if partitions else keyed.repartition("key")
    return keyed.mapInArrow(meet, "a long, b long").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3,
                    seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest id that links lead to, the row's own included."""
    rows = stored(fingerprints(df, id_col, text, width, seed), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-nodes")
    balls = sum(v.shape[1] for v in variants(np.zeros(1, dtype=np.uint64), radius))
    found = links(nodes, radius, partitions_for(df, nodes.count() * balls, ROWS_EACH))
    roots = components(found, "a", "b").withColumnRenamed("node", "fp")
    rooted = stored(nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    named = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")
