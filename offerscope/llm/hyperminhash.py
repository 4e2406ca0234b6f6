"""Near-duplicates by word shingles: HyperMinHash sketches propose pairs, the exact Jaccard similarity decides.

A text is the set of its distinct shingles of `width` words; equal sets are one node. Its sketch has `GROUPS` x `BUCKETS` registers: each
of the hash functions deals the shingles to buckets, and a register keeps the least hash of its bucket in 16 bits, as the count of
leading zeros and the `MANTISSA` bits that follow. Band i is bucket i of every hash function; an empty band has no key. Two sets of
similarity s agree in a register with probability s, so at 0.8 they share none of the 32 bands with probability
(1 - 0.8^6)^32 = 6e-5. A different shingle disturbs at most one register per hash function, so small sets are missed less often.

A bucket is not paired off. First every member is compared with the bucket's lead, the member with the smallest share of shingles of its
own; this settles a large group of copies, as members of one component need no further comparison. Then, in turns, members outside
the bucket's largest component (`ASKERS` of them at a time) ask the members of other components and leave. Such a bucket is cut into
blocks of `BLOCK` members; every set comes to its block once and every asker to each block, so no pair is ever a row: a task
emits one link per asker and component met. A pair that shares several buckets is compared in the first one alone. A pair goes on
only if its sizes allow the similarity. In crowded buckets, and only there, the size is that of the shared part: a shingle that no other
member of a crowded bucket has cannot be shared, so texts that were edited heavily part without a comparison. Turns end when no bucket
holds two components, so every pair of a bucket is decided or connected.

A pair first meets on its sketches: the share of equal registers, less the share expected from accidental collisions of such short registers
at these set sizes, estimates the similarity. Pairs more than five standard deviations below the limit go; the others are compared
on their full sets. Shingles are compared by 64-bit hashes of their lower-case (A-Z) words; a text shorter than a shingle is one.

Defined cases: null and empty texts have no shingles, link with nothing and keep their own id; a null id never names a component unless all
its copies are null; ties go to the smallest id; repeated rows each get a row; very long texts are sketched in slices; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerscope.llm import simhash
from offerscope.llm.common import batch_of, in_batches, partitions_for, stored, text_bytes
from offerscope.llm.components import components
from offerscope.llm.substring import window_hashes

GROUPS, BUCKETS, MANTISSA = 6, 32, 10
#: Members from which a bucket is crowded, members of a bucket that ask in one turn (about), and members of a block (about).
CROWD, ASKERS, BLOCK = 32, 1024, 512
DEVIATIONS = 5.0
SLICE, ROWS_EACH = 1 << 13, 1000
FACTORS, TERMS = np.random.default_rng(42).integers(0, 1 << 63, (2, GROUPS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))], dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    return np.unique(window_hashes(hashes, width)[:len(words) - width + 1])


def node_of(grams: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).view(np.int64))


def sketch(grams: np.ndarray) -> np.ndarray:
    """One 16-bit register per hash function and bucket: 0 is empty, else 1 + leading zeros and mantissa of the least hash."""
    least = np.full((GROUPS, BUCKETS), np.iinfo(np.uint64).max, dtype=np.uint64)
    full = np.zeros((GROUPS, BUCKETS), dtype=bool)
    shift = np.uint64(64 - (BUCKETS - 1).bit_length())
    for at in range(0, len(grams), SLICE):
        mixed = grams[None, at:at + SLICE] * FACTORS[:, None] + TERMS[:, None]
        mixed ^= mixed >> np.uint64(29)
        mixed *= K2
        mixed ^= mixed >> np.uint64(32)
        mixed.sort(axis=1)
        bucket = (mixed >> shift).astype(np.int64)
        first = np.ones(bucket.shape, dtype=bool)
        first[:, 1:] = bucket[:, 1:] != bucket[:, :-1]
        g, i = np.nonzero(first)
        b = bucket[g, i]
        least[g, b] = np.minimum(least[g, b], mixed[g, i])
        full[g, b] = True
    rest = (least << (np.uint64(64) - shift)) >> np.uint64(11)
    mantissa, exponent = np.frexp(rest.astype(np.float64))  # 53 bits, so exact
    zeros = np.where(rest > 0, 53 - exponent, 53)
    following = np.where(rest > 0, (mantissa * 2 - 1) * (1 << MANTISSA), 0).astype(np.int64)
    return np.where(full, 1 + (zeros << MANTISSA) + following, 0).astype(np.uint16).ravel()


def band_keys(registers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every band that is not empty, for the sketches of many sets."""
    bands = registers.reshape(len(registers), GROUPS, BUCKETS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BUCKETS + 1, dtype=np.uint64) * K1, (len(registers), BUCKETS)).copy()
    for g in range(GROUPS):
        key = (key ^ bands[:, g]) * K2
        key ^= key >> np.uint64(29)
    row, band = np.nonzero(bands.any(axis=1))
    return row, key[row, band].view(np.int64)


@lru_cache(maxsize=1)
def _collisions() -> np.ndarray:
    """How often the registers of unrelated sets agree, by the powers of two of both sizes."""
    low = np.concatenate([2.0 ** -(z + 1) * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA)) for z in range(40)])
    width = np.repeat(2.0 ** -(np.arange(40) + 1), 1 << MANTISSA) / (1 << MANTISSA)
    load = (2.0 ** np.arange(32) / BUCKETS)[:, None]  # shingles per bucket
    cells = (np.exp(-load * low) * -np.expm1(-load * width)).astype(np.float32)
    return cells @ cells.T


def estimate(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected estimates of the similarities, and the number of registers they rest on."""
    known = (a > 0) | (b > 0)
    n = np.maximum(1, known.sum(axis=1))
    agree = ((a == b) & known).sum(axis=1) / n
    power = [np.minimum(31, np.log2(np.maximum(1, s)).astype(np.int64)) for s in (sizes_a, sizes_b)]
    chance = _collisions()[power[0], power[1]]
    return (agree - chance) / (1 - chance), n


def likely(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, percent: int) -> np.ndarray:
    """Which estimates do not lie too far below the limit."""
    similar, registers = estimate(a, b, sizes_a, sizes_b)
    return similar >= percent / 100 - DEVIATIONS * np.sqrt(percent / 100 * (1 - percent / 100) / registers)


def _signed(df: DataFrame, id_col: str, text: str, width: int, prints: bool = False) -> DataFrame:
    """(doc_id, node, n, registers, fp) of every row; n is the size of the shingle set, fp the SimHash where asked for, else null."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("registers", pa.binary()), ("fp", pa.int64())])

    def run(whole: pa.RecordBatch):
        for at in range(0, whole.num_rows, ROWS_EACH):
            batch, signed = whole.slice(at, ROWS_EACH), []
            for t in batch.column(1):
                grams = shingles(t.as_py(), width)
                fp = int(np.uint64(simhash.fingerprint(t.as_py(), width)).view(np.int64)) if prints else None
                signed.append((node_of(grams), len(grams), sketch(grams).tobytes(), fp))
            yield batch_of(schema, batch.column(0), *map(list, zip(*signed)))

    return in_batches(df.select(F.col(id_col).cast("long"), text_bytes(text)), run,
                      "doc_id long, node long, n long, registers binary, fp long")


def _ball_pairs(rows: DataFrame, radius: int) -> DataFrame:
    """(a, b) nodes to compare first: those of one SimHash with their least, and the least of SimHashes that a ball links."""
    said = rows.where("n > 0").select("node", "fp").distinct()
    leads = stored(said.groupBy("fp").agg(F.min("node").alias("lead")), "fingerprint-nodes")
    balls = sum(v.shape[1] for v in simhash.variants(np.zeros(1, dtype=np.uint64), radius))
    linked = simhash.links(leads, radius, partitions_for(rows, leads.count() * balls, simhash.ROWS_EACH))
    for end in "ab":
        linked = linked.join(leads.select(F.col("fp").alias(end), F.col("lead").alias(f"node_{end}")), end)
    met = said.join(leads, "fp").select("node", "lead").union(linked.select("node_a", "node_b")).where("node != lead")
    return stored(met.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct(), "ball-pairs")


def _spread(nodes: DataFrame) -> DataFrame:
    """(key, node, n) for every band of every node."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n", pa.int64())])

    def run(whole: pa.RecordBatch):
        for at in range(0, whole.num_rows, 4096):
            batch = whole.slice(at, 4096)
            row, key = band_keys(_registers(batch.column(2)))
            row = pa.array(row)
            yield batch_of(schema, key, batch.column(0).take(row), batch.column(1).take(row))

    return in_batches(nodes.select("node", "n", "registers"), run, "key long, node long, n long")


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), GROUPS * BUCKETS)


def _sets(df: DataFrame, text: str, width: int, wanted: DataFrame) -> DataFrame:
    """(node, grams) of the wanted nodes; a task tells a node once, however many copies it reads."""
    schema = pa.schema([("node", pa.int64()), ("grams", pa.binary())])

    def run(batches):
        told: set[int] = set()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_EACH):
                new = {}
                for t in whole.column(0).slice(at, ROWS_EACH):
                    grams = shingles(t.as_py(), width)
                    if (node := node_of(grams)) not in told:
                        told.add(node)
                        new[node] = grams.tobytes()
                yield batch_of(schema, list(new), list(new.values()))

    found = df.select(text_bytes(text)).mapInArrow(run, "node long, grams binary")
    return found.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("grams").alias("grams"))


def _shared_sizes(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, node, n, e): e is how many of a node's shingles others of its bucket can share.

    In crowded buckets a shingle that no member of any crowded bucket has besides cannot be shared. Members of other buckets
    were not asked, so there every shingle counts.
    """
    crowd = stored(members.groupBy("key").count().where(F.col("count") > CROWD).select("key", F.lit(True).alias("crowded")), "crowded-keys")
    nodes = members.join(crowd, "key", "left_semi").select("node").distinct()
    schema = pa.schema([("gram", pa.int64()), ("node", pa.int64())])

    def run(batch: pa.RecordBatch):
        for node, grams in zip(batch.column(0), batch.column(1)):
            grams = np.frombuffer(grams.as_py(), dtype=np.int64)
            yield batch_of(schema, grams, np.full(len(grams), node.as_py()))

    said = in_batches(sets.join(nodes, "node", "left_semi").select("node", "grams"), run, "gram long, node long")
    single = said.groupBy("gram").agg(F.count("*").alias("texts"), F.min("node").alias("node")).where("texts = 1")
    own = single.groupBy("node").agg(F.count("*").alias("own"))
    return members.join(crowd, "key", "left").join(own, "node", "left").select(
        "key", "node", "n", (F.col("n") - F.when(F.col("crowded"), F.coalesce("own", F.lit(0))).otherwise(0)).alias("e"))


def _fits(n: Column, e: Column, m: Column, f: Column, percent: int) -> Column:
    """Whether sets of n and m shingles, of which e and f can be shared, can reach the similarity."""
    most = F.least(e, f)
    return 100 * most >= percent * (n + m - most)


def _beside(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """The pairs with the values of both ends."""
    for end in "ab":
        pairs = pairs.join(values.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in values.columns[1:]]), end)
    return pairs


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches do not rule the similarity out."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(whole: pa.RecordBatch):
        for at in range(0, whole.num_rows, 4096):
            batch = whole.slice(at, 4096)
            keep = pa.array(likely(_registers(batch.column(2)), _registers(batch.column(3)),
                                   batch.column(4).to_numpy(), batch.column(5).to_numpy(), percent))
            yield batch_of(schema, batch.column(0).filter(keep), batch.column(1).filter(keep))

    both = _beside(pairs, nodes.select("node", "registers", "n"))
    return in_batches(both.select("a", "b", "registers_a", "registers_b", "n_a", "n_b"), run, "a long, b long")


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets are as similar as asked."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batch: pa.RecordBatch):
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = np.frombuffer(x.as_py(), dtype=np.uint64), np.frombuffer(y.as_py(), dtype=np.uint64)
            both = np.concatenate([x, y])
            both.sort()
            shared = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(100 * shared >= percent * (len(both) - shared))
        keep = pa.array(keep, pa.bool_())
        yield batch_of(schema, batch.column(0).filter(keep), batch.column(1).filter(keep))

    return in_batches(_beside(pairs, sets).select("a", "b", "grams_a", "grams_b"), run, "a long, b long")


class Block:
    """Members of one block of a bucket, with all their shingles in one sorted line."""

    def __init__(self, members: pa.Table):
        self.node, self.n, self.e, self.root = (members.column(c).to_numpy() for c in ("node", "n", "e", "root"))
        self.registers = _registers(members.column("registers"))
        sets = [np.frombuffer(g, dtype=np.uint64) for g in members.column("grams").to_pylist()]
        grams, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(g) for g in sets])
        order = np.argsort(grams, kind="stable")
        self.grams, self.owner = grams[order], owner[order]

    def shared(self, grams: np.ndarray) -> np.ndarray:
        """Number of shingles every member shares with a set."""
        low, high = np.searchsorted(self.grams, grams), np.searchsorted(self.grams, grams, "right")
        many = high - low
        at = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.bincount(self.owner[at], minlength=len(self.node))

    def answers(self, asker: dict, band: int, percent: int) -> np.ndarray:
        """Members of other components that are similar to the asker, one of each component."""
        registers = np.frombuffer(asker["registers"], dtype=np.uint16)
        most = np.minimum(self.e, asker["e"])
        open_ = (self.root != asker["root"]) & (100 * most >= percent * (self.n + asker["n"] - most))
        at = np.flatnonzero(open_)
        same = (self.registers[at] == registers).reshape(len(at), GROUPS, BUCKETS).all(axis=1)
        same &= registers.reshape(GROUPS, BUCKETS).any(axis=0)
        at = at[same.argmax(axis=1) == band]
        if len(at):
            at = at[likely(self.registers[at], np.broadcast_to(registers, (len(at), len(registers))), self.n[at],
                           np.full(len(at), asker["n"]), percent)]
        if len(at):
            shared = self.shared(np.frombuffer(asker["grams"], dtype=np.uint64))[at]
            at = at[100 * shared >= percent * (self.n[at] + asker["n"] - shared)]
        return self.node[at[np.unique(self.root[at], return_index=True)[1]]]


def _answers(open_: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) links between askers and the members of their buckets, found block by block."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def meet(members: pa.Table, askers: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if members.num_rows and askers.num_rows:
            block = Block(members)
            for asker in askers.to_pylist():
                _, keys = band_keys(np.frombuffer(asker["registers"], dtype=np.uint16)[None, :])
                bands = np.flatnonzero(np.frombuffer(asker["registers"], dtype=np.uint16).reshape(GROUPS, BUCKETS).any(axis=0))
                band = int(bands[np.flatnonzero(keys == asker["key"])[0]])
                found += [(asker["node"], int(y)) for y in block.answers(asker, band, percent)]
        return pa.Table.from_batches([batch_of(schema, [min(p) for p in found], [max(p) for p in found])], schema)

    full = open_.join(nodes.select("node", "registers"), "node").join(sets, "node")
    columns = ["key", "block", "node", "n", "e", "root", "registers", "grams"]
    members = full.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).select(*columns)
    askers = full.where("asks").withColumn("block", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))).select(
        *[F.col(c).alias(c) for c in columns])
    return members.groupBy("key", "block").cogroup(askers.groupBy("key", "block")).applyInArrow(meet, "a long, b long")


def _merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) after more links; only roots meet again."""
    if roots is None:
        return stored(components(links, "a", "b"), "roots")
    for end in "ab":
        known = roots.select(F.col("node").alias(end), F.col("root").alias("known"))
        links = links.join(known, end, "left").withColumn(end, F.coalesce("known", end)).drop("known")
    joined = stored(components(links, "a", "b"), "joined-roots")
    over = joined.select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = roots.join(over, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return stored(moved.union(joined.join(roots, "node", "left_anti").select("node", "root")), "roots")


def _roots(df: DataFrame, nodes: DataFrame, text: str, width: int, percent: int, first: DataFrame | None = None) -> DataFrame | None:
    """(node, root) of the components that all similar pairs sharing a band, or among the first pairs, span; None without such pairs."""
    spread = _spread(nodes)
    shared = spread.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    members = stored(spread.join(shared, "key"), "bucket-members")
    wanted = members.select("node")
    if first is not None:
        wanted = wanted.union(first.select("a")).union(first.select("b"))
    if wanted.isEmpty():
        return None
    sets = stored(_sets(df, text, width, wanted.distinct()), "shingle-sets")
    members = stored(_shared_sizes(members, sets).where(100 * F.col("e") >= percent * F.col("n")), "bucket-members")
    lead = members.groupBy("key").agg(F.min(F.struct((1 - F.col("e") / F.col("n")).alias("own"), "node", "n", "e")).alias("lead"))
    asked = members.join(lead, "key").where(F.col("node") != F.col("lead.node")).where(
        _fits(F.col("n"), F.col("e"), F.col("lead.n"), F.col("lead.e"), percent)).select(
        F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b"))
    asked = stored((asked if first is None else asked.union(first)).distinct(), "asked-pairs")
    links, roots, turn = stored(_similar(_likely(asked, nodes, percent), sets, percent), "similar-pairs"), None, 0
    while True:
        if not links.isEmpty():
            roots = _merged(roots, links)
        turn += 1
        named = members.withColumn("root", F.col("node")) if roots is None else members.join(
            roots, "node", "left").withColumn("root", F.coalesce("root", "node")).select("key", "node", "n", "e", "root")
        parts = named.groupBy("key", "root").agg(F.count("*").alias("size"))
        mixed = parts.groupBy("key").agg(F.max(F.struct("size", "root")).alias("main"), F.sum("size").alias("all")).where(
            "all > main.size").select("key", F.col("main.root").alias("main"), (F.col("all") - F.col("main.size")).alias("outside"),
                                      F.ceil(F.col("all") / BLOCK).alias("blocks"))
        chosen = F.pmod(F.xxhash64("node", F.lit(turn)), F.ceil(F.col("outside") / ASKERS)) == 0
        open_ = stored(named.join(mixed, "key").select("key", "node", "n", "e", "root", "blocks", (
            (F.col("root") != F.col("main")) & chosen).alias("asks")), "open-buckets")
        if open_.isEmpty():
            return roots
        links = stored(_answers(open_, nodes, sets, percent), "similar-pairs")
        members = open_.where("not asks").select("key", "node", "n", "e")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 4, percent: int = 80,
                    simhash_radius: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; component_id is the smallest id that links lead to.

    With a radius, texts whose SimHashes lie in one ball are compared first; the sketches then find what the balls leave.
    """
    rows = stored(_signed(df, id_col, text, width, simhash_radius is not None), "sketches")
    first = None if simhash_radius is None else _ball_pairs(rows, simhash_radius)
    nodes = stored(rows.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("rows"), F.first("n").alias("n"), F.first("registers").alias("registers")),
        "shingle-nodes")
    roots = _roots(df, nodes, text, width, percent, first)
    named = nodes.select("node", "first", "rows")
    if roots is not None:
        rooted = stored(named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
        least = rooted.groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("members"))
        named = rooted.join(least, "root").where("rows > 1 or members > 1").select("node", F.col("least").alias("first"))
    copies = named.select("node", F.col("first").alias("component_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "node").join(copies, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
