"""URL filters: host and path, rules where the longest wins, and a block list held as a cascade of Bloom filters.

The cascade knows the corpus's complete set of keys. Level 0 encodes the listed keys, level 1 the unlisted keys that pass level 0,
level 2 the listed keys that pass level 1, and so on until no key is left over. For every key of the corpus the first level that
rejects it then tells exactly whether it is listed, without a join. A level is built by tasks that set bits of their own keys; the
bits are or-ed by word before a bounded filter reaches the driver. Keys are split into as many segments as keep the filters
of one segment below `MAX_BITS`; each segment has its own cascade and its own pass.

Defined cases: a null url, or one without ://, has an empty host and path (a key like any other); repeated rows each get a row; a
null id is carried; an empty table or an empty list gives no listed key; other columns are ignored.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerscope.llm.common import arrow_schema, batch_of, stored

#: Bits of the filters of one segment: 32 MiB are broadcast at most.
MAX_BITS = 1 << 28
#: So few keys are encoded on the driver.
FEW = 4096
#: Keys that 128 bits of hash cannot tell apart would never be separated; with so many levels that is the reason.
MAX_LEVELS = 200
GOLDEN = 0x9E3779B97F4A7C15


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or end, A-Z lower-cased; path: from there up to ? or # or end."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule (host and path prefix) that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text in sorted(rules, key=lambda r: (len(r), r)):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(rules[text])).otherwise(verdict)
    return rule, verdict


def key_hashes(key: str) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")]


def _bits(h1: np.ndarray, h2: np.ndarray, level: int, hashes: int, size: int):
    """Bit numbers of every key at one level, one array per hash."""
    salted = h1 + np.uint64(GOLDEN * (level + 1) & (1 << 64) - 1)
    salted = (salted ^ (salted >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    salted ^= salted >> np.uint64(29)
    step = (h2 ^ (salted << np.uint64(1))) | np.uint64(1)
    for i in range(hashes):
        yield ((salted + np.uint64(i) * step) >> np.uint64(3)) % np.uint64(size)


@dataclass
class Level:
    hashes: int
    size: int
    words: np.ndarray

    def passes(self, h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
        ok = np.ones(len(h1), dtype=bool)
        for bit in _bits(h1, h2, level, self.hashes, self.size):
            ok &= (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
        return ok


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Exact for every key the cascade was built over."""
        rejected = np.full(len(h1), len(self.levels))
        alive = np.arange(len(h1))
        for number, level in enumerate(self.levels):
            ok = level.passes(h1[alive], h2[alive], number)
            rejected[alive[~ok]] = number
            alive = alive[ok]
        return rejected % 2 == 1


def _shape(inside: int, outside: int, level: int) -> tuple[int, int]:
    """Hash functions and bits: a rare false positive at level 0, one in two afterwards, as that keeps all levels small."""
    rate = min(0.5, math.sqrt(0.5) * max(1, inside) / max(1, outside)) if level == 0 else 0.5
    return max(1, round(-math.log2(rate))), max(64, math.ceil(inside * 1.45 * -math.log2(rate) / 64) * 64)


def _filled(keys: DataFrame, level: int, hashes: int, size: int) -> np.ndarray:
    """The or of what all tasks set, by 64-bit word."""
    schema = arrow_schema("word long, bits long")

    def run(batches):
        words = np.zeros(size // 64, dtype=np.uint64)
        for batch in batches:
            h1, h2 = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            _set(words, h1, h2, level, hashes, size)
        at = np.flatnonzero(words)
        yield batch_of(schema, at, pa.array(words[at].view(np.int64)))

    table = keys.select("h1", "h2").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(size // 64, dtype=np.uint64)
    words[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return words


def _set(words: np.ndarray, h1: np.ndarray, h2: np.ndarray, level: int, hashes: int, size: int) -> None:
    for bit in _bits(h1, h2, level, hashes, size):
        np.bitwise_or.at(words, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))


def _hash_udf(test: Callable[[np.ndarray, np.ndarray], np.ndarray]):
    @F.pandas_udf("boolean")
    def run(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(test(h1.to_numpy().view(np.uint64), h2.to_numpy().view(np.uint64)))

    return run


def build(keys: DataFrame) -> Cascade:
    """A cascade over (h1, h2, listed), one row per distinct key."""
    cascade, number = Cascade(), 0
    keys = stored(keys, "keys")
    while True:
        count = {r["listed"]: r["count"] for r in keys.groupBy("listed").count().collect()}
        inside, outside = count.get(number % 2 == 0, 0), count.get(number % 2 == 1, 0)
        if not inside:
            return cascade
        if inside + outside <= FEW:
            rows = keys.toArrow()
            return _few(cascade, number, *(rows[c].to_numpy().view(np.uint64) for c in ("h1", "h2")), rows["listed"].to_numpy())
        hashes, size = _shape(inside, outside, number)
        here, there = keys.where(F.col("listed") == (number % 2 == 0)), keys.where(F.col("listed") != (number % 2 == 0))
        level = Level(hashes, size, _filled(here, number, hashes, size))
        cascade.levels.append(level)
        keys = stored(here.union(there.where(_hash_udf(partial(level.passes, level=number))("h1", "h2"))), "keys")
        number += 1


def _few(cascade: Cascade, number: int, h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> Cascade:
    while True:
        here = listed == (number % 2 == 0)
        if not here.any():
            return cascade
        if number > MAX_LEVELS:
            raise ValueError("keys that differ have the same hashes")
        hashes, size = _shape(int(here.sum()), int((~here).sum()), number)
        words = np.zeros(size // 64, dtype=np.uint64)
        _set(words, h1[here], h2[here], number, hashes, size)
        level = Level(hashes, size, words)
        cascade.levels.append(level)
        stay = here | level.passes(h1, h2, number)
        h1, h2, listed, number = h1[stay], h2[stay], listed[stay], number + 1


def mark_listed(df: DataFrame, key: str, blocked: DataFrame, name: str = "listed") -> DataFrame:
    """Add whether a row's key is one of the keys in `blocked` (a table with a column of the same name); exact, no join."""
    universe = df.select(*key_hashes(key), F.lit(False).alias("listed")).union(
        blocked.select(*key_hashes(key), F.lit(True).alias("listed")))
    keys = universe.groupBy("h1", "h2").agg(F.max("listed").alias("listed"))
    keys = stored(keys, "universe")
    n = {r["listed"]: r["count"] for r in keys.groupBy("listed").count().collect()}
    _, size = _shape(n.get(True, 0), n.get(False, 0), 0)
    segments = max(1, math.ceil(3 * size / MAX_BITS))
    out = None
    for number in range(segments):
        inside = F.pmod("h2", F.lit(segments)) == number
        cascade = build(keys.where(inside))
        h1, h2 = key_hashes(key)
        rows = df if segments == 1 else df.where(F.pmod(h2, F.lit(segments)) == number)
        rows = rows.withColumn(name, _hash_udf(cascade.listed)(h1, h2))
        out = rows if out is None else out.union(rows)
    return out


def judge(df: DataFrame, rules: dict[str, str], blocked: DataFrame, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, listed) of every row. `blocked` holds host and path in one column `key`."""
    host, path = host_and_path(F.col(url))
    rows = df.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = mark_listed(rows.withColumn("key", F.concat("host", "path")), "key", blocked)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(
        verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "listed")
