"""Skill extraction with a dictionary of any size: an index of phrases, met by a join.

``skills.with_skills`` tries every entry on every text, which suits the few entries of a configuration. Here a dictionary is a table, read
from a file. Its patterns are expanded into the texts they match; texts are cut into words once, and their runs of words are
joined with those phrases, so the work does not hang on the number of entries. A pattern's look-ahead, or a sign at a phrase's end, is
checked on the texts that hold the phrase.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from offerscope.functions.text import WORD, fold
from offerscope.operators.skew import spread
from offerscope.operators.skills import _NOT_AFTER, _NOT_BEFORE, _plain
from offerscope.session import stored
from offerscope.vocab.skills import DEFAULT_SKILLS, Skill

DICTIONARY = "name string, category string, type string, patterns array<string>, case_sensitive boolean"
PHRASES = "skill string, category string, skill_type string, cased boolean, core string, words int, check string"
#: Texts one pattern may stand for.
MOST_PHRASES = 1000
_INSIDE = f"[{WORD}+#]"


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Entries from JSON lines: name, category, type, patterns and, where capitals count, case_sensitive."""
    return spark.read.schema(DICTIONARY).option("mode", "FAILFAST").json(path)


def as_table(spark: SparkSession, skills: Sequence[Skill] = DEFAULT_SKILLS) -> DataFrame:
    return spark.createDataFrame([(s.name, s.category, s.kind, list(s.patterns), s.case_sensitive) for s in skills], DICTIONARY)


def expand(pattern: str) -> tuple[list[str], bool]:
    """The texts a pattern stands for, and whether they still have to be checked (it looks ahead or behind).

    Patterns are words with alternatives, groups, sets and optional parts; repetition without end is an error.
    """
    texts, at, checked = _alternatives(pattern, 0)
    if at < len(pattern):
        raise ValueError(f"unbalanced pattern {pattern!r}")
    return sorted(texts), checked


def _alternatives(pattern: str, at: int) -> tuple[set[str], int, bool]:
    found, current, checked = set(), {""}, False
    while at < len(pattern) and pattern[at] != ")":
        if pattern[at] == "|":
            found, current, at = found | current, {""}, at + 1
            continue
        some, at, look = _one(pattern, at)
        checked |= look
        if pattern[at:at + 1] == "?":
            some, at = some | {""}, at + 1
        elif pattern[at:at + 1] in ("*", "+", "{") and pattern[at:at + 1]:
            raise ValueError(f"pattern {pattern!r} repeats without end")
        current = {a + b for a in current for b in some}
        if len(current) > MOST_PHRASES:
            raise ValueError(f"pattern {pattern!r} stands for too many texts")
    return found | current, at, checked


def _one(pattern: str, at: int) -> tuple[set[str], int, bool]:
    """One character, set or group, and where it ends."""
    c = pattern[at]
    if c == "(":
        ahead = re.compile(r"\(\?(<?[!=])").match(pattern, at)
        start = ahead.end() if ahead else at + (3 if pattern.startswith("(?:", at) else 1)
        texts, end, checked = _alternatives(pattern, start)
        if end >= len(pattern):
            raise ValueError(f"unbalanced pattern {pattern!r}")
        return ({""} if ahead else texts), end + 1, bool(ahead) or checked
    if c == "[":
        end = pattern.index("]", at + 2)
        inside = pattern[at + 1:end]
        if inside[0] == "^" or re.search(r"\\[dws]|.-.", inside):
            raise ValueError(f"pattern {pattern!r} has an open set")
        return set(inside.replace("\\", "")), end + 1, False
    if c == "\\":
        if pattern[at + 1] in "bB":
            return {""}, at + 2, True
        if pattern[at + 1].isalnum():
            raise ValueError(f"pattern {pattern!r} has an open set")
        return {pattern[at + 1]}, at + 2, False
    if c in ".^$":
        raise ValueError(f"pattern {pattern!r} has an open set")
    return {c}, at + 1, False


def phrases(dictionary: DataFrame) -> DataFrame:
    """One row per phrase: its core between the first and last word, the number of words, and what must be checked besides."""
    def is_inside(c: str) -> bool:
        return c.isalnum() or c in "_+#"

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for entry in batch.itertuples(index=False):
                cased = bool(entry.case_sensitive) if entry.case_sensitive is not None else False
                for pattern in map(lambda p: _plain(p, cased), entry.patterns):
                    texts, checked = expand(pattern)
                    for text in filter(None, texts):
                        core = text
                        while core and not is_inside(core[0]):
                            core = core[1:]
                        while core and not is_inside(core[-1]):
                            core = core[:-1]
                        if not core:
                            raise ValueError(f"{entry.name!r}: {text!r} holds no word")
                        words = 1 + sum(is_inside(b) and not is_inside(a) for a, b in zip(core, core[1:]))
                        check = f"{_NOT_BEFORE}(?:{pattern}){_NOT_AFTER}" if checked or core != text else None
                        out.append((entry.name, entry.category, entry.type, cased, core, words, check))
            yield pd.DataFrame(out, columns=["skill", "category", "skill_type", "cased", "core", "words", "check"])

    return dictionary.mapInPandas(rows, PHRASES).distinct()


def _runs(begins: Column, words: int) -> Column:
    """Every run of so many words with what stands between them."""
    return F.transform(begins, lambda i: F.array_join(F.slice("pieces", i, F.lit(2 * words - 1)), ""))


def extract(df: DataFrame, key: str, texts: Sequence[str], dictionary: DataFrame) -> DataFrame:
    """Bridge rows (key, skill, category, skill_type) of the entries cited in the joined texts, without duplicates."""
    index = stored(phrases(dictionary), "phrases")
    lengths = {(r["cased"], r["words"]) for r in index.select("cased", "words").distinct().collect()}  # a handful of numbers
    joined = fold(F.concat_ws("\n", *[F.coalesce(F.col(t), F.lit("")) for t in texts]))
    cased = spread(df.select(key, *texts), [key]).select(F.col(key).alias("key"), joined.alias("text"))
    found = None
    for capitals in {c for c, _ in lengths}:
        rows = cased if capitals else cased.select("key", F.lower("text").alias("text"))
        pieces = rows.select("key", F.regexp_extract_all("text", F.lit(f"{_INSIDE}+|[^{WORD}+#]+"), F.lit(0)).alias("pieces"))
        begin = F.when(F.get("pieces", F.lit(0)).rlike(f"^{_INSIDE}"), 1).otherwise(2)
        begins = F.when(F.size("pieces") >= begin, F.sequence(begin, F.size("pieces"), F.lit(2))).otherwise(F.array().cast("array<int>"))
        runs = [_runs(begins, n) for c, n in sorted(lengths) if c == capitals]
        grams = pieces.select("key", F.explode_outer(F.array_distinct(F.concat(*runs))).alias("core"))
        hits = grams.join(index.where(F.col("cased") == capitals), "core").select("key", "skill", "category", "skill_type", "cased", "check")
        found = hits if found is None else found.union(hits)
    if found is None:
        return df.select(key, *[F.lit(None).cast("string").alias(c) for c in ("skill", "category", "skill_type")]).where("false")
    sure = found.where("check is null").drop("cased", "check")
    doubtful = found.where("check is not null").distinct().join(cased, "key")
    text = F.when(F.col("cased"), F.col("text")).otherwise(F.lower("text"))
    checked = doubtful.where(F.regexp_like(text, F.col("check"))).select(*sure.columns)
    return sure.union(checked).distinct().withColumnRenamed("key", key)
