"""Dictionary extraction of skills from free text, inside one projection."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from offerscope import schemas
from offerscope.functions.text import WORD, fold
from offerscope.operators.skew import explode_computed
from offerscope.vocab.skills import DEFAULT_SKILLS, Skill

# A skill is neither preceded nor followed by a word character, "+" or "#" ("C" is not in "C++").
_NOT_BEFORE, _NOT_AFTER = f"(?<![{WORD}+#])", f"(?![{WORD}+#])"


def _plain(pattern: str, case_sensitive: bool) -> str:
    folded = "".join(c for c in unicodedata.normalize("NFKD", pattern.replace("’", "'"))
                     if not unicodedata.combining(c))
    return folded if case_sensitive else folded.lower()


def required_literal(pattern: str) -> str:
    """Longest text every match of ``pattern`` contains, or '' when none is evident.

    A plain substring test on it is far cheaper than the regex and never rejects a match.
    """
    runs, run, depth, i = [], "", 0, 0
    while i < len(pattern):
        c = pattern[i]
        following = pattern[i + 1] if i + 1 < len(pattern) else ""
        if c in "\\{^$.*" or (c == "|" and depth == 0):
            return ""
        if c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
        elif depth == 0 and c not in "?+" and following not in ("?", "*", "{"):
            run += c
            i += 1
            continue
        runs.append(run)
        run = ""
        i += 1
    return max([*runs, run], key=len)


def skill_hit(skill: Skill, lowered: Column, cased: Column) -> Column:
    text = cased if skill.case_sensitive else lowered
    patterns = [_plain(p, skill.case_sensitive) for p in skill.patterns]
    body = "|".join(f"(?:{p})" for p in patterns)
    found = text.rlike(f"{_NOT_BEFORE}(?:{body}){_NOT_AFTER}")
    literals = [required_literal(p) for p in patterns]
    if not all(literals):
        return found
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in dict.fromkeys(literals)]) & found


def with_skills(df: DataFrame, texts: Sequence[str], skills: Sequence[Skill] = DEFAULT_SKILLS,
                into: str = "skills") -> DataFrame:
    """Adds an array of the skills cited in the joined ``texts``, in dictionary order, without duplicates."""
    joined = F.concat_ws("\n", *[F.coalesce(F.col(t), F.lit("")) for t in texts])
    df = df.withColumn("_cased", fold(joined))
    df = df.withColumn("_lowered", F.lower("_cased"))
    names = [F.when(skill_hit(s, F.col("_lowered"), F.col("_cased")), F.lit(s.name)) for s in skills]
    return df.withColumn(into, F.array_compact(F.array(*names))).drop("_cased", "_lowered")


def catalogue(spark: SparkSession, skills: Sequence[Skill] = DEFAULT_SKILLS) -> DataFrame:
    """The skills dimension: (skill, category, skill_type); as many rows as the dictionary has entries."""
    return spark.createDataFrame([(s.name, s.category, s.kind) for s in skills], schemas.SKILLS)


def links(df: DataFrame, key: str, skills: str = "skills") -> DataFrame:
    """Bridge rows (key, skill) of a table that carries the skills array."""
    return explode_computed(df, [key], F.col(skills), "skill")


def labelled_links(df: DataFrame, key: str, dictionary: Sequence[Skill] = DEFAULT_SKILLS) -> DataFrame:
    """Bridge rows with category and type; the catalogue has a known small size."""
    return links(df, key).join(F.broadcast(catalogue(df.sparkSession, dictionary)), "skill") \
        .select(key, "skill", "category", "skill_type")
