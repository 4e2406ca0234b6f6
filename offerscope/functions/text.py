"""Text columns: accent folding, normalisation, title case, ordered rules."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

def _decomposed(code: int) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))


def _fold_tables() -> tuple[str, str, dict[int, str]]:
    """What every code point decomposes to, by the Unicode database: one character, none, or several.

    Hangul syllables are left to ``_spelled_out``, which takes them apart by arithmetic.
    """
    single, dropped, expanded = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.decomposition(char) or unicodedata.combining(char):
            target = _decomposed(code)
            if len(target) > 1:
                expanded[code] = target
            elif not target:
                dropped.append(char)
            elif target != char:
                single.append((char, target))
    source = "".join(s for s, _ in single) + "".join(dropped)
    return source, "".join(t for _, t in single), expanded


_FOLD_FROM, _FOLD_TO, _EXPANDED = _fold_tables()
_EXPANDED_CHARS = "".join(map(chr, _EXPANDED))
# One text of all expansions, each behind a mark: small enough for plans that repeat a column's expression.
_MARK = "\x01"
_TABLE = _MARK + "".join(chr(code) + target + _MARK for code, target in _EXPANDED.items())
_LONGEST = max(map(len, _EXPANDED.values())) + 1
# Leading consonants, vowels and trailing consonants that Hangul syllables consist of.
_SYLLABLES, _JAMO = (0xAC00, 0xD7A3), [("".join(map(chr, range(first, first + n)))) for first, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27))]
# Blanks: those below U+0080 the collapsing regex looks for, and all of them for trimming.
_ASCII_BLANKS = "[ \\t\\n\\x0B\\f\\r\\x1c-\\x1f]+"
_ALL_BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_FOLDED_BLANKS = "".join(c for c in _ALL_BLANKS if c > "\x7f" and _decomposed(ord(c)) != " ")
# Word characters, spelled out: the engine's own word class and boundary differ between JVM versions.
WORD = r"\p{L}\p{N}_"


def rx(pattern: str) -> str:
    """A pattern whose classes and boundaries are Unicode-aware whatever the JVM."""
    return "(?U)" + pattern if "\\b" in pattern or "\\w" in pattern else pattern


def strip_accents(text: Column, extra: tuple[str, str] = ("", "")) -> Column:
    """Compatibility decomposition without combining marks; plain ASCII text takes a free path.

    ``extra`` adds one-to-one replacements (from, to) to the same pass.
    """
    short = F.replace(text, F.lit("…"), F.lit("..."))
    several = (F.translate(short, _EXPANDED_CHARS, "") != short) | short.rlike("[\uac00-\ud7a3]")
    whole = F.when(several, _spelled_out(short)).otherwise(short)
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(
        F.translate(whole, extra[0] + _FOLD_FROM, extra[1] + _FOLD_TO))


def _spelled_out(text: Column) -> Column:
    """Each character that stands for several replaced by them."""
    def char(c: Column) -> Column:
        code = F.ascii(c)
        index = code - _SYLLABLES[0]
        parts = [F.substring(F.lit(jamo), at.cast("int"), F.lit(1)) for jamo, at in zip(
            _JAMO, (F.floor(index / 588) + 1, F.floor(index % 588 / 28) + 1, index % 28))]
        tail = F.when(index % 28 > 0, parts[2]).otherwise("")
        at = F.position(F.concat(F.lit(_MARK), c), F.lit(_TABLE))
        found = F.substring_index(F.substring(F.lit(_TABLE), at + 2, F.lit(_LONGEST)), _MARK, 1)
        return F.when(code < 0x80, c).when(code.between(*_SYLLABLES), F.concat(*parts[:2], tail)).when(at > 0, found).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), char), "")


def fold(text: Column) -> Column:
    """Accents stripped and the curly apostrophe straightened, case kept."""
    return strip_accents(text, extra=("’", "'"))


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _ASCII_BLANKS, " "))


def norm(text: Column) -> Column:
    """Lower case, no accents, straight apostrophes, single blanks, trimmed; NULL becomes ''."""
    plain = strip_accents(F.coalesce(text, F.lit("")), extra=("’" + _FOLDED_BLANKS, "'" + " " * len(_FOLDED_BLANKS)))
    return collapse(F.lower(plain))


def strip(text: Column) -> Column:
    """Blanks of any kind removed at both ends."""
    return F.btrim(text, F.lit(_ALL_BLANKS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def title_case(text: Column) -> Column:
    """A capital after every non-letter ("aix-en-provence" -> "Aix-En-Provence"), lower case elsewhere."""
    words = F.split(F.lower(text), r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                              F.substring(w, 2, 1 << 30))), "")


def first_match(text: Column, rules: Iterable[tuple[str, str]], default: Column | None = None) -> Column:
    """Label of the first rule whose pattern is found in ``text``."""
    chain: Column | None = None
    for label, pattern in rules:
        hit = text.rlike(rx(pattern))
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    if chain is None:
        raise ValueError("no rules")
    return chain if default is None else chain.otherwise(default)


def round_half_up(value: Column, digits: int) -> Column:
    """Decimal half-up rounding of a double, kept as a double."""
    return F.round(value.cast("decimal(30,10)"), digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100·part/whole, NULL on an empty whole."""
    return round_half_up(F.try_divide(F.lit(100.0) * part, whole.cast("double")), digits)
