"""Quality rules: base counts per document, and a log-likelihood ratio between trusted target and raw corpus.

Both multinomials are over the same hashed buckets of words and word pairs. The raw counts cover every document; the target counts
cover the trusted documents of half of all labelled rows. A document's score is the mean log ratio of its
n-grams, so length does not matter. The threshold is where the kept shares of trusted and of low-quality documents differ most,
among the documents of a quarter of the labelled rows, which the target counts have not seen; without low-quality ones it lies `MADS`
median absolute deviations below the trusted median. The last quarter takes no part in either and is left to check the verdicts on.

Bucket counts are summed per task before they are shuffled and are one small vector in the end. Scores for the threshold are counted per
step of 1 / `STEPS`, so what reaches the driver is bounded by the range of scores, however many rows are labelled; scoring is narrow. The
planner chooses how labelled ids meet the texts.

Defined cases: a null or empty text has no words and fails the base rules; without trusted labelled documents every score is zero
and no document falls below the threshold; an id with several labels is trusted only if all agree; rows with a null id are judged
like others but never labelled; repeated rows each get a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerscope.llm.common import arrow_schema, batch_of, in_batches, stored, text_bytes

BUCKETS = 1 << 16
#: Steps of one unit of score in which the scores for the threshold are counted.
STEPS = 8192
#: Without low-quality labels: how many median absolute deviations below the trusted median the threshold lies, and how far at least.
MADS, MARGIN = 6.0, 0.02
#: Trusted documents are added to raw counts with this weight in the estimate of the target, per bucket.
PRIOR = 8.0

SYMBOLS, REPEAT = b"#*$%&|<>", 5
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
COLUMNS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
           " base_failed boolean, score double, kept boolean")


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))


def _spread(values: np.ndarray) -> np.ndarray:
    x = (values + K1) * K2
    return x ^ (x >> np.uint64(31))


def ngrams(hashes: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of every word and of every pair of neighbours."""
    pairs = _spread(hashes[:-1]) * K1 + hashes[1:]
    return ((_spread(np.concatenate([hashes, pairs])) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def repeated_words(words: list[bytes], hashes: np.ndarray, size: int = REPEAT) -> int:
    """Words inside windows that occur at least twice. Hashes propose, the words themselves decide."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    value = hashes[:n]
    for k in range(1, size):
        value = _spread(value * K1 + hashes[k:n + k])
    _, inverse, counts = np.unique(value, return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[inverse] > 1)
    if not len(at):
        return 0
    windows = [tuple(words[i:i + size]) for i in at]
    often = Counter(windows)
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    for i, w in zip(at, windows):
        if often[w] > 1:
            steps[i] += 1
            steps[i + size] -= 1
    return int((np.cumsum(steps[:-1]) > 0).sum())


def base_counts(text: bytes, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), len(b"".join(words).decode("utf-8", "replace")), len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words, hashes))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 10 or 100 * n_repeat_words > 20 * n_words


@dataclass(frozen=True)
class Model:
    ratios: np.ndarray
    threshold: float

    def score(self, hashes: np.ndarray) -> float:
        return float(self.ratios[ngrams(hashes, len(self.ratios))].mean()) if len(hashes) else 0.0


def labelled_sample(labels: DataFrame) -> DataFrame:
    """(__id, trusted, low, fitted, tuned) of every labelled id: half for the counts, a quarter for the threshold."""
    one = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.min(F.expr("coalesce(quality = 1 and coalesce(toxic, 0) = 0, false)")).alias("trusted"),
        F.min(F.expr("coalesce(quality = 0, false)")).alias("low"))
    mixed = F.xxhash64(F.col("doc_id").cast("long"))
    return one.select(F.col("doc_id").cast("long").alias("__id"), "trusted", "low", (F.pmod(mixed, F.lit(2)) == 0).alias("fitted"),
                      (F.pmod(mixed, F.lit(4)) == 1).alias("tuned"))


def _median(values: np.ndarray, counts: np.ndarray) -> float:
    order = np.argsort(values)
    ends, n = np.cumsum(counts[order]), counts.sum()
    return float(values[order][np.searchsorted(ends, [(n - 1) // 2, n // 2], "right")].mean())


def threshold(trusted: np.ndarray, low: np.ndarray, n_trusted: np.ndarray | None = None, n_low: np.ndarray | None = None) -> float:
    """The middle of the gap between scores that best divides both classes, each class weighing the same; the lower of equals.

    The counts tell how often each score occurs; without them, once.
    """
    n_trusted, n_low = (np.ones(len(v), dtype=np.int64) if n is None else n for v, n in ((trusted, n_trusted), (low, n_low)))
    if not len(trusted):
        return float("-inf")
    if not len(low):
        middle = _median(trusted, n_trusted)
        return float(middle - max(MARGIN, MADS * _median(np.abs(trusted - middle), n_trusted)))
    values, place = np.unique(np.concatenate([trusted, low]), return_inverse=True)
    cuts = np.r_[values[0] - MARGIN, (values[1:] + values[:-1]) / 2]

    def below(at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Share of a class below each cut."""
        each = np.bincount(at, n, len(values))
        return np.r_[0.0, np.cumsum(each)[:-1]] / n.sum()

    return float(cuts[np.argmax(below(place[len(trusted):], n_low) - below(place[:len(trusted)], n_trusted))])


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log of target over raw probability per bucket. The raw distribution is the target's prior, so rare buckets tend to 0."""
    if not target.sum():
        return np.zeros(len(raw))
    p = (raw + 1.0) / (raw.sum() + len(raw))
    prior = PRIOR * len(raw)
    return np.log((target + prior * p) / (target.sum() + prior) / p)


def _counted(texts: DataFrame, buckets: int) -> np.ndarray:
    """Counts of all n-grams of a column of texts, by bucket."""
    ddl = "bucket long, n long"
    schema = arrow_schema(ddl)

    def count(batches):
        n = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                np.add.at(n, ngrams(_hashes((t or b"").split()), buckets), 1)
        at = np.flatnonzero(n)
        yield batch_of(schema, at, n[at])

    out = np.zeros(buckets)
    for r in texts.mapInArrow(count, ddl).groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket at most
        out[r["bucket"]] = r["n"]
    return out


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> Model:
    known = stored(labelled_sample(labels).where("trusted or low"), "labelled")
    rows = df.select(F.col(id_col).cast("long").alias("__id"), text_bytes(text).alias("__text"))
    good = rows.join(known.where("trusted and fitted").select("__id"), "__id", "left_semi")
    raw, target = (_counted(d.select("__text"), buckets) for d in (rows, good))
    model = Model(log_ratios(target, raw), float("-inf"))
    ddl = "__id long, step long"
    schema = arrow_schema(ddl)

    def held_out(batch: pa.RecordBatch):
        steps = [round(model.score(_hashes(t.split())) * STEPS) for t in batch.column(1).to_pylist()]
        yield batch_of(schema, batch.column(0), steps)

    # Every text is scored and only the scores move, as texts are large.
    scores = in_batches(rows.where("__id is not null and octet_length(__text) > 0"), held_out, ddl).join(known.where("tuned"), "__id")
    steps = scores.groupBy("step", "trusted").agg(F.count("*").alias("n")).collect()  # bounded by the range of scores
    trusted, low = ([r for r in steps if r["trusted"] == kind] for kind in (True, False))
    return Model(model.ratios, threshold(*(np.array([r["step"] for r in c]) / STEPS for c in (trusted, low)),
                                         *(np.array([r["n"] for r in c], dtype=np.int64) for c in (trusted, low))))


def judge(df: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Base counts, score and verdict of every row."""
    schema = arrow_schema(COLUMNS)

    def run(batch: pa.RecordBatch):
        out = []
        for t in batch.column(1).to_pylist():
            words = (t or b"").split()
            hashes = _hashes(words)
            counts = base_counts(t or b"", words, hashes)
            failed, score = base_failed(counts[0], counts[4]), model.score(hashes)
            out.append((*counts, failed, score, not failed and score >= model.threshold))
        columns = list(zip(*out)) if out else [()] * 8
        yield batch_of(schema, batch.column(0), *columns)

    return in_batches(df.select(F.col(id_col).cast("long"), text_bytes(text)), run, COLUMNS)


def passes(model: Model):
    """A boolean function of a text given as bytes: neither the base rules nor the threshold reject it."""

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            words = (t or b"").split()
            hashes = _hashes(words)
            out.append(not base_failed(len(words), repeated_words(words, hashes)) and model.score(hashes) >= model.threshold)
        return pd.Series(out, dtype=bool)

    return kept


def quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    return judge(df, fit(df, labels, id_col, text), id_col, text)
