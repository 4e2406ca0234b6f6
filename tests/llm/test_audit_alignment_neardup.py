"""Filter audit, tokenizer alignment and HyperMinHash against brute force: nulls, empty and very long texts, ties, repeats, clashing names."""

import hashlib
import itertools
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from offerscope.llm import alignment, hyperminhash, interaction

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
rng = np.random.default_rng(11)
WORDS = [f"wort{i}" for i in range(400)]
LONG = " ".join(rng.choice(WORDS, 30_000))
BASE = rng.choice(WORDS, 120).tolist()
ODD = ["é ﬁ ½", "▁ a", "a▁b", "<s> </s> <|endoftext|>", "\x00\x01 tab\tline\r\n x", "   many   blanks   ", "漢字かな 🙂🙂🏽",
       "a" * 3000, " ", "\n", "=-" * 200, "x�y"]


def edited(words, n):
    words = list(words)
    for at in rng.choice(len(words), n, replace=False):
        words[at] = f"neu{rng.integers(1 << 30)}"
    return " ".join(words)


ROWS = [(1, None, "a", 1), (2, "", "a", 1), (3, LONG, None, 1), (4, LONG, "", 1), (None, "nur ein Satz", "b", 1), (5, "nur ein Satz", "b", 1),
        (None, "ganz allein", "b", 1), (6, "ABC def # $", "b", 1), (6, "ABC def # $", "b", 1), (7, "abc DEF # $", "c", 1),
        *[(20 + i, t, "odd", 1) for i, t in enumerate(ODD)],
        *[(100 + i, edited(BASE, i % 6), "near", 1) for i in range(60)],
        *[(200 + i, "gleich " + " ".join(BASE[:8]) + f" {i % 3}", "short", 1) for i in range(12)]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string, kept int").repartition(3)


def split(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def test_empty_tables(spark, docs):
    none, labels = docs.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.audit(none, labels).count() == 0
    assert alignment.align(none, BYTES, public_tokenizers.PATTERN, PIECES).count() == 0
    assert hyperminhash.near_duplicates(none).count() == 0
    assert hyperminhash.near_duplicates(docs.where("doc_id in (1, 2)")).count() == 2


def test_audit(spark, docs):
    labelled = [(3, 1, 0), (4, 0, 1), (4, 1, 0), (None, 1, 1), (6, 1, None), (110, 1, 0), (20, None, 1), (999, 1, 1)]
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    good, toxic = ({i for i, *flags in labelled if i is not None and flags[k] == 1} for k in (0, 1))
    ids = defaultdict(set)
    for i, t, *_ in ROWS:
        ids[t or ""].add(i)

    def fails(i, text):
        text = text or ""
        words = split(text)
        smaller = [k for k in ids[text] if k is not None and (i is None or k < i)]
        return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "D": bool(re.search(r"[#$%&*|]", text)),
                "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "E": bool(smaller)}

    want = defaultdict(Counter)
    failed = [(i, part or "", fails(i, t)) for i, t, part, _ in ROWS]
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {p for _, p, _ in failed}:
            for step in range(1, 6):
                want[part, order, step]["removed"] += 0
        for i, part, f in failed:
            gone = False
            for step, letter in enumerate(order, 1):
                c = want[part, order, step]
                c["unique_fails"] += f[letter] and sum(f.values()) == 1
                c["redundant"] += f[letter] and gone
                c["kept"] += not gone and not f[letter]
                if f[letter] and not gone:
                    c["removed"] += 1
                    c["good_lost"] += i in good
                    c["toxic_lost"] += i in toxic
                    gone = True
    shapley = Counter()
    for (part, order, step), c in want.items():
        shapley[part, order[step - 1]] += c["removed"]
    got = interaction.audit(docs, labels).collect()
    assert len(got) == len(want) == 600 * 7
    for r in got:
        c = want[r["part"], r["filter_order"], r["step"]]
        assert [r[k] for k in interaction.COUNTS] == [c[k] for k in interaction.COUNTS]
        assert r["shapley"] == shapley[r["part"], r["filter_order"][r["step"] - 1]]


def test_alignment(docs):
    plain, pieces = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    plain.encode_special_tokens = True
    letters = alignment._byte_letters()
    rows, holders = [], Counter()
    for i, text, *_ in ROWS:
        line = b" " + (text or "").encode()
        a = plain.encode(line.decode(), add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in plain.id_to_token(x)) for x in a]
        shown = [pieces.id_to_piece(x) for x in b]
        bytes_b = [bytes([int(s[3:5], 16)]) if re.fullmatch("<0x..>", s) else s.replace("▁", " ").encode() for s in shown]
        if b"".join(bytes_a) != line or b"".join(bytes_b) != line:
            a, b, bytes_a, bytes_b = [], [], [], []
        owner_b = [k for k, x in enumerate(bytes_b) for _ in x]
        links, at = [], 0
        for x, piece in zip(a, bytes_a):
            links += [(x, b[k]) for k in sorted(set(owner_b[at:at + len(piece)]))]
            at += len(piece)
        cuts = sorted(set(np.cumsum([len(x) for x in bytes_a])) & set(np.cumsum([len(x) for x in bytes_b])))
        groups = defaultdict(lambda: ([], []))
        for side, (tokens, parts) in enumerate(((a, bytes_a), (b, bytes_b))):
            for x, end in zip(tokens, np.cumsum([len(p) for p in parts])):
                groups[bisect_left(cuts, end)][side].append(str(x))
        groups = ["|".join(map(",".join, groups[g])) for g in sorted(groups)]
        rows.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        holders.update(set(links))
    highest = {}
    for (a, _), n in holders.items():
        highest[a] = max(n, highest.get(a, 0))
    want = [(i, n_a, n_b, g, len(links), sum(holders[p] == highest[p[0]] for p in links), sum(holders[p] for p in links), h)
            for i, n_a, n_b, g, links, h in rows]
    got = alignment.align(docs, BYTES, public_tokenizers.PATTERN, PIECES).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(w[1] == 0 for w in want if w[0] and w[0] >= 20) and max(w[4] for w in want) > 30_000


def test_alignment_of_documents_in_several_buckets_and_lanes(docs, monkeypatch):
    whole = alignment.align(docs, BYTES, public_tokenizers.PATTERN, PIECES).collect()
    monkeypatch.setattr(alignment, "BUCKET_PAIRS", 50)
    assert sorted(map(str, alignment.align(docs, BYTES, public_tokenizers.PATTERN, PIECES).collect())) == sorted(map(str, whole))
    ends_a, ends_b = (np.cumsum(rng.integers(1, 4, 3000)) for _ in "ab")
    ends_b = np.r_[ends_b[ends_b < ends_a[-1]], ends_a[-1]]
    first = np.zeros(1, dtype=np.int64)
    many, one = (alignment.lanes(ends_a, ends_b, first, first, size) for size in (16, 1 << 40))
    assert len(many[0]) > 50 and len(one[0]) == 1
    assert sorted(zip(*alignment.linked(ends_a, ends_b, *many))) == sorted(zip(*alignment.linked(ends_a, ends_b, *one)))


def brute_components(rows, width, percent):
    sets = []
    for i, text in rows:
        words = [w.lower() for w in split(text)]
        some = [tuple(words[k:k + width]) for k in range(len(words) - width + 1)] or ([tuple(words)] if words else [])
        sets.append((i, frozenset(some)))
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            s, t = sets[x][1], sets[y][1]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                root[max(top(x), top(y))] = min(top(x), top(y))
    least = {}
    for x, (i, s) in enumerate(sets):
        if i is not None:
            least[top(x)] = min(i, least.get(top(x), i))
    return [(i, len(s), least.get(top(x), i) if s else i) for x, (i, s) in enumerate(sets)]


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(docs, width):
    want = brute_components([(i, t) for i, t, *_ in ROWS], width, 80)
    got = hyperminhash.near_duplicates(docs, width=width).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_turns_decide_crowded_buckets(spark, monkeypatch):
    """Texts that share most of a passage: many members of one bucket, few of them linked."""
    monkeypatch.setattr(hyperminhash, "CROWD", 4)
    monkeypatch.setattr(hyperminhash, "ASKERS", 20)
    monkeypatch.setattr(hyperminhash, "BLOCK", 7)
    rows = [(i, edited(BASE, int(n))) for i, n in enumerate(rng.integers(0, 9, 80))]
    rows += [(100 + i, rows[i][1] + " schluss") for i in range(0, 80, 3)]
    got = hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=5).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows, 5, 80))


def test_sketches_and_estimates(monkeypatch):
    """Registers do not hang on slices; estimates of sets of known similarity lie around it, after correction for accidental agreement."""
    grams = np.unique(rng.integers(0, 1 << 63, 30_000, dtype=np.uint64))
    whole = hyperminhash.sketch(grams)
    monkeypatch.setattr(hyperminhash, "SLICE", 100)
    assert (whole > 0).all() and (hyperminhash.sketch(grams) == whole).all()
    for size in (40, 400, 4000):
        for share in (0.0, 0.5, 0.8, 1.0):
            got = []
            for _ in range(40):
                both = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
                cut = int(len(both) * share)
                rest = np.unique(rng.integers(0, 1 << 63, len(both) - cut, dtype=np.uint64))
                x, y = (np.sort(np.r_[both[:cut], r]) for r in (both[cut:], rest))
                sketches = [hyperminhash.sketch(s)[None, :] for s in (x, y)]
                got.append(hyperminhash.estimate(*sketches, np.array([len(x)]), np.array([len(y)]))[0][0])
            exact = share / (2 - share)
            assert abs(np.mean(got) - exact) < 0.03


def test_recall_on_the_given_documents(spark):
    """Every pair of a hundredth of the documents with all others is found: recall 1.0 at five words and 0.8."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = {r["doc_id"]: r["component_id"] for r in hyperminhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), width=5).collect()}
    sets = {i: set(hyperminhash.shingles((t or "").encode(), 5).tolist()) for i, t in rows}
    links = [(i, k) for i in sets if i % 100 == 0 for k in sets
             if i != k and sets[i] and 100 * len(sets[i] & sets[k]) >= 80 * len(sets[i] | sets[k])]
    assert all(got[i] == got[k] for i, k in links)


def test_members_of_crowded_buckets_keep_their_links_in_others(spark, monkeypatch):
    """A text that shares a crowded bucket with far ones still meets its near copy, whose shingles no crowded bucket tells."""
    monkeypatch.setattr(hyperminhash, "CROWD", 2)
    own = np.random.default_rng(4)
    rows = []
    for g in range(30):
        base, tail = ([f"{kind}{g}x{k}" for k in range(n)] for kind, n in (("p", 72), ("q", 48)))
        near = list(base)
        for at in (8, 24):
            near[at] = f"neu{g}x{at}"
        texts = [base + tail, near + tail, *(base + [f"r{own.integers(1 << 40)}" for _ in range(48)] for _ in range(12))]
        rows += [(len(rows) + i, " ".join(t)) for i, t in enumerate(texts)]
    got = hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows, 4, 80))


def test_simhash_balls_propose_and_full_sets_decide(spark):
    """The balls alone: pairs they propose are linked if similar, and only then."""
    rows = [(1, LONG), (2, LONG + " ende"), (3, " ".join(reversed(BASE))), (4, "a b c d e f"), (5, "a b c d e f a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = hyperminhash._signed(docs, "doc_id", "text", 5, True)
    node = {r["node"]: r["doc_id"] for r in signed.collect()}
    near = {tuple(sorted((node[r["a"]], node[r["b"]]))) for r in hyperminhash._ball_pairs(signed, 3).collect()}
    assert (1, 2) in near
    got = {r["doc_id"]: r["component_id"] for r in hyperminhash.near_duplicates(docs, width=5, simhash_radius=3).collect()}
    assert got == {i: c for i, _, c in brute_components(rows, 5, 80)}
