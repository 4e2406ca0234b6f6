"""The training-data operators against brute force on small tables: nulls, empty and long texts, ties, repeats, clashing names."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from offerscope.llm import bpe, knn, langmodel, packing, quality, sharding, simhash, substring, urlfilter, warc

BPE, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
PASSAGE = " ".join(f"w{i}" for i in range(60))
LONG = " ".join(f"x{i * i % 997}" for i in range(20_000))
ROWS = [(1, "Der  Hund,\n läuft über!!  \u00a0 d'or \n\n", 7), (2, None, 7), (3, "", 7), (4, f"eins {PASSAGE} zwei", 7), (4, f"eins {PASSAGE} zwei", 7),
        (5, f"drei vier {PASSAGE}", 7), (None, "ohne id \ttab  ende ", 7), (6, LONG, 7), (7, f"{PASSAGE} {PASSAGE}", 7),
        (8, "=====" * 50 + " aaaaaaaaaa" + "  \n x", 7), (9, "an " * 40, 7), (10, "<|endoftext|> é e\u0301 ﬁ Σς", 7)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, n_words int")


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def test_empty_tables(spark, docs):
    none, labels = docs.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert simhash.near_duplicates(none).count() == 0
    assert quality.quality(none, labels).count() == 0
    assert packing.pack(none, WORDS).count() == 0
    assert substring.remove_repeats(none).count() == 0
    assert langmodel.score(none, labels).count() == 0
    assert bpe.encode(none, BPE, public_tokenizers.PATTERN).count() == 0
    assert sharding.with_slots(none.select("doc_id", sharding.assign("doc_id", 3).alias("shard"))).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert knn.top_k(vectors, F.col("vec_id") % 2 == 0).count() == 0


def test_fingerprints_and_components(docs, spark):
    def brute(text):
        words = [w.lower() for w in words_of(text)]
        shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    got = simhash.near_duplicates(docs).collect()
    assert sorted((r["fp"] & (1 << 64) - 1) for r in got) == sorted(brute(t) for _, t, _ in ROWS)
    assert {r["component_id"] for r in got if r["fp"] == 0} == {2}
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = [b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 5), replace=False))) for b in base for _ in range(5)]
    fps = np.unique(np.r_[base, np.array(near, dtype=np.uint64)])
    pairs = {(i, j) for i in range(len(fps)) for j in range(i) if np.bitwise_count(fps[i] ^ fps[j]) <= 3}
    found = simhash.links(spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")).collect()

    def parts(edges, n):
        root = list(range(n))

        def top(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in edges:
            root[max(top(a), top(b))] = min(top(a), top(b))
        return [top(i) for i in range(n)]

    at = {int(f): i for i, f in enumerate(fps.view(np.int64))}
    mine = {(at[r["a"]], at[r["b"]]) for r in found}
    assert all((max(p), min(p)) in pairs for p in mine)
    assert parts(mine, len(fps)) == parts(pairs, len(fps))


def test_substring_removal(docs):
    windows = Counter(tuple(w[i:i + 35]) for _, t, _ in ROWS if (w := words_of(t)) for i in range(len(w) - 34))
    want = []
    for d, t, _ in ROWS:
        w = words_of(t)
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if windows[tuple(w[i:i + 35])] > 1:
                gone[i:i + 35] = [True] * 35
        want.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    got = substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("period", substring.COVERS)
def test_covers_hold_every_difference(period):
    cover = substring.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(WORDS)
    plain.encode_special_tokens = True
    want = sorted(tuple(plain.encode(t or "", add_special_tokens=False).ids) + (1,) for _, t, _ in ROWS)
    stored = packing.tokens(docs.repartition(3), WORDS, 1)
    line = [i for r in sorted(packing.sequences(stored, 64).collect()) for i in r["ids"][:r["n_tokens"]]]
    pieces = sorted(packing.pieces(stored, 64).collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    at, got, current = 0, [], []
    for r in pieces:
        assert (r["sequence_id"] * 64 + r["offset"], r["start"]) == (at, len(current))
        part = line[at:at + r["length"]]
        assert zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r["ids_crc32"]
        at, current = at + r["length"], current + part
        if len(current) == r["doc_tokens"]:
            got.append(tuple(current))
            current = []
    assert at == len(line) and sorted(got) == want


def test_ranks_of_the_word_vocabulary_rise():
    ranks, _ = packing.byte_ranks(WORDS)
    assert all(len(bpe.halves(t, ranks)) == 2 for t in ranks if len(t) > 1 and ranks[t] >= 512)


def test_bpe(docs):
    ranks = {base64.b64decode(a): int(v) for a, v in map(bytes.split, open(BPE, "rb"))}
    assert all(len(bpe.halves(t, ranks)) == 2 for t in ranks if len(t) > 1)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.decode(bpe.encode(docs, BPE, public_tokenizers.PATTERN, limit=40), BPE).collect()
    assert sorted((tuple(r["ids"]), bytes(r["decoded"])) for r in got) == sorted(
        (tuple(plain.encode_ordinary(t or "")), (t or "").encode()) for _, t, _ in ROWS)


def test_quality_counts_and_verdicts(docs, spark):
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, None), (6, 0, 0), (None, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    got = {(r["doc_id"], r["n_words"]): r for r in quality.quality(docs, labels).collect()}
    assert got[9, 40]["n_repeat_words"] == 40 and got[9, 40]["base_failed"] and not got[9, 40]["kept"]
    assert got[2, 0]["base_failed"] and got[4, 62]["kept"]
    assert got[7, 120]["n_repeat_words"] == 120
    text = b"a # b\n\n a # b\na # b\n c"
    words = text.split()
    assert quality.base_counts(text, words, quality._hashes(words))[:4] == (10, 10, 3, 1)


def test_language_model_prefers_the_target(spark):
    rows = [(i, "ba bi bo bu " * 10 if i % 2 else "ka ki ko ku " * 10, i) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    got = langmodel.score(spark.createDataFrame(rows, "doc_id long, text string, score int"), labels).collect()
    held_out = [r for r in got if r["doc_id"] >= 20]
    assert max(r["score"] for r in held_out if r["doc_id"] % 2) < min(r["score"] for r in held_out if not r["doc_id"] % 2)


@pytest.mark.parametrize("few", [0, 4096])
def test_cascade_is_exact(spark, monkeypatch, few):
    monkeypatch.setattr(urlfilter, "FEW", few)
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("HTTP://A.example/"), "id").alias("key"))
    pages = pages.union(spark.createDataFrame([(None, None)], "page_id long, key string"))
    blocked = pages.where("page_id % 7 = 0 and key is not null").select("key")
    got = urlfilter.mark_listed(pages, "key", blocked).collect()
    assert all(r["listed"] == (r["page_id"] is not None and r["page_id"] % 7 == 0) for r in got) and len(got) == 3001


def test_host_path_and_rules(spark):
    urls = ["http://A.Example.ORG/es/x?q#f", "x://b://c/d", "no host", None, "http://example.org", "ftp://m.com/fr/1", "http://h?x/y"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string")
    rules = {"org/": "allow", "example.org/es/": "block", "com/fr/": "allow"}
    got = [tuple(r)[1:5] for r in urlfilter.judge(rows, rules, rows.limit(0).select(F.col("url").alias("key"))).collect()]
    assert sorted(got, key=str) == sorted([("a.example.org", "/es/x", "example.org/es/", "block"), ("b:", "//c/d", None, "allow"), ("", "", None, "allow"),
                          ("", "", None, "allow"), ("example.org", "", None, "allow"), ("m.com", "/fr/1", "com/fr/", "allow"),
                                           ("h", "", None, "allow")], key=str)


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(3, "u\n3", "é" * 9000), (1, None, "x"), (2, "u2", "x"), (2, "u2", "x"), (4, "u4", None), (None, "n", "x")],
                                  "page_id long, url string, html string")
    warc.register(spark)
    path = f"file://{tmp_path}/archive"
    warc.records(pages).write.format("warc").mode("append").option("path", path).option("roll_bytes", "200").save()
    back = spark.read.format("warc").option("path", path).load()
    got = sorted((r["record_id"], r["record_type"], r["refers_to"], r["payload_bytes"], bytes(r["payload"] or b"")) for r in back.collect())
    assert [g[1] for g in got] == ["response", "revisit", "revisit", "response", "response", "revisit"]
    assert got[3][3:] == (18000, ("é" * 9000).encode()) and got[4][4] == b""
    responses = spark.read.format("warc").option("path", path).schema("record_id string, payload_digest string, record_type string").load()
    assert responses.where("record_type = 'response'").count() == 3
    one = responses.where("record_id = '<urn:page:1>'").first()
    assert one["payload_digest"] == base64.b32encode(hashlib.sha1(b"x").digest()).decode()


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.round(rng.normal(size=(300, 4)), 1))]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan")] * 4), (303, [1.0, 2.0]), (20, rows[20][1]), (None, [1.0] * 4)]
    good = {i: [int(np.floor(64 * np.float64(np.float32(x)))) for x in v] + [0] * (4 - len(v)) for i, v in rows[:300] + [rows[303]]}
    want = []
    for q in (i for i in good if i % 20 == 0):
        order = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(order[:20])]
    got = knn.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_shards(docs):
    keys = np.arange(-50, 5000)
    before, after = sharding.jump_hash(keys, 24), sharding.jump_hash(keys, 25)
    assert set(after[before != after]) == {24} and set(before) == set(range(24))
    got = sharding.with_slots(docs.repartition(4).select("*", sharding.assign("doc_id", 3).alias("shard"))).collect()
    for shard in range(3):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert len(got) == len(ROWS)


def test_pipeline_stages_hold_columns_and_decide(spark):
    clean = [(i, " ".join(f"s{i}x{j}" for j in range(50)), "en", "a", 1, i) for i in range(30)]
    rows = clean + [(100, clean[3][1], "en", "a", 1, 0), (101, f"{clean[4][1][:60]} {PASSAGE} t", "en", "a", 1, 0),
                    (102, f"{PASSAGE} {clean[5][1][:60]}", "en", "a", 1, 0), (103, "kurz", "en", "a", 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component_id int")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    stages = dict(corpus_pipeline.STAGES)
    model = quality.fit(docs, labels)
    docs = docs.where(quality.passes(model)(F.col("text").cast("binary")))
    assert {r["doc_id"] for r in docs.collect()} >= set(range(30)) and docs.where("doc_id = 103").count() == 0
    docs = stages["near duplicates"](spark, docs, "")
    assert docs.where("doc_id = 100").count() == 0 and docs.where("doc_id < 30").count() == 30
    cut = stages["repeated passages"](spark, docs, "")
    assert cut.columns == docs.columns and not cut.where(F.col("text").contains("w7 w8")).count()
    assert cut.where("doc_id < 3").join(docs, ["doc_id", "text"]).count() == 3
    assert stages["packing"](spark, cut, "").select("doc_id").distinct().count() == cut.count()


def test_pipeline_near_duplicates_reach_similarity_of_five_words(spark):
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(12):
        base = [f"v{i}" for i in rng.integers(0, 5000, 200)]
        texts.append(base)
        for changed in (1, 2, 4, 8, 16):
            copy = list(base)
            for at in rng.integers(0, 200, changed):
                copy[at] = f"n{rng.integers(0, 10**6)}"
            texts.append(copy)
    texts += [["gleich"] * 3 + [f"k{i}"] for i in range(3)] + [texts[0]] * 2
    sets = [set(zip(*(t[k:] for k in range(5)))) or {tuple(t)} for t in texts]
    root = list(range(len(texts)))
    for _ in root:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 5 * len(a & b) >= 4 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(None, "ohne id"), (1000, None), (1001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert got == {i for i, r in enumerate(root) if i == r} | {None, 1000}
    assert 12 < len(got) < len(texts) - 12


def test_language_model_counts_every_word_and_bigram(spark, monkeypatch):
    """Against brute force; words and bigrams that no trusted document holds count as well, whatever the buckets."""
    monkeypatch.setattr(langmodel, "BUCKET_BYTES", 200)
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"{'ab' if i < 8 else 'xyz'}{k}" for k in rng.integers(0, 12, 30))) for i in range(40)]
    rows += [(100, None), (101, ""), (None, "ab1 xyz2 nirgends"), (None, "ab1 xyz2 nirgends"), (30, rows[30][1])]
    labels = [(i, int(i < 5), 0) for i in range(12)]
    texts = [words_of(t) for _, t in rows]
    vocabulary = len({w for t in texts for w in t})

    def model(chosen):
        single, pairs, context = Counter(), Counter(), Counter()
        for t in chosen:
            single.update(t)
            pairs.update(zip([None, *t], t))
            context.update([None, *t][:len(t)])
        n = sum(single.values())
        p = {w: (single[w] + 1) / (n + vocabulary) for t in texts for w in t}
        return lambda t: sum(-np.log((pairs[v, w] + 20 * p[w]) / (context[v] + 20)) for v, w in zip([None, *t], t)) / max(1, len(t))

    near, far = model([t for (i, _), t in zip(rows, texts) if i is not None and i < 5]), model(texts)
    got = langmodel.score(spark.createDataFrame(rows, "doc_id long, text string"),
                          spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    key = lambda r: (-1 if r[0] is None else r[0], r[1], r[2])
    want = sorted(((i, len(t), near(t), far(t)) for (i, _), t in zip(rows, texts)), key=key)
    assert [r[:2] for r in want] == [tuple(r)[:2] for r in sorted(got, key=key)]
    assert np.allclose([r[2:] for r in want], [tuple(r)[2:4] for r in sorted(got, key=key)])


def test_quality_threshold_divides_both_classes(spark):
    """Two odd trusted documents do not set it; checked on the rows that neither counts nor threshold have seen."""
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(f"{'g' if i % 3 else 'b'}{k}" if rng.random() < 0.7 else f"c{k}" for k in rng.integers(0, 300, 80))) for i in range(600)]
    rows += [(i, " ".join(f"b{k}" for k in rng.integers(0, 300, 80))) for i in range(600, 620)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0 or i >= 600), 0) for i in range(620)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sample = {r["__id"]: r for r in quality.labelled_sample(labels).collect()}
    unseen = [r for r in quality.quality(docs, labels).collect()
              if r["doc_id"] < 600 and not sample[r["doc_id"]]["fitted"] and not sample[r["doc_id"]]["tuned"]]
    kept = {low: np.mean([r["kept"] for r in unseen if sample[r["doc_id"]]["low"] == low]) for low in (False, True)}
    assert kept[False] > 0.95 and kept[True] < 0.05
    assert quality.threshold(np.array([]), np.array([1.0])) == float("-inf")
    assert quality.threshold(np.array([0.1, 0.2, 0.3, -9.0]), np.array([])) > -1


def test_every_labelled_row_counts(spark):
    """No bound on labelled rows: where all documents are trusted, both models are the same."""
    ids = range(24_000)
    labels = spark.createDataFrame([(i, 1, 0) for i in ids], "doc_id long, quality int, toxic int")
    assert quality.labelled_sample(labels).count() == len(ids)
    docs = spark.createDataFrame([(i, f"wort{i} wort{i % 7}") for i in ids], "doc_id long, text string")
    assert all(r["score"] == 0 and r["target_loss"] > 0 for r in langmodel.score(docs, labels).collect())


def test_threshold_of_counted_scores():
    rng = np.random.default_rng(2)
    for _ in range(50):
        trusted, low = (rng.integers(-5, 8, rng.integers(1, 9)) / 4 for _ in range(2))
        for other in (low, low[:0]):
            counted = [np.unique(v, return_counts=True) for v in (trusted, other)]
            assert quality.threshold(*(v for v, _ in counted), *(n for _, n in counted)) == quality.threshold(trusted, other)
