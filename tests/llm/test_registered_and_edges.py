"""The registered queries on the smallest scale folder, and cases that single operators must stand."""

import base64
import gzip
import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from compare import TABLES, rows_of
from offerscope.llm import knn, quality, sharding, urlfilter, warc
from offerscope.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return db


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


@given
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    df = QUERIES[name](spark, SF)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


@given
def test_byte_bpe_query(spark, texts):
    ranks = {base64.b64decode(a): int(v) for a, v in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for d, t in texts.items():
        ids = plain.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = QUERIES["op4_byte_bpe"](spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


@given
def test_simhash_query(spark, texts):
    prints = {}
    for d, t in texts.items():
        words = [w.lower() for w in words_of(t)]
        some = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in some]
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {d: d for d in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                root[max(top(a), top(b))] = min(top(a), top(b))
    got = QUERIES["op5_simhash_neardup"](spark, SF).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted((d, f"{f:016x}", top(d)) for d, f in prints.items())


@given
def test_quality_query(spark, texts, con):
    """Base counts by recount; score and verdict from the model's own tables, one n-gram at a time."""
    base = {}
    for d, t in texts.items():
        words, lines = words_of(t), (t or "").split("\n")
        kept = [line for line in lines if words_of(line)]
        repeated = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        inside = {i + k for i in range(len(words) - 4) if repeated[tuple(words[i:i + 5])] > 1 for k in range(5)}
        base[d] = (len(words), sum(len(w.decode()) for w in words), len(re.findall(r"[#*$%&|<>]", t or "")),
                   len(kept) - len(set(kept)), len(inside))
    got = {r["doc_id"]: r for r in QUERIES["op6_quality_rules"](spark, SF).collect()}
    assert set(got) == set(base)
    for d, (n, chars, symbols, lines, repeats) in base.items():
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, repeats)
        assert r["base_failed"] == (n < 10 or 100 * repeats > 20 * n)
        assert not (r["base_failed"] and r["kept"])
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    passes = docs.select("doc_id", quality.passes(model)(F.col("text").cast("binary")).alias("ok")).collect()
    assert {r["doc_id"]: r["ok"] for r in passes} == {d: r["kept"] for d, r in got.items()}
    marked = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    share = {q: np.mean([r["kept"] for d, r in got.items() if marked.get(d) == q]) for q in (0, 1)}
    assert share[1] > 0.9 and share[0] < 0.2


@given
def test_packing_query(spark, texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    plain.encode_special_tokens = True
    pieces, line = defaultdict(list), []
    for r in QUERIES["op7_concat_and_cut"](spark, SF).collect():
        pieces[r["doc_id"]].append(r)
        line.append((r["sequence_id"], r["offset"], r["length"]))
    at = 0
    for sequence, offset, length in sorted(line):
        assert sequence * 2048 + offset == at and offset + length <= 2048
        at += length
    assert set(pieces) == set(texts)
    for d, t in texts.items():
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        rows = sorted(pieces[d], key=lambda r: r["start"])
        assert sum(r["length"] for r in rows) == len(ids) == rows[0]["doc_tokens"]
        assert all(zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in rows)


@given
def test_substring_query(spark, texts):
    seen = Counter(tuple(w[i:i + 35]) for t in texts.values() for w in [words_of(t)] for i in range(len(w) - 34))
    want = []
    for d, t in texts.items():
        words = words_of(t)
        gone = {i + k for i in range(len(words) - 34) if seen[tuple(words[i:i + 35])] > 1 for k in range(35)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        want.append((d, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    got = QUERIES["op8_substring_dedup"](spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def plain_jump(key, shards):
    """The published recurrence, one key at a time."""
    key, shard, following = key & (1 << 64) - 1, -1, 0
    while following < shards:
        shard = following
        key = (key * 2862933555777941757 + 1) & (1 << 64) - 1
        following = int((shard + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return shard


@given
def test_jump_query(spark, texts):
    rows = QUERIES["op10_jump_hash"](spark, SF).collect()
    slots = defaultdict(list)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert (r["shard"], r["grown_shard"]) == (plain_jump(r["doc_id"], 24), plain_jump(r["doc_id"], 25))
        assert r["grown_shard"] in (r["shard"], 24)
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == len(texts) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_carry_clashing_names_and_are_written(spark, tmp_path):
    df = spark.createDataFrame([(i, "x" * (i % 5), i, i) for i in range(50)], "id long, text string, __part long, __nth long")
    got = sharding.with_slots(df.withColumn("shard", sharding.assign("id", 4)))
    assert got.columns == ["id", "text", "__part", "__nth", "shard", "slot"]
    assert all(r["__part"] == r["__nth"] == r["id"] for r in got.collect())
    sharding.write_shards(df, f"{tmp_path}/shards", "id", 4)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted((r["id"], r["shard"]) for r in back.collect()) == [(i, plain_jump(i, 4)) for i in range(50)]


@given
def test_pipeline_runs_whole(spark, texts):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {r["doc_id"] for r in rows} <= set(texts)
    assert sum(r["length"] for r in rows) == max(r["sequence_id"] * 2048 + r["offset"] + r["length"] for r in rows)


def test_pipeline_stages_on_an_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, kept int")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, none, str(tmp_path))
        assert out.columns == none.columns and out.count() == 0


def _record(kind, body, more="", newline=b"\r\n"):
    lines = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{kind}>\r\n{more}Content-Length: {len(body)}\r\n\r\n".encode()
    return lines + body + newline * 2


PLAIN = [_record("warcinfo", b"software: some crawler\r\n", "Content-Type: application/warc-fields\r\n"),
         _record("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "Content-Type: application/http; msgtype=request\r\n"),
         _record("response", b"HTTP/1.1 200 OK\r\nServer: s\r\n\r\n" + b"<p>x</p>" * 4000,
                 "WARC-Target-URI: http://a/\r\nContent-Type: application/http; msgtype=response\r\n"),
         _record("metadata", b"", "content-type: text/plain\r\n"), _record("resource", "é\r\n\r\nü".encode(), "Content-Type: text/plain\r\n")]


@pytest.mark.parametrize("form", ["members", "one member", "plain", "two files"])
def test_archives_of_others(spark, tmp_path, form):
    if form in ("plain", "two files"):
        (tmp_path / "b.warc").write_bytes(b"".join(PLAIN))
    if form != "plain":
        packed = gzip.compress(b"".join(PLAIN)) if form == "one member" else b"".join(map(gzip.compress, PLAIN))
        (tmp_path / "a.warc.gz").write_bytes(packed)
    warc.register(spark)
    back = spark.read.format("warc").option("path", f"file://{tmp_path}").load()
    times = 2 if form == "two files" else 1
    got = {r["record_type"]: r for r in back.collect()}
    assert back.count() == 5 * times and len(got) == 5
    assert bytes(got["response"]["payload"]) == b"<p>x</p>" * 4000 and got["response"]["payload_bytes"] == 32_000
    assert got["response"]["target_uri"] == "http://a/" and got["response"]["payload_digest"] is None
    assert (got["metadata"]["payload_bytes"], got["request"]["payload_bytes"]) == (0, 0)
    assert bytes(got["resource"]["payload"]).decode() == "é\r\n\r\nü"
    narrow = back.where("record_type in ('resource', 'warcinfo')").select("record_id", "payload_bytes")
    assert sorted(map(tuple, narrow.collect())) == sorted([("<urn:resource>", 8), ("<urn:warcinfo>", 24)] * times)


def test_no_archive_is_an_error_and_an_empty_one_is_not(spark, tmp_path):
    warc.register(spark)
    with pytest.raises(Exception, match="no archive"):
        spark.read.format("warc").option("path", f"file://{tmp_path}/nothing").load().count()
    none = spark.createDataFrame([], "page_id long, url string, html string, sha1 string, first long")
    warc.records(none).write.format("warc").mode("append").option("path", f"file://{tmp_path}/empty").save()
    assert spark.read.format("warc").option("path", f"file://{tmp_path}/empty").load().count() == 0


def test_warc_copies_clashing_names_and_long_payloads(spark, tmp_path):
    rows = [(i, f"u{i}", "gleich" if i % 2 else None, i, i) for i in range(40)] + [(77, "u", "ü" * 3_000_000, 0, 0)]
    warc.register(spark)
    path = f"file://{tmp_path}/archive"
    table = spark.createDataFrame(rows, "page_id long, url string, html string, sha1 long, first long")
    warc.records(table).write.format("warc").mode("append").option("path", path).save()
    got = spark.read.format("warc").option("path", path).option("verify", "true").load().collect()
    assert Counter((r["record_type"], r["refers_to"]) for r in got) == {
        ("response", None): 3, ("revisit", "<urn:page:0>"): 19, ("revisit", "<urn:page:1>"): 19}
    assert max(r["payload_bytes"] for r in got) == 6_000_000


def brute_top(rows, k=20):
    good = {}
    for i, v in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.setdefault(i, set()).add(tuple(int(np.floor(64 * np.float64(np.float32(x)))) for x in v))
    out = []
    for q in good:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(mine, v)), i) for mine in good[q] for i, vs in good.items() if i != q for v in vs)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_of_large_components_repeats_and_ids_with_many_vectors(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK", 4)
    monkeypatch.setattr(knn, "SHARE", 16)
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(200, 3)) + np.eye(3)[np.arange(200) % 3] * 9)]
    rows += [(300 + i, rows[7][1]) for i in range(60)] + [(40, [float(x) for x in v]) for v in rng.normal(size=(30, 3)) * 5]
    rows += [(400, [5e6, 0.0, 0.0]), (401, [-3e7, 1.0, 2.0]), (402, [1e5, 1e5, -1e5]), (403, [float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cell", F.lit(1)).withColumn("query", F.lit(2))
    got = knn.top_k(df, F.col("vec_id") % 20 == 0).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == brute_top(rows)


def test_top_k_beyond_a_long_is_an_error(spark):
    df = spark.createDataFrame([(0, [1e12, 0.0]), (1, [1e12, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="does not fit a long"):
        knn.top_k(df, F.col("vec_id") == 0).collect()


def test_bounds_hold_back_what_cannot_matter(spark):
    """Far groups stay apart: most vectors are sent to no other group."""
    rng = np.random.default_rng(2)
    middle = rng.normal(size=(12, 16)) * 10
    vectors = [(i, [float(x) for x in middle[i % 12] + rng.normal(size=16) * 0.2]) for i in range(3000)]
    df = spark.createDataFrame(vectors, "id long, embedding array<float>").select(
        "id", (F.col("id") % 10 == 0).alias("query"), knn.quantised(F.col("embedding"), 64.0).alias("values"))
    rows = [(r["id"], r["query"], knn._packed(r["values"])) for r in df.collect()]
    rows = spark.createDataFrame(rows, "id long, query boolean, vector binary")
    pivots = np.array([[int(64 * x) for x in m] for m in middle], dtype=float)
    queries, data = knn._celled(rows, knn.Grouping(pivots), 16, 20)
    local = knn._best_of(knn._solved(queries, data, 16, 20, 12), 20)
    grouping = knn._with_bounds(knn.Grouping(pivots), queries, data, local, 16, 20)
    assert knn._sent(data, grouping, 16).count() < 0.2 * 3000 * 11


def test_urls_of_empty_repeated_and_very_long_rows(spark):
    rules = {"org/": "allow", "com/de/": "block"}
    rows = [(1, "http://a.org/" + "x" * 300_000), (1, "http://a.org/" + "x" * 300_000), (2, "http://b.com/de/1"), (3, None), (4, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("listed", F.lit("?")).withColumn("h1", F.lit(1))
    got = urlfilter.judge(pages, rules, spark.createDataFrame([("b.com/de/1",)], "key string"))
    assert Counter((r["page_id"], r["verdict"]) for r in got.collect()) == {(1, "allow"): 2, (2, "block"): 1, (3, "allow"): 1, (4, "allow"): 1}
    assert urlfilter.judge(pages.limit(0), rules, spark.createDataFrame([], "key string")).count() == 0
