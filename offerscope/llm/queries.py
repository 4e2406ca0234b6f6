"""The numbered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerscope.llm import alignment, bpe, hyperminhash, interaction, knn, langmodel, packing, quality, sharding, simhash, substring, urlfilter, warc
from offerscope.llm.common import table
from offerscope.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

SHARDS = 24


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode(coded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op5_simhash_neardup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op6_quality_rules(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_concat_and_cut(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_substring_dedup(spark, sf_dir):
    found = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_jump_hash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        sharding.assign("doc_id", SHARDS).alias("shard"), sharding.assign("doc_id", SHARDS + 1).alias("grown_shard"))
    return sharding.with_slots(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


# The rules of the contract, and words that mark a host as adult or gambling.
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
BLOCKED_HOST = r"(^|[.-])(adult|casino|porn|xxx)([.-]|$)"


@query
def op1_bloom_cascade(spark, sf_dir):
    """The block list is the set of urls (host and path) on hosts with a blocked word, as a list compiled from a crawl would be."""
    pages = table(spark, sf_dir, "pages")
    host, path = urlfilter.host_and_path(F.col("url"))
    blocked = pages.select(host.alias("host"), path.alias("path")).where(F.col("host").rlike(BLOCKED_HOST)).select(
        F.concat("host", "path").alias("key"))
    return urlfilter.judge(pages, RULES, blocked)


SQL["op1_bloom_cascade"] = f"""
WITH rest AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule,
    regexp_matches(host, '{BLOCKED_HOST}') AS listed FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed FROM ruled"""


@query
def op2_warc_source(spark, sf_dir):
    warc.register(spark)
    path = shared_dir(spark, "warc")
    warc.records(table(spark, sf_dir, "pages")).write.format("warc").mode("append").option("path", path).save()
    back = spark.read.format("warc").option("path", path).option("verify", "true").schema(
        "record_id string, record_type string, refers_to string, payload_digest string, payload_bytes long").load()
    return back.select(warc.id_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       warc.id_of("refers_to").alias("refers_to"))


SQL["op2_warc_source"] = """
WITH hashed AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT h, min(page_id) AS f FROM hashed GROUP BY h)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((CAST('0x' || substr(h, (5 * i) // 4 + 1, 2) AS INT)) >> (3 - (5 * i) % 4)) & 31), 1)), '') AS payload_digest,
    CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> f THEN f END AS refers_to
FROM hashed JOIN firsts USING (h)"""


@query
def op3_voronoi_knn(spark, sf_dir):
    return knn.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SQL["op3_voronoi_knn"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20"""


@query
def op9_cross_entropy_difference(spark, sf_dir):
    return langmodel.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_hyperminhash_neardup(spark, sf_dir):
    found = hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


@query
def op11_interaction_audit(spark, sf_dir):
    return interaction.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL["op11_interaction_audit"] = r"""
WITH split AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
failed AS (SELECT doc_id, part, concat(
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END,
    CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS mask FROM split),
flags AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id),
cells AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
    FROM failed LEFT JOIN flags USING (doc_id) GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, CAST(step AS INT) AS step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before
    FROM orders, range(1, 6) AS r(step)),
walked AS (SELECT part, mask, n, good, toxic, filter_order, step, letter, contains(mask, letter) AS fails,
    length(translate(before, mask, '')) < length(before) AS gone FROM cells, steps),
placed AS (SELECT part, filter_order, step, letter,
    CAST(sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN mask = letter THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
    FROM walked GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM placed"""


@query
def op12_tokenizer_alignment(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
                           public_tokenizers.path("piece_bpe_32k.model"))
