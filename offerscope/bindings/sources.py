"""Payloads, postings, pages and landing files derived from the given tables, read back as raw records."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from offerscope import schemas
from offerscope.bindings.registry import query, table
from offerscope.session import shared_dir
from offerscope.sources import jsonld, landing, payloads


@query("aggregator_payload", """
WITH o AS (SELECT *, o_orderkey % 9 AS v FROM orders)
SELECT 'adzuna' AS source, CAST(o_orderkey AS VARCHAR) AS source_id, 'Data ' || o_orderpriority AS title,
       'Ville ' || v || ', Isère, Région ' || o_orderstatus AS location_raw, 'permanent full_time' AS contract_raw,
       o_totalprice AS salary_min_raw, o_totalprice + 1000 AS salary_max_raw, 'year' AS salary_unit_raw,
       'Client ' || o_custkey AS company, 'IT Jobs' AS sector_raw, 'data analyst' AS search_keyword FROM o
UNION ALL SELECT 'adzuna', o_orderkey || 'p', '', NULL, CASE WHEN v < 4 THEN 'contract' END, NULL, NULL, NULL, NULL, NULL,
       'data analyst' FROM o""")
def aggregator_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order becomes a response with a stated and a predicted salary, as JSON text."""
    key = F.col("o_orderkey").cast("string")
    city = F.concat(F.lit("Ville "), F.col("o_orderkey") % 9)
    none = F.lit(None).cast("string")

    def item(predicted: bool):
        named = [
            (F.concat(key, F.lit("p")) if predicted else key, "id"),
            (none if predicted else F.concat(F.lit("Data "), "o_orderpriority"), "title"),
            (none if predicted else F.struct(F.concat(city, F.lit(", Isère")).alias("display_name"), F.array(
                F.lit("France"), F.concat(F.lit("Région "), "o_orderstatus"), F.lit("ISÈRE"), F.upper(city)).alias("area")),
             "location"),
            (none if predicted else F.struct(F.concat(F.lit("Client "), "o_custkey").alias("display_name")), "company"),
            (F.col("o_totalprice"), "salary_min"), (F.col("o_totalprice") + 1000, "salary_max"),
            (F.lit("1") if predicted else F.lit("0"), "salary_is_predicted"),
            (F.when(F.col("o_orderkey") % 9 < 4, F.lit("contract")) if predicted else F.lit("permanent"), "contract_type"),
            (none if predicted else F.lit("full_time"), "contract_time"),
            (none if predicted else F.struct(F.lit("IT Jobs").alias("label")), "category"),
        ]
        return F.to_json(F.struct(*[c.alias(n) for c, n in named]))

    body = F.concat(F.lit('{"count": 2, "results": ['), item(False), F.lit(", "), item(True), F.lit("]}"))
    pages = table(spark, sf_dir, "orders").select(F.from_json(body, schemas.AGGREGATOR).alias("page"))
    items = pages.select(F.explode("page.results").alias("item"))
    return payloads.aggregator_offers(items, F.lit("data analyst")).select(
        "source", "source_id", "title", "location_raw", "contract_raw", "salary_min_raw", "salary_max_raw",
        "salary_unit_raw", "company", "sector_raw", "search_keyword")


@query("employment_payload", """
SELECT 'france_travail' AS source, CAST(o_orderkey AS VARCHAR) AS source_id, o_orderpriority AS title,
       CASE WHEN o_orderkey % 3 = 0 THEN 'Texte' ELSE 'Texte' || chr(10) || 'Compétences : SQL, ' || o_orderstatus END AS description,
       CASE WHEN o_orderkey % 2 = 0 THEN 'CDI' ELSE 'Contrat à durée indéterminée' END AS contract_raw,
       CASE WHEN o_orderkey % 5 = 0 THEN 'Selon profil' ELSE 'Annuel de ' || o_custkey || ' Euros' END AS salary_raw,
       CASE WHEN o_orderkey % 4 <> 0 THEN 'Client ' || o_custkey END AS company, '69 - LYON 03' AS location_raw,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS published_at FROM orders""")
def employment_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, client = F.col("o_orderkey"), F.concat(F.lit("Client "), "o_custkey")
    skills = F.array(F.struct(F.lit("SQL").alias("libelle")), F.struct(F.col("o_orderstatus").alias("libelle")))
    item = F.struct(
        key.cast("string").alias("id"), F.col("o_orderpriority").alias("intitule"), F.lit("Texte").alias("description"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dateCreation"),
        F.struct(F.lit("69 - LYON 03").alias("libelle")).alias("lieuTravail"),
        F.struct(F.when(key % 4 != 0, client).alias("nom")).alias("entreprise"), F.lit("CDI").alias("typeContrat"),
        F.when(key % 2 == 0, F.lit("")).otherwise(F.lit("Contrat à durée indéterminée")).alias("typeContratLibelle"),
        F.struct(F.when(key % 5 != 0, F.concat(F.lit("Annuel de "), "o_custkey", F.lit(" Euros"))).alias("libelle"),
                 F.lit("Selon profil").alias("commentaire")).alias("salaire"),
        F.when(key % 3 != 0, skills).alias("competences"))
    body = F.concat(F.lit('{"resultats": ['), F.to_json(item), F.lit("]}"))
    pages = table(spark, sf_dir, "orders").select(F.from_json(body, schemas.EMPLOYMENT).alias("page"))
    items = pages.select(F.explode("page.resultats").alias("item"))
    return payloads.employment_offers(items).select(
        "source", "source_id", "title", "description", "contract_raw", "salary_raw", "company", "location_raw",
        "published_at")


def pages_with_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with JSON-LD blocks written into them: six nestings, and blocks to be ignored."""
    key = F.col("page_id").cast("string")
    head = F.concat(F.lit('"title": "Offre '), key, F.lit('", "description": "<p>Texte <b>'), key,
                    F.lit('</b> &amp; suite</p>", "datePosted": "2026-09-25"'))
    place = F.lit('"jobLocation": {"address": {"addressLocality": "Nantes", "addressRegion": "Pays de la Loire"}, "geo": {"latitude": 1.5}}')
    pay = F.concat(F.lit('"baseSalary": {"value": {"minValue": '), key, F.lit(', "maxValue": "'), key, F.lit('9", "unitText": "YEAR"}}'))
    rich = F.concat(F.lit('{"@type": "JobPosting", "identifier": {"value": "R'), key, F.lit('"}, '), head, F.lit(", "), place, F.lit(", "), pay,
                    F.lit(', "employmentType": ["FULL_TIME", "CDI"], "hiringOrganization": [{"name": "Exemple"}], "industry": "Conseil"}'))
    poor = F.concat(F.lit('{"@type": ["Thing", "JobPosting"], '), head, F.lit(', "jobLocation": [{"address": "Lyon"}], "baseSalary": {"value": '), key,
                    F.lit(', "unitText": "MONTH"}, "hiringOrganization": "Seule", "jobLocationType": "TELECOMMUTE", "experienceRequirements": {"monthsOfExperience": 30}}'))
    slot = F.col("page_id") % 6
    block = (F.when(slot == 0, F.concat(F.lit('{"@graph": [{"@type": "WebPage"}, '), rich, F.lit("]}")))
             .when(slot == 1, rich).when(slot == 2, F.concat(F.lit("["), poor, F.lit("]")))
             .when(slot == 3, F.concat(F.lit('[[{"@graph": {"@graph": ['), poor, F.lit("]}}]]")))
             .when(slot == 4, F.lit('{"@type": "Organization", "name": "x"}'))
             .otherwise(F.concat(rich, F.lit(" cassé"))))
    script = F.concat(F.lit("<script type='application/ld+json'>"), block, F.lit("</script>"),
                      F.lit('<!-- <script type="application/ld+json">'), rich, F.lit("</script> -->"),
                      F.lit('<script type="application/json">'), rich, F.lit("</script>"))
    # The block comes first: a page of the table may break off anywhere.
    return table(spark, sf_dir, "pages").select("page_id", "url", F.concat(script, "html").alias("html"))


@query("jsonld_postings", """
WITH p AS (SELECT page_id, url, page_id % 6 AS s FROM pages WHERE page_id % 6 < 4)
SELECT 'jsonld_scraper' AS source, CASE WHEN s < 2 THEN 'R' || page_id ELSE LEFT(MD5(url), 16) END AS source_id, 'Offre ' || page_id AS title,
       'Texte ' || page_id || ' & suite' AS description, CASE WHEN s < 2 THEN 'Exemple' ELSE 'Seule' END AS company,
       CASE WHEN s < 2 THEN 'Nantes, Pays de la Loire' ELSE 'Lyon' END AS location_raw, '2026-09-25' AS published_at,
       CASE WHEN s < 2 THEN 'FULL_TIME, CDI' END AS contract_raw,
       CAST(CASE WHEN page_id > 0 OR s >= 2 THEN page_id END AS DOUBLE) AS salary_min_raw,
       CAST(CASE WHEN s < 2 THEN page_id * 10 + 9 ELSE page_id END AS DOUBLE) AS salary_max_raw,
       CASE WHEN s < 2 THEN 'YEAR' ELSE 'MONTH' END AS salary_unit_raw, CASE WHEN s >= 2 THEN '2 ans' END AS experience_raw,
       CASE WHEN s < 2 THEN 'Conseil' END AS sector_raw, CASE WHEN s >= 2 THEN 'TELECOMMUTE' END AS remote_raw, url,
       CASE WHEN s < 2 THEN CAST(1.5 AS DOUBLE) END AS latitude FROM p""")
def jsonld_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonld.offers_from_pages(pages_with_postings(spark, sf_dir)).select(
        "source", "source_id", "title", "description", "company", "location_raw", "published_at", "contract_raw",
        "salary_min_raw", "salary_max_raw", "salary_unit_raw", "experience_raw", "sector_raw", "remote_raw", "url", "latitude")


@query("html_text", r"""
WITH v AS (SELECT page_id, UNNEST(STRING_SPLIT_REGEX(REGEXP_REPLACE(html,
     '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '<x>', 'g'), '<[a-zA-Z/!?][^>]*>')) AS piece,
     GENERATE_SUBSCRIPTS(STRING_SPLIT_REGEX(REGEXP_REPLACE(html,
     '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '<x>', 'g'), '<[a-zA-Z/!?][^>]*>'), 1) AS i FROM pages),
t AS (SELECT page_id, i, REGEXP_REPLACE(REGEXP_REPLACE(REPLACE(REPLACE(REPLACE(piece, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'),
      '&amp(;|$)', '&', 'g'), '^\s+|\s+$', '', 'g') AS piece FROM v)
SELECT page_id, STRING_AGG(piece, ' ' ORDER BY i) AS text FROM t WHERE piece <> '' GROUP BY page_id""")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", jsonld.html_to_text(F.col("html")).alias("text"))


@query("listed_urls", "SELECT page_id, url FROM pages WHERE url IN (SELECT url FROM pages WHERE page_id % 3 <> 0)")
def listed_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A URL list written with comments and blank lines, read back and used as the semi-join key."""
    path = shared_dir(spark, "urls")
    pages = table(spark, sf_dir, "pages")
    line = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("  # "), "url")).otherwise(F.concat(F.lit(" "), "url", F.lit("  ")))
    pages.select(F.concat(line, F.lit("\n")).alias("value")).write.text(path)
    return pages.join(jsonld.read_urls(spark, path), "url", "left_semi") \
        .select("page_id", "url")


@query("landing_roundtrip", """
SELECT o_orderstatus AS source, CAST(o_orderkey AS VARCHAR) AS source_id, 'Data "é" ' || o_orderpriority AS title,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS salary_min_raw, o_orderkey % 2 = 0 AS is_demo,
       CAST(NULL AS VARCHAR) AS company FROM orders""")
def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records appended per source as JSON lines in two runs, then read as one table."""
    path = shared_dir(spark, "landing")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("source"), F.col("o_orderkey").cast("string").alias("source_id"),
        F.concat(F.lit('Data "é" '), "o_orderpriority").alias("title"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("salary_min_raw"),
        (F.col("o_orderkey") % 2 == 0).alias("is_demo"))
    for i in (0, 1):
        stamp = datetime(2026, 9, 1 + i, tzinfo=timezone.utc)
        landing.write_landing(rows.where(F.col("is_demo") == F.lit(bool(i))), path, stamp)
    return landing.read_landing(spark, path).select("source", "source_id", "title", "salary_min_raw", "is_demo", "company")


@query("props_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))
