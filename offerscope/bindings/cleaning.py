"""Row rules, deduplication and text columns on the given tables.

Texts are derived from the columns of the tables, so the expected label is a CASE on the source column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from offerscope.bindings.registry import half_up, query, table
from offerscope.functions import labels
from offerscope.functions.keys import content_key, month_of, utc_date
from offerscope.functions.location import with_location
from offerscope.functions.salary import plausible, with_salary
from offerscope.functions.text import first_match, norm, strip_accents, title_case
from offerscope.operators.dedup import oldest_then_latest_arrival, two_pass
from offerscope.operators.filters import select_dataset, within_age
from offerscope.plans.clean import whole_or_null


def _pick(key: Column, texts: list[str | None]) -> Column:
    """Text number ``key mod len(texts)``."""
    slot = F.pmod(key, F.lit(len(texts)))
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, text in enumerate(texts):
        chain = chain.when(slot == i, F.lit(text))
    return chain


def _sql_pick(key: str, values: list) -> str:
    def literal(v):
        if v is None:
            return "NULL"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {literal(v)}" for i, v in enumerate(values)) + " END"


# --- row rules -------------------------------------------------------------------------------------------------

@query("mode_select", """
WITH o AS (SELECT o_orderkey, o_orderstatus <> 'F' AS is_demo FROM orders)
SELECT o_orderkey, 'auto' AS mode, 'réel' AS label FROM o WHERE NOT is_demo
UNION ALL SELECT o_orderkey, 'all', 'réel + démo' FROM o
UNION ALL SELECT o_orderkey, 'auto demo only', 'démo' FROM o WHERE is_demo""")
def mode_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    from offerscope.operators.filters import dataset_label

    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderstatus") != "F").alias("is_demo"))

    def chosen(df: DataFrame, mode: str, name: str) -> DataFrame:
        label = dataset_label(df, mode).scalar()
        return select_dataset(df, mode).select("o_orderkey", F.lit(name).alias("mode"), label.alias("label"))

    return chosen(orders, "auto", "auto").unionByName(chosen(orders, "all", "all")) \
        .unionByName(chosen(orders.where("is_demo"), "auto", "auto demo only"))


@query("scope_filter", """
SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '\\b(widget|gear|bolt)\\b')
  AND NOT regexp_matches(p_name, '\\b(old|cold)\\b')""")
def scope_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = labels.in_scope(norm(F.col("p_name")), r"\b(widget|gear|bolt)\b", r"\b(old|cold)\b")
    return table(spark, sf_dir, "part").where(kept).select("p_partkey", "p_name")


@query("blank_titles", """
SELECT doc_id, turn_text FROM (SELECT conv_id AS doc_id, CASE WHEN turn % 3 = 0 THEN '  ' WHEN turn % 3 = 1 THEN NULL
       ELSE role END AS turn_text FROM conversations) WHERE TRIM(COALESCE(turn_text, '')) <> ''""")
def blank_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from offerscope.functions.text import strip

    text = F.when(F.col("turn") % 3 == 0, F.lit("  ")).when(F.col("turn") % 3 == 2, F.col("role"))
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), text.alias("turn_text"))
    return turns.where(strip(F.coalesce(F.col("turn_text"), F.lit(""))) != "")


@query("max_age_window", """
WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END AS day FROM events)
SELECT event_id, day FROM e WHERE day IS NULL OR day >= (SELECT MAX(day) FROM e) - INTERVAL 10 DAY""")
def max_age_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undated events stay; the window is counted back from the latest day."""
    day = F.when(F.col("event_type") != "error", F.col("ts").cast("date"))
    return within_age(table(spark, sf_dir, "events").select("event_id", day.alias("day")), "day", 10)


@query("plausible_bounds", """
SELECT o_orderkey, CASE WHEN ok THEN o_totalprice END AS salary_mid, CASE WHEN ok THEN o_totalprice - 500 END AS salary_min,
       CASE WHEN ok THEN 1 ELSE 0 END AS has_salary
FROM (SELECT *, o_totalprice BETWEEN 18000 AND 200000 AND o_orderpriority <> '5-LOW' AS ok FROM orders)""")
def plausible_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_totalprice").alias("salary_mid"),
        (F.col("o_totalprice") - 500).alias("salary_min"))
    keep = F.col("salary_mid").between(18000.0, 200000.0) & (F.col("o_orderpriority") != "5-LOW")
    out = plausible(orders, keep, ("salary_min", "salary_mid"))
    return out.withColumn("has_salary", labels.flag(F.col("salary_mid").isNotNull())).drop("o_orderpriority")


@query("whole_amounts", """
SELECT p_partkey, CASE WHEN x <> 0 THEN ROUND_EVEN(x, 0) END AS amount
FROM (SELECT p_partkey, (p_size - 1) / 2 AS x FROM part)""")
def whole_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = (F.col("p_size") - 1) / F.lit(2.0)
    return table(spark, sf_dir, "part").select("p_partkey", whole_or_null(half).alias("amount"))


@query("dedup_two_pass", """
WITH d AS (SELECT *, MD5(TRIM(REGEXP_REPLACE(LOWER(STRIP_ACCENTS(text)), '\\s+', ' ', 'g'))) AS key,
                  CASE WHEN n_chars % 7 = 0 THEN NULL ELSE CAST(n_chars % 365 AS INTEGER) END AS day FROM documents),
first AS (SELECT * FROM d QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, source, day ORDER BY day NULLS LAST, doc_id DESC) = 1),
second AS (SELECT * FROM first QUALIFY ROW_NUMBER() OVER (PARTITION BY key ORDER BY day NULLS LAST, doc_id DESC) = 1)
SELECT doc_id, text, lang, source, n_chars FROM second""")
def dedup_two_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two keys in sequence over whole documents: the winner of (lang, source, day), then of the normalised text."""
    days = F.when(F.col("n_chars") % 7 != 0, F.date_from_unix_date((F.col("n_chars") % 365).cast("int")))
    docs = table(spark, sf_dir, "documents").withColumns({"key": F.md5(norm(F.col("text"))), "day": days})
    best = two_pass(docs, ["lang", "source", "day"], ["key"], oldest_then_latest_arrival("day", ["doc_id"]), ["doc_id"])
    return best.drop("key", "day")


@query("dedup_documents", """
WITH d AS (SELECT doc_id, lang, MD5(TRIM(REGEXP_REPLACE(LOWER(STRIP_ACCENTS(text)), '\\s+', ' ', 'g'))) AS key FROM documents)
SELECT MIN(doc_id) AS doc_id, key FROM d GROUP BY key""")
def dedup_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from offerscope.operators.dedup import keep_best

    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5(norm(F.col("text"))).alias("key"))
    return keep_best(docs, ["key"], -F.col("doc_id"))


@query("offer_keys", """
SELECT o_orderkey, CONCAT(o_orderstatus, ':', o_orderkey) AS offer_id,
       MD5(CONCAT_WS('|', LOWER(o_orderpriority), 'acme ' || o_custkey, 'evry')) AS content_key FROM orders""")
def offer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    company = F.concat(F.lit("  ACMÉ "), F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat_ws(":", "o_orderstatus", "o_orderkey").alias("offer_id"),
        content_key(norm(F.col("o_orderpriority")), norm(company), norm(F.lit("Évry"))).alias("content_key"))


# --- text ------------------------------------------------------------------------------------------------------

@query("normalise_text", """
SELECT doc_id, TRIM(REGEXP_REPLACE(LOWER(STRIP_ACCENTS(text)), '\\s+', ' ', 'g')) AS text FROM documents""")
def normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", norm(F.col("text")).alias("text"))


@query("strip_accents_turns", "SELECT conv_id, turn, STRIP_ACCENTS(text) AS text FROM conversations")
def strip_accents_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", strip_accents(F.col("text")).alias("text"))


@query("title_case_names", """
SELECT p_partkey, ARRAY_TO_STRING(LIST_TRANSFORM(REGEXP_EXTRACT_ALL(LOWER(x), '[a-z]+|[^a-z]+'),
       lambda w: UPPER(w[1]) || w[2:]), '') AS name
FROM (SELECT p_partkey, REPLACE(p_name, ' ', '-') || ' d''' || p_type || ' ' || p_size || 'e' AS x FROM part)""")
def title_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(" d'"), "p_type", F.lit(" "), "p_size", F.lit("e"))
    return table(spark, sf_dir, "part").select("p_partkey", title_case(text).alias("name"))


@query("role_rules", """
SELECT p_partkey, CASE WHEN regexp_matches(p_name, 'red|blue') THEN 'colour' WHEN regexp_matches(p_name, '\\bbolt\\b|\\brod\\b')
       THEN 'fastener' WHEN regexp_matches(p_name, 'ring|gear') THEN 'round' ELSE 'other' END AS family FROM part""")
def role_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = (("colour", "red|blue"), ("fastener", r"\bbolt\b|\brod\b"), ("round", "ring|gear"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", labels.role_family(norm(F.col("p_name")), rules, "other").alias("family"))


_TITLES = ["Reporting Analyst bilingue", "Big Data - développeur Spark", "Statisticien assurance", "Plateforme MLOps",
           "Prompt Engineer", "Développeur décisionnel Cognos", "Consultant référentiels", "Data Owner achats",
           "Conducteur de travaux", "Responsable de l'offre données", "Doctorant en vision"]
_ROLES = ["Data Analyst", "Data Engineer", "Data Scientist", "Machine Learning Engineer", "AI / LLM Engineer",
          "Analytics Engineer / BI", "Consultant Data & IA", "Data Manager / Gouvernance", "Autre métier data",
          "Chef de projet / Lead Data & IA", "Recherche / R&D IA"]


@query("role_titles", f"SELECT o_orderkey, {_sql_pick('o_orderkey', _ROLES)} AS role FROM orders")
def role_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat_ws(" - ", _pick(F.col("o_orderkey"), _TITLES), F.lit("réf."), F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", labels.role_family(norm(title)).alias("role"))


@query("seniority_rules", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Stage / Alternance' WHEN 1 THEN 'Senior' WHEN 2 THEN 'Confirmé'
  ELSE CASE WHEN o_custkey % 12 <= 2 THEN 'Junior' WHEN o_custkey % 12 <= 5 THEN 'Confirmé' ELSE 'Senior' END END AS level
FROM orders""")
def seniority_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The title speaks first; otherwise the years of the field (slot 3) or of the description (slot 4)."""
    slot, years = F.col("o_orderkey") % 5, F.concat((F.col("o_custkey") % 12).cast("string"), F.lit(" ans d'expérience"))
    title = F.when(slot == 0, F.lit("Alternance Data")).when(slot == 1, F.lit("Lead Data")) \
        .when(slot == 2, F.lit("Data confirmé")).otherwise(F.lit("Data Manager"))
    field, body = F.when(slot == 3, years), F.when(slot == 4, years)
    level = labels.seniority(norm(title), F.lit("CDI"), labels.experience_years(norm(field)),
                             labels.experience_years(norm(body)))
    return table(spark, sf_dir, "orders").select("o_orderkey", level.alias("level"))


@query("experience_rules", f"""
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 0.0 WHEN 1 THEN CAST(o_custkey % 20 AS DOUBLE)
  WHEN 2 THEN o_custkey % 9 + 0.5 WHEN 3 THEN ROUND_EVEN(CAST((o_custkey % 40) / 12 AS DECIMAL(30,10)), 1) END AS years FROM orders""")
def experience_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot, key = F.col("o_orderkey") % 5, F.col("o_custkey")
    text = (F.when(slot == 0, F.lit("Débutant accepté, 3 ans appréciés"))
            .when(slot == 1, F.concat((key % 20).cast("string"), F.lit(" An(s) minimum")))
            .when(slot == 2, F.concat(F.lit("Environ "), (key % 9).cast("string"), F.lit(",5 ans")))
            .when(slot == 3, F.concat((key % 40).cast("string"), F.lit(" mois")))
            .otherwise(F.lit("Expérience appréciée")))
    return table(spark, sf_dir, "orders").select("o_orderkey", labels.experience_years(norm(text)).alias("years"))


_CONTRACT_TEXTS = ["embauche à durée indéterminée", "remplacement à durée déterminée", "contrat pro sur deux ans", "Full time",
                   "portage salarial", "saisonnier", "internship (3 months)", "statut à convenir", None]
_CONTRACTS = ["CDI", "CDD", "Alternance", "CDI", "Freelance", "Intérim / temporaire", "Stage", "Non précisé", "Non précisé"]


@query("contract_rules", f"""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderkey % 9 <> 2 THEN CASE WHEN o_custkey % 2 = 0 THEN 'Alternance'
       WHEN TRUE THEN 'Stage' END ELSE {_sql_pick('o_orderkey', _CONTRACTS)} END AS contract FROM orders""")
def contract_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.when(F.col("o_orderstatus") != "P", F.lit("Data Engineer")).otherwise(
        F.when(F.col("o_custkey") % 2 == 0, F.lit("Apprenti data")).otherwise(F.lit("Stagiaire data")))
    raw = _pick(F.col("o_orderkey"), _CONTRACT_TEXTS)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", labels.contract_type(norm(raw), norm(title)).alias("contract"))


_REMOTE_TEXTS = ["rythme hybride au choix", "équipe remote first", "télétravail intégral depuis la province",
                 "atelier : aucun télétravail", "travail à distance le vendredi", "bureaux près du canal", ""]
_REMOTE = ["Hybride", "Full remote", "Full remote", "Sur site", "Hybride", "Non précisé", "Non précisé"]


@query("remote_rules", f"""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Full remote' ELSE {_sql_pick('o_orderkey', _REMOTE)} END AS policy
FROM orders""")
def remote_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = F.when(F.col("o_orderstatus") == "F", F.lit("TELECOMMUTE"))
    text = norm(F.concat_ws(" ", field, _pick(F.col("o_orderkey"), _REMOTE_TEXTS)))
    return table(spark, sf_dir, "orders").select("o_orderkey", labels.remote_policy(text).alias("policy"))


_SECTOR_TEXTS = ["Hébergement et programmation", "Eau et assainissement", "Laboratoire de biotech", "Mutuelle régionale",
                 "Tous domaines", None]
_SECTORS = ["Conseil / ESN", "Énergie / Utilities", "Santé / Pharma", "Banque / Assurance / Finance", None, None]


@query("sector_rules", f"""
SELECT c_custkey, COALESCE({_sql_pick('c_custkey', _SECTORS)},
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Industrie / Aéronautique' ELSE 'Autre / Non précisé' END) AS sector FROM customer""")
def sector_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market segment plays the company name: read only where the activity says nothing."""
    activity = norm(_pick(F.col("c_custkey"), _SECTOR_TEXTS))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", labels.sector(activity, norm(F.col("c_mktsegment"))).alias("sector"))


@query("company_sentinel", """
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'Non précisé' ELSE s_name END AS company FROM supplier""")
def company_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("s_suppkey") % 6 == 0, F.lit("  ")).when(
        F.col("s_suppkey") % 3 != 0, F.concat(F.lit(" "), "s_name", F.lit(" ")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", labels.company_or_unknown(name).alias("company"))


# (text, city, department, region, latitude taken from the reference)
_PLACES = [
    ("69 - LYON 07", "Lyon", "69", "Auvergne-Rhône-Alpes", 45.7640),
    ("nantes 2e arrondissement", "Nantes", "44", "Pays de la Loire", 47.2184),
    ("Reims, Grand Est", "Reims", "51", "Grand Est", 49.2583),
    ("72 - Mamers", "Mamers", "72", "Pays de la Loire", None),
    ("Lozère", "Non précisé", "48", "Occitanie", None),
    ("5e Arrondissement, Marseille, Bouches-du-Rhône", "Marseille", "13", "Provence-Alpes-Côte d'Azur", 43.2965),
    ("Saint-Étienne, Loire", "Saint-Étienne", "42", "Auvergne-Rhône-Alpes", 45.4397),
    ("FRANCE", "Non précisé", None, "Non précisé", None),
    ("l'Aigle-sur-Risle, Orne", "L'Aigle-Sur-Risle", "61", "Normandie", None),
    ("PARIS CEDEX 12", "Paris", "75", "Île-de-France", 48.8566),
    ("Bretagne, France", "Non précisé", None, "Bretagne", None),
    ("Lyon (69)", "Lyon", "69", "Auvergne-Rhône-Alpes", 45.7640),
]


@query("location_lookup", f"""
SELECT c_custkey, {_sql_pick('c_custkey', [p[1] for p in _PLACES])} AS city,
       {_sql_pick('c_custkey', [p[2] for p in _PLACES])} AS department_code,
       {_sql_pick('c_custkey', [p[3] for p in _PLACES])} AS region,
       CASE WHEN c_custkey % 12 = 7 THEN NULL ELSE COALESCE({_sql_pick('c_custkey', [p[4] for p in _PLACES])}, c_acctbal) END
       AS latitude FROM customer""")
def location_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = table(spark, sf_dir, "customer").select(
        "c_custkey", _pick(F.col("c_custkey"), [p[0] for p in _PLACES]).alias("location_raw"),
        F.col("c_acctbal").alias("latitude"), F.col("c_acctbal").alias("longitude"))
    return with_location(placed).select("c_custkey", "city", "department_code", "region", "latitude")


@query("city_region_codes", """
SELECT s_suppkey, 'Ville ' || CHR(CAST(97 + s_suppkey % 26 AS INTEGER)) AS raw_city,
       LPAD(CAST(1 + s_suppkey % 19 AS VARCHAR), 2, '0') AS department_code,
  CASE 1 + s_suppkey % 19 WHEN 1 THEN 'Auvergne-Rhône-Alpes' WHEN 2 THEN 'Hauts-de-France' WHEN 3 THEN 'Auvergne-Rhône-Alpes'
  WHEN 4 THEN 'Provence-Alpes-Côte d''Azur' WHEN 5 THEN 'Provence-Alpes-Côte d''Azur' WHEN 6 THEN 'Provence-Alpes-Côte d''Azur'
  WHEN 7 THEN 'Auvergne-Rhône-Alpes' WHEN 8 THEN 'Grand Est' WHEN 9 THEN 'Occitanie' WHEN 10 THEN 'Grand Est'
  WHEN 11 THEN 'Occitanie' WHEN 12 THEN 'Occitanie' WHEN 13 THEN 'Provence-Alpes-Côte d''Azur' WHEN 14 THEN 'Normandie'
  WHEN 15 THEN 'Auvergne-Rhône-Alpes' WHEN 16 THEN 'Nouvelle-Aquitaine' WHEN 17 THEN 'Nouvelle-Aquitaine'
  WHEN 18 THEN 'Centre-Val de Loire' WHEN 19 THEN 'Nouvelle-Aquitaine' END AS region FROM supplier""")
def city_region_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Department prefix of a city the reference does not know: the region comes from the department table."""
    name = F.concat(F.lit("VILLE "), F.upper(F.chr(97 + F.col("s_suppkey") % 26)))
    code = F.lpad((1 + F.col("s_suppkey") % 19).cast("string"), 2, "0")
    placed = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.concat(code, F.lit(" - "), name).alias("location_raw"), F.lit(0.0).alias("latitude"),
        F.lit(0.0).alias("longitude"))
    out = with_location(placed)
    tail = F.lower(F.substring("city", -1, 1))
    return out.select("s_suppkey", F.concat(F.substring("city", 1, 6), tail).alias("raw_city"), "department_code",
                      "region")


# --- salaries ---------------------------------------------------------------------------------------------------

def _thousands(amount: Column) -> Column:
    return F.replace(F.format_number(amount, 0), F.lit(","), F.lit(" "))


@query("salary_text_roundtrip", f"""
WITH o AS (SELECT o_orderkey, o_orderkey % 8 AS f, CAST(20000 + FLOOR(o_totalprice) % 80000 AS BIGINT) AS a FROM orders),
e AS (SELECT o_orderkey, f, a, CASE f
  WHEN 0 THEN CAST(a AS DOUBLE) WHEN 1 THEN (a // 1000) * 1000.0 WHEN 2 THEN CAST(a AS DOUBLE) WHEN 3 THEN (a // 12) * 12.0
  WHEN 4 THEN (a // 1000) * 1000.0 WHEN 5 THEN (a // 1607) * 1607.0 WHEN 6 THEN NULL WHEN 7 THEN CAST(a AS DOUBLE) END AS lo,
  CASE f WHEN 0 THEN a + 5000.0 WHEN 1 THEN (a // 1000 + 5) * 1000.0 WHEN 2 THEN a + 5000.0 WHEN 3 THEN (a // 12) * 12.0
  WHEN 4 THEN (a // 1000 + 5) * 1000.0 WHEN 5 THEN (a // 1607) * 1607.0 WHEN 6 THEN NULL WHEN 7 THEN CAST(a AS DOUBLE) END AS hi FROM o)
SELECT o_orderkey, CAST(lo AS DOUBLE) AS salary_min, CAST(hi AS DOUBLE) AS salary_max, CAST((lo + hi) / 2 AS DOUBLE) AS salary_mid,
       CAST(CASE WHEN f = 6 THEN a // 200 END AS DOUBLE) AS daily_rate,
       CASE f WHEN 3 THEN 'month' WHEN 5 THEN 'hour' WHEN 6 THEN 'day' ELSE 'year' END AS salary_period FROM e""")
def salary_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text format a source uses, written from the order price and read back."""
    a = (F.lit(20000) + F.floor("o_totalprice") % 80000).cast("bigint")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 8).alias("f"), a.alias("a"))
    text = lambda c: c.cast("string")
    k = F.floor(F.col("a") / 1000)
    forms = [
        F.concat(F.lit("Annuel de "), text(F.col("a")), F.lit(".0 Euros à "), text(F.col("a") + 5000), F.lit(".0 Euros sur 12.0 mois")),
        F.concat(text(k), F.lit("K€ - "), text(k + 5), F.lit("K€")),
        F.concat(F.lit("Entre "), _thousands(F.col("a")), F.lit(" et "), _thousands(F.col("a") + 5000), F.lit(" € brut/an")),
        F.concat(F.lit("Mensuel de "), text(F.floor(F.col("a") / 12)), F.lit(" Euros sur 12 mois, 35h par semaine")),
        F.concat(F.lit("Salaire : "), text(k), F.lit("-"), text(k + 5), F.lit("k€ selon profil")),
        F.concat(F.lit("Horaire de "), text(F.floor(F.col("a") / 1607)), F.lit(".00 Euros sur 12 mois")),
        F.concat(text(F.floor(F.col("a") / 200)), F.lit(" € par jour")),
        F.concat(text(F.col("a")), F.lit(" euros bruts")),
    ]
    raw = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, form in enumerate(forms):
        raw = raw.when(F.col("f") == i, form)
    none = F.lit(None)
    written = orders.select("o_orderkey", raw.alias("salary_raw"), none.cast("double").alias("salary_min_raw"),
                            none.cast("double").alias("salary_max_raw"), none.cast("string").alias("salary_unit_raw"))
    return with_salary(written).select("o_orderkey", "salary_min", "salary_max", "salary_mid", "daily_rate",
                                       "salary_period")


_UNITS = ["YEAR", "month", "Hourly", "week", "DAY", "lunar", None]


@query("salary_structured", """
WITH o AS (SELECT o_orderkey, o_orderkey % 7 AS f, CASE o_orderkey % 7 WHEN 1 THEN 3000.0 WHEN 2 THEN 20.0 WHEN 3 THEN 800.0 WHEN 4 THEN 400.0
             ELSE 40000.0 END + o_custkey % 100 AS lo, o_custkey % 3 AS g FROM orders),
b AS (SELECT *, CASE WHEN g = 1 THEN lo ELSE lo + 10 END AS hi, CASE WHEN g = 2 THEN lo + 10 ELSE lo END AS low FROM o)
SELECT o_orderkey, CAST(CASE WHEN f <> 4 THEN low * k END AS DOUBLE) AS salary_min,
       CAST(CASE WHEN f <> 4 THEN hi * k END AS DOUBLE) AS salary_max, CAST(CASE WHEN f = 4 THEN (low + hi) / 2 END AS DOUBLE) AS daily_rate
FROM (SELECT *, CASE f WHEN 1 THEN 12 WHEN 2 THEN 1607 WHEN 3 THEN 52 ELSE 1 END AS k FROM b)""")
def salary_structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured bounds: one of them may be missing, the unit may be unknown."""
    f, g = F.col("o_orderkey") % 7, F.col("o_custkey") % 3
    base = F.when(f == 1, 3000.0).when(f == 2, 20.0).when(f == 3, 800.0).when(f == 4, 400.0).otherwise(40000.0)
    low = base + F.col("o_custkey") % 100
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.lit("99 €").alias("salary_raw"), F.when(g != 2, low).alias("salary_min_raw"),
        F.when(g != 1, low + 10).alias("salary_max_raw"),
        _pick(F.col("o_orderkey"), _UNITS).alias("salary_unit_raw"))
    return with_salary(rows).select("o_orderkey", "salary_min", "salary_max", "daily_rate")


# --- dates ------------------------------------------------------------------------------------------------------

@query("date_parse", """
SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL ELSE CAST(ts AS DATE) END AS published_date,
       CASE event_id % 5 WHEN 4 THEN NULL ELSE CAST(DATE_TRUNC('month', ts) AS DATE) END AS published_month FROM events""")
def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO dates, instants with and without offset, and unreadable text."""
    ts, slot = F.col("ts").cast("timestamp_ntz"), F.col("event_id") % 5
    text = (F.when(slot == 0, F.date_format(ts, "yyyy-MM-dd"))
            .when(slot == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
            .when(slot == 2, F.concat(F.date_format(ts + F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00")))
            .when(slot == 3, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.lit("bientôt")))
    day = utc_date(text)
    return table(spark, sf_dir, "events").select("event_id", day.alias("published_date"),
                                                 month_of(day).alias("published_month"))
