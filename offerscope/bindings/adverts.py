"""The whole way from raw records to views, on adverts written from the orders.

Each order becomes one raw record: its title, place, pay, contract, remote wording and skills are texts chosen by its
keys, so the expected clean row is a matter of CASE expressions. Warehouse tables are stored once per session and
scale folder, as a run does, and the views read them back.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from offerscope import schemas
from offerscope.bindings.cleaning import _PLACES, _pick, _sql_pick
from offerscope.bindings.mining import terms_sql
from offerscope.bindings.registry import MIDDLE, SQL, half_up, nearest, pct, query, ranked, table
from offerscope.functions.text import round_half_up
from offerscope.operators.filters import slice_offers
from offerscope.plans import insights as I, profile as P, views as V, warehouse as W
from offerscope.plans.clean import Staged, stage_offers, unique_offers
from offerscope.plans.export import export_tables, export_views, read_csv
from offerscope.session import shared_dir
from offerscope.settings import Settings
from offerscope.sources.landing import as_raw, write_landing
from offerscope.streaming import incremental
from offerscope.vocab.labels import OTHER_SECTOR, SELECTION_LABELS
from offerscope.vocab.stopwords import FRENCH, RECRUITMENT

SETTINGS = Settings(max_age_days=2000)

# (title, role family, level the title states, skill the title cites); the empty role is out of the market.
_TITLES = [
    ("Analyst données clients", "Data Analyst", None, None), ("Data Engineer principal", "Data Engineer", "Senior", None),
    ("Statisticien débutant", "Data Scientist", "Junior", None),
    ("Apprenti Machine Learning Engineer", "Machine Learning Engineer", "Stage / Alternance", "Machine Learning"),
    ("Développeur BI expérimenté", "Analytics Engineer / BI", "Confirmé", None),
    ("Data Owner", "Data Manager / Gouvernance", None, None), ("Enseignant en data", None, None, None),
    ("   ", None, None, None), ("Projets IA générative", "AI / LLM Engineer", None, "IA générative"),
    ("Head of Data", "Chef de projet / Lead Data & IA", "Senior", None), ("Staff data", "Autre métier data", "Senior", None),
    ("Big data", "Data Engineer", None, None),
]
# (description, remote policy, skills)
_BODIES = [
    ("Vos outils : Tableau, SQL, Python. Deux jours de télétravail.", "Hybride", ["Python", "SQL", "Tableau"]),
    ("AWS, Airflow, Spark ainsi que Python ; remote first.", "Full remote", ["Python", "Spark", "Airflow", "AWS"]),
    ("Power BI puis Excel : tableaux de bord mensuels, aucun télétravail.", "Sur site", ["Power BI", "Excel", "KPI & reporting"]),
    ("", "Non précisé", []),
    ("Python au service de RAG et LLM, rythme hybride.", "Hybride", ["Python", "LLM", "RAG"]),
    ("SQL, anglais courant, esprit d’équipe.", "Non précisé", ["SQL", "Travail en équipe", "Anglais"]),
]
_SECTORS = {"AUTOMOBILE": ("Automobile", "Industrie / Aéronautique"),
            "BUILDING": ("Mutuelle", "Banque / Assurance / Finance"),
            "FURNITURE": ("Grande distribution", "Retail / E-commerce"), "HOUSEHOLD": (None, "Autre / Non précisé"),
            "MACHINERY": ("Hébergement de sites", "Conseil / ESN")}
_LON = [4.8357, -1.5536, 4.0317, None, None, 5.3698, 4.3872, None, None, 2.3522, None, 4.8357]


def raw_adverts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw record per order, plus ``_arrival``, the order of arrival."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    o = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    key, slot = F.col("o_orderkey"), F.col("o_orderkey") % 5
    pair, price = F.floor(F.col("o_orderkey") / 2), F.floor("o_totalprice")
    yearly, text = (15000 + price % 60000), lambda c: c.cast("bigint").cast("string")
    salary = (F.when(slot == 0, F.concat(F.lit("Annuel de "), text(yearly), F.lit(".0 Euros à "), text(yearly + 5000),
                                         F.lit(".0 Euros sur 12.0 mois")))
              .when(slot == 3, F.concat(text(200 + price % 400), F.lit(" € par jour")))
              .when(slot == 4, F.concat(F.lit("Mensuel de "), text(2000 + price % 3000), F.lit(" Euros sur 12 mois"))))
    sector = F.when(F.lit(False), F.lit(None).cast("string"))
    for segment, (activity, _) in _SECTORS.items():
        sector = sector.when(F.col("c_mktsegment") == segment, F.lit(activity))
    rows = o.select(
        F.when(pair % 3 == 0, F.lit("a")).otherwise(F.concat(F.lit("b"), text(key % 2))).alias("source"),
        text(pair).alias("source_id"), _pick(key, [t[0] for t in _TITLES]).alias("title"),
        _pick(key, [b[0] for b in _BODIES]).alias("description"),
        F.when(F.col("c_custkey") % 10 != 0, F.col("c_name")).alias("company"),
        _pick(F.col("c_custkey"), [p[0] for p in _PLACES]).alias("location_raw"),
        F.when(key % 11 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("published_at"),
        F.when(F.col("o_orderstatus") == "F", F.lit("CDI")).when(
            F.col("o_orderstatus") == "O", F.lit("Contrat à durée déterminée")).otherwise(F.lit("Freelance")).alias("contract_raw"),
        salary.alias("salary_raw"), F.when(slot == 2, yearly.cast("double")).alias("salary_min_raw"),
        F.when(slot == 2, yearly.cast("double") + 2000).alias("salary_max_raw"),
        F.when(slot == 2, F.lit("YEAR")).alias("salary_unit_raw"),
        F.when(key % 4 == 0, F.lit("3 An(s)")).alias("experience_raw"), sector.alias("sector_raw"),
        (key % 17 == 0).alias("is_demo"), key.alias("_arrival"))
    return as_raw(rows, "_arrival")


def staged_adverts(spark: SparkSession, sf_dir: str) -> Staged:
    return stage_offers(raw_adverts(spark, sf_dir), shared_dir(spark, "staged-adverts"), SETTINGS, arrival=["_arrival"])


_STORED: dict[tuple[str, str], str] = {}


def warehouse_path(spark: SparkSession, sf_dir: str) -> str:
    """The stored warehouse of a scale folder, built on first use in a session: the fourteen views read one load."""
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _STORED:
        path, staged = shared_dir(spark, "warehouse"), staged_adverts(spark, sf_dir)
        counts = W.store(unique_offers(staged.chosen(SETTINGS.data_mode), SETTINGS, ["_arrival"]), path, SETTINGS)
        W.log_run(spark, path, SELECTION_LABELS["real"], staged.real, counts["offers"], counts["offer_skills"])
        _STORED[slot] = path
    return _STORED[slot]


def warehouse_of(spark: SparkSession, sf_dir: str) -> W.Warehouse:
    return W.load(spark, warehouse_path(spark, sf_dir))


def _case(key: str, pairs: dict) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + " END"


def _list_case(key: str, lists: list[list[str]]) -> str:
    def literal(v):
        return "CAST([] AS VARCHAR[])" if not v else "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in v) + "]"
    return f"CASE {key} % {len(lists)} " + " ".join(f"WHEN {i} THEN {literal(v)}" for i, v in enumerate(lists)) + " END"


_YEARLY, _PRICE = "(15000 + p % 60000)", "CAST(FLOOR(o_totalprice) AS BIGINT)"
# Expected clean rows, before and after the age limit and the two passes.
_OFFERS = f"""
src AS (SELECT o_orderkey AS k, c_custkey AS c, o_orderstatus AS st, {_PRICE} AS p, o_orderkey // 2 AS pair,
          CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS published_date, c_mktsegment, c_name
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 17 <> 0),
lab AS (SELECT *, TRIM({_sql_pick('k', [t[0] for t in _TITLES])}) AS title, {_sql_pick('k', [t[1] for t in _TITLES])} AS role_family,
          COALESCE({_sql_pick('k', [t[2] for t in _TITLES])}, CASE WHEN k % 4 = 0 THEN 'Confirmé' ELSE 'Non précisé' END) AS seniority,
          CASE WHEN k % 4 = 0 THEN CAST(3 AS DOUBLE) END AS experience_years,
          CASE WHEN k % 12 = 3 THEN 'Alternance' WHEN st = 'F' THEN 'CDI' WHEN st = 'O' THEN 'CDD' ELSE 'Freelance' END AS contract_type,
          CASE WHEN c % 10 <> 0 THEN c_name ELSE 'Non précisé' END AS company,
          {_case('c_mktsegment', {k: v[1] for k, v in _SECTORS.items()})} AS sector,
          {_sql_pick('c', [p[1] for p in _PLACES])} AS city, {_sql_pick('c', [p[2] for p in _PLACES])} AS department_code,
          {_sql_pick('c', [p[3] for p in _PLACES])} AS region, CAST({_sql_pick('c', [p[4] for p in _PLACES])} AS DOUBLE) AS latitude,
          CAST({_sql_pick('c', _LON)} AS DOUBLE) AS longitude, {_sql_pick('k', [b[1] for b in _BODIES])} AS remote_policy,
          CASE k % 5 WHEN 0 THEN {_YEARLY} WHEN 2 THEN {_YEARLY} WHEN 4 THEN (2000 + p % 3000) * 12 END AS lo,
          CASE k % 5 WHEN 0 THEN {_YEARLY} + 5000 WHEN 2 THEN {_YEARLY} + 2000 WHEN 4 THEN (2000 + p % 3000) * 12 END AS hi,
          CAST(CASE WHEN k % 5 = 3 THEN 200 + p % 400 END AS DOUBLE) AS daily_rate,
          LIST_CONCAT({_list_case('k', [b[2] for b in _BODIES])}, {_list_case('k', [[t[3]] if t[3] else [] for t in _TITLES])}) AS skills,
          CASE WHEN pair % 3 = 0 THEN 'a' ELSE 'b' || (k % 2) END AS source
        FROM src WHERE {_sql_pick('k', [t[1] for t in _TITLES])} IS NOT NULL),
typed AS (SELECT *, source || ':' || pair AS offer_id, CAST(DATE_TRUNC('month', published_date) AS DATE) AS published_month,
          (lo + hi) / 2 BETWEEN 18000 AND 200000 AND seniority <> 'Stage / Alternance' AS ok FROM lab),
recent AS (SELECT * FROM typed WHERE published_date IS NULL OR published_date >= (SELECT MAX(published_date) FROM typed) - INTERVAL 2000 DAY),
once AS (SELECT * FROM recent QUALIFY ROW_NUMBER() OVER (PARTITION BY offer_id ORDER BY published_date NULLS LAST, k DESC) = 1),
offers AS (SELECT *, CAST(CASE WHEN ok THEN lo END AS DOUBLE) AS salary_min, CAST(CASE WHEN ok THEN hi END AS DOUBLE) AS salary_max,
          CAST(CASE WHEN ok THEN ROUND_EVEN((lo + hi) / 2, 0) END AS DOUBLE) AS salary_mid, CASE WHEN ok THEN 1 ELSE 0 END AS has_salary,
          CAST(LEN(skills) AS INTEGER) AS skills_count, CASE WHEN remote_policy IN ('Hybride', 'Full remote') THEN 1 ELSE 0 END AS remote
          FROM once QUALIFY ROW_NUMBER() OVER (PARTITION BY LOWER(title), company, city ORDER BY published_date NULLS LAST, k DESC) = 1),
links AS (SELECT offer_id, role_family, salary_mid, UNNEST(skills) AS skill FROM offers)"""
_CATALOGUE = "dictionary AS (SELECT * FROM (VALUES " + ", ".join(
    "('{}', '{}', '{}')".format(s.name.replace("'", "''"), s.category.replace("'", "''"),
                                "Technologie" if s.kind == "tech" else "Compétence / méthode")
    for s in SETTINGS.skills) + ") v(skill, category, kind))"
_TOTAL = "(SELECT COUNT(*) FROM offers)"


@query("clean_adverts", f"""WITH {_OFFERS} SELECT offer_id, title, role_family, seniority, experience_years, contract_type, company, sector,
  city, department_code, region, latitude, longitude, remote_policy, salary_min, salary_max, salary_mid, has_salary, daily_rate,
  published_date, published_month FROM offers""")
def clean_adverts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records to clean offers, staged in between as a run does."""
    clean = unique_offers(staged_adverts(spark, sf_dir).chosen(SETTINGS.data_mode), SETTINGS, ["_arrival"])
    return clean.select("offer_id", "title", "role_family", "seniority", "experience_years", "contract_type", "company", "sector",
                        "city", "department_code", "region", "latitude", "longitude", "remote_policy", "salary_min", "salary_max",
                        "salary_mid", "has_salary", "daily_rate", "published_date", "published_month")


def _view(name: str, sql: str | None):
    view = V.VIEWS[name]
    query(f"view_{name}", sql)(lambda spark, sf_dir: view(warehouse_of(spark, sf_dir)))


_view("offres", f"""WITH {_OFFERS} SELECT offer_id AS id_offre, source, 0 AS est_demo, title AS intitule, role_family AS metier,
  seniority AS seniorite, experience_years AS annees_experience, contract_type AS type_contrat, company AS entreprise, sector AS secteur,
  city AS ville, department_code AS departement, region, 'France' AS pays, latitude, longitude, remote_policy AS teletravail,
  remote AS teletravail_possible, salary_min AS salaire_min, salary_max AS salaire_max, salary_mid AS salaire_annuel,
  has_salary AS salaire_affiche, daily_rate AS tjm, CASE WHEN contract_type = 'CDI' THEN 1 ELSE 0 END AS est_cdi,
  published_date AS date_publication, published_month AS mois_publication, skills_count AS nb_competences, CAST(NULL AS VARCHAR) AS url
  FROM offers""")
_view("offres_competences", f"""WITH {_OFFERS}, {_CATALOGUE} SELECT offer_id AS id_offre, skill AS competence, category AS categorie_competence,
  kind AS type_competence FROM links JOIN dictionary USING (skill)""")
_view("kpi_globaux", f"""WITH {_OFFERS} SELECT COUNT(*) AS nb_offres, COUNT(DISTINCT company) AS nb_entreprises,
  COUNT(DISTINCT CASE WHEN city <> 'Non précisé' THEN city END) AS nb_villes, {half_up('AVG(salary_mid)', 0)} AS salaire_moyen,
  (SELECT {half_up('AVG(v)', 0)} FROM {ranked('offers', '', 'salary_mid')} WHERE {MIDDLE}) AS salaire_median,
  {pct('SUM(has_salary)', 'COUNT(*)')} AS pct_offres_avec_salaire, {pct('SUM(remote)', 'COUNT(*)')} AS pct_teletravail,
  {pct("COUNT(*) FILTER (WHERE contract_type = 'CDI')", 'COUNT(*)')} AS pct_cdi,
  {pct("COUNT(*) FILTER (WHERE seniority IN ('Junior', 'Stage / Alternance'))", 'COUNT(*)')} AS pct_offres_junior,
  {half_up('AVG(skills_count)', 1)} AS nb_competences_moyen, {pct('COUNT(*) FILTER (WHERE skills_count > 0)', 'COUNT(*)')} AS pct_offres_avec_competence,
  MIN(published_date) AS date_min, MAX(published_date) AS date_max, 'Réel' AS jeu_de_donnees FROM offers""")
_SALARIES = f"""SELECT role_family AS metier, seniority AS seniorite, MAX(cnt) AS nb_offres_avec_salaire, {half_up('AVG(v)', 0)} AS salaire_moyen,
  {half_up('AVG(v) FILTER (WHERE ' + MIDDLE + ')', 0)} AS salaire_median, {nearest(0.25)} AS salaire_q1, {nearest(0.75)} AS salaire_q3,
  MIN(v) AS salaire_min, MAX(v) AS salaire_max,
  CASE WHEN MAX(cnt) >= 30 THEN 'Bonne' WHEN MAX(cnt) >= 10 THEN 'Moyenne' ELSE 'Faible (< 10 offres)' END AS fiabilite
  FROM {ranked('offers', 'role_family, seniority', 'salary_mid')} GROUP BY 1, 2"""
_view("salaires_metier_seniorite", f"WITH {_OFFERS} {_SALARIES}")
_CITIES = f"""SELECT o.city AS ville, o.region, COUNT(*) AS nb_offres, {pct('COUNT(*)', _TOTAL, 2)} AS part_offres_pct,
  {half_up('MAX(m.m)', 0)} AS salaire_median, COALESCE(MAX(m.n), 0) AS nb_offres_avec_salaire, {pct('SUM(remote)', 'COUNT(*)')} AS pct_teletravail,
  {half_up('AVG(latitude)', 6)} AS latitude, {half_up('AVG(longitude)', 6)} AS longitude, 'France' AS pays
  FROM offers o LEFT JOIN (SELECT city, AVG(v) AS m, MAX(cnt) AS n FROM {ranked('offers', 'city', 'salary_mid')} WHERE {MIDDLE} GROUP BY city) m
  ON m.city = o.city GROUP BY o.city, o.region"""


@query("view_villes", f"WITH {_OFFERS} {_CITIES}")
def view_villes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = V.villes(warehouse_of(spark, sf_dir))
    return out.withColumns({c: round_half_up(F.col(c), 6) for c in ("latitude", "longitude")})


@query("view_villes_by_region", f"""WITH {_OFFERS}, m AS (SELECT city, region, AVG(v) AS m, MAX(cnt) AS n
  FROM {ranked('offers', 'city, region', 'salary_mid')} WHERE {MIDDLE} GROUP BY 1, 2)
SELECT o.city AS ville, o.region, COUNT(*) AS nb_offres, {half_up('MAX(m.m)', 0)} AS salaire_median,
  COALESCE(MAX(m.n), 0) AS nb_offres_avec_salaire FROM offers o LEFT JOIN m ON m.city = o.city AND m.region = o.region GROUP BY o.city, o.region""")
def view_villes_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.villes(warehouse_of(spark, sf_dir), median_by_region=True).select(
        "ville", "region", "nb_offres", "salaire_median", "nb_offres_avec_salaire")


_SECTOR_ROWS = f"""SELECT o.sector AS secteur, COUNT(*) AS nb_offres, {pct('COUNT(*)', _TOTAL, 2)} AS part_offres_pct,
  {half_up('MAX(m.m)', 0)} AS salaire_median, {pct('SUM(remote)', 'COUNT(*)')} AS pct_teletravail,
  {pct("COUNT(*) FILTER (WHERE contract_type = 'CDI')", 'COUNT(*)')} AS pct_cdi
  FROM offers o LEFT JOIN (SELECT sector, AVG(v) AS m FROM {ranked('offers', 'sector', 'salary_mid')} WHERE {MIDDLE} GROUP BY sector) m
  ON m.sector = o.sector GROUP BY o.sector"""
_view("secteurs", f"WITH {_OFFERS} {_SECTOR_ROWS}")
_ROLE_SKILLS = f"""SELECT c.role AS metier, c.skill AS competence, category AS categorie_competence, kind AS type_competence, c.n AS nb_offres,
  t.n AS nb_offres_metier, {pct('c.n', 't.n')} AS part_offres_pct, RANK() OVER (PARTITION BY c.role ORDER BY c.n DESC) AS rang,
  c.role = 'Tous métiers' AS est_total
  FROM (SELECT role_family AS role, skill, COUNT(*) AS n FROM links GROUP BY 1, 2 UNION ALL SELECT 'Tous métiers', skill, COUNT(*) FROM links GROUP BY 2) c
  JOIN (SELECT role_family AS role, COUNT(*) AS n FROM offers GROUP BY 1 UNION ALL SELECT 'Tous métiers', COUNT(*) FROM offers) t USING (role)
  JOIN dictionary USING (skill)"""
_view("competences_par_metier", f"WITH {_OFFERS}, {_CATALOGUE} {_ROLE_SKILLS}")
_GRID = f"""(SELECT d.skill, o.salary_mid, CASE WHEN l.offer_id IS NULL THEN 0 ELSE 1 END AS has FROM dictionary d
  CROSS JOIN (SELECT offer_id, salary_mid FROM offers WHERE salary_mid IS NOT NULL) o LEFT JOIN links l ON l.skill = d.skill AND l.offer_id = o.offer_id)"""
_PREMIUMS = f"""SELECT w.skill AS competence, category AS categorie_competence, w.n AS nb_offres_avec, wo.n AS nb_offres_sans,
  {half_up('w.m', 0)} AS salaire_median_avec, {half_up('wo.m', 0)} AS salaire_median_sans, {half_up('w.m - wo.m', 0)} AS prime_eur,
  {half_up('100 * (w.m - wo.m) / wo.m', 1)} AS prime_pct, CASE WHEN w.n >= 20 THEN 'Moyenne' ELSE 'Faible (10 à 19 offres)' END AS fiabilite
  FROM med w JOIN med wo ON wo.skill = w.skill AND wo.has = 0 JOIN dictionary d ON d.skill = w.skill WHERE w.has = 1 AND w.n >= 10"""
_MED = f"""med AS (SELECT skill, has, AVG(v) AS m, MAX(cnt) AS n FROM {ranked(_GRID, 'skill, has', 'salary_mid')} WHERE {MIDDLE} GROUP BY 1, 2)"""
_view("prime_salariale_competences", f"WITH {_OFFERS}, {_CATALOGUE}, {_MED} {_PREMIUMS}")
_PAIRS = f"""SELECT p.a AS competence_a, p.b AS competence_b, p.n AS nb_offres_communes, {pct('p.n', 'fa.n')} AS pct_offres_a_avec_b,
  {half_up(f'CAST(p.n AS DOUBLE) * {_TOTAL} / (fa.n * fb.n)', 2)} AS lift
  FROM (SELECT a.skill AS a, b.skill AS b, COUNT(*) AS n FROM links a JOIN links b ON a.offer_id = b.offer_id AND a.skill < b.skill
        GROUP BY 1, 2 HAVING COUNT(*) >= 5) p
  JOIN (SELECT skill, COUNT(*) AS n FROM links GROUP BY 1) fa ON fa.skill = p.a JOIN (SELECT skill, COUNT(*) AS n FROM links GROUP BY 1) fb ON fb.skill = p.b"""
_view("paires_competences", f"WITH {_OFFERS} {_PAIRS}")
_view("tendance_mensuelle", f"""WITH {_OFFERS} SELECT published_month AS mois, role_family AS metier, COUNT(*) AS nb_offres,
  {half_up('AVG(salary_mid)', 0)} AS salaire_moyen, CAST(SUM(remote) AS BIGINT) AS nb_offres_teletravail
  FROM offers WHERE published_month IS NOT NULL GROUP BY 1, 2""")
_REMOTE_ROWS = f"""SELECT role_family AS metier, remote_policy AS teletravail, COUNT(*) AS nb_offres,
  {pct('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY role_family)')} AS part_offres_pct FROM offers GROUP BY 1, 2"""
_view("teletravail_metier", f"WITH {_OFFERS} {_REMOTE_ROWS}")
_LEVEL_ROWS = f"""SELECT role_family AS metier, seniority AS seniorite, CASE seniority WHEN 'Stage / Alternance' THEN 1 WHEN 'Junior' THEN 2
  WHEN 'Confirmé' THEN 3 WHEN 'Senior' THEN 4 ELSE 5 END AS ordre_seniorite, COUNT(*) AS nb_offres,
  {pct('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY role_family)')} AS part_offres_pct FROM offers GROUP BY 1, 2"""
_view("seniorite_metier", f"WITH {_OFFERS} {_LEVEL_ROWS}")
_view("contrats", f"""WITH {_OFFERS} SELECT contract_type AS type_contrat, role_family AS metier, COUNT(*) AS nb_offres,
  {half_up('AVG(daily_rate)', 0)} AS tjm_moyen FROM offers GROUP BY 1, 2""")
_TERM_ROWS = "advert_texts AS (SELECT offer_id, role_family, " + _sql_pick("k", [b[0] for b in _BODIES]) + " AS description FROM offers)"
_TERMS = f"{_TERM_ROWS}, {terms_sql('advert_texts', 'offer_id', 'role_family', 'description', FRENCH | RECRUITMENT)}"  # the adverts hold no English stop word
_view("termes_tfidf", f"""WITH {_OFFERS}, {_TERMS} SELECT lang AS metier, term AS terme, tfidf_score AS score_tfidf, rank AS rang
  FROM ranked_terms""")


@query("exported_views", " UNION ALL ".join(
    f"SELECT '{name}' AS name, (SELECT COUNT(*) FROM ({SQL[f'view_{name}']})) AS n" for name in V.VIEWS if name != "villes")
    + f" UNION ALL SELECT 'villes', (SELECT COUNT(*) FROM (WITH {_OFFERS} {_CITIES}))")
def exported_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every view written as CSV and read back: its rows."""
    path = shared_dir(spark, "exports")
    written = export_views(warehouse_of(spark, sf_dir), path)
    back = [spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{path}/{name}.csv").agg(
        F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name in written]
    return reduce(DataFrame.unionByName, back)


@query("processed_csv", f"""WITH {_OFFERS} SELECT offer_id, title, {_sql_pick('k', [b[0] or None for b in _BODIES])} AS description, city, salary_mid,
  published_date, skills_count FROM offers""")
def processed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed offers as CSV, read back with their types; CSV knows no empty text beside NULL."""
    path = shared_dir(spark, "processed")
    export_tables(warehouse_of(spark, sf_dir), path)
    back = read_csv(spark, f"{path}/offers.csv", schemas.OFFERS)
    return back.select("offer_id", "title", "description", "city", "salary_mid", "published_date", "skills_count")


@query("run_log", f"""WITH {_OFFERS} SELECT 'réel' AS dataset_label, (SELECT COUNT(*) FROM src) AS n_raw, (SELECT COUNT(*) FROM offers) AS n_offers,
  (SELECT COUNT(*) FROM links) AS n_offer_skills""")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = spark.read.parquet(f"{warehouse_path(spark, sf_dir)}/pipeline_runs")
    return log.select("dataset_label", "n_raw", "n_offers", "n_offer_skills")


@query("sql_views", f"""WITH {_OFFERS} SELECT city AS ville, role_family AS metier, COUNT(*) AS nb, COUNT(*) FILTER (WHERE contract_type = 'CDI') AS cdi
  FROM offers WHERE remote = 1 GROUP BY 1, 2""")
def sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered view read with SQL."""
    V.register(warehouse_of(spark, sf_dir))
    return spark.sql("SELECT ville, metier, COUNT(*) AS nb, SUM(est_cdi) AS cdi FROM v_offres WHERE teletravail_possible = 1 GROUP BY ville, metier")


@query("incremental_adverts", f"""WITH {_OFFERS.replace('published_date NULLS LAST, k DESC) = 1),', 'published_date NULLS LAST, source DESC, k DESC) = 1),')}
  SELECT offer_id, title, role_family, seniority, company, city, salary_mid, published_date FROM offers""")
def incremental_adverts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adverts landed as files of their sources, taken up by the stream and made unique over the staged rows."""
    folder = shared_dir(spark, "incremental")
    ordered = raw_adverts(spark, sf_dir).repartitionByRange("source", "_arrival").sortWithinPartitions("source", "_arrival")
    write_landing(ordered.drop("_arrival"), f"{folder}/raw", datetime(2026, 1, 1, tzinfo=timezone.utc))
    incremental.start(spark, f"{folder}/raw", f"{folder}/staging", f"{folder}/marks", SETTINGS).awaitTermination()
    clean = incremental.unique_staged(spark, f"{folder}/staging", SETTINGS)
    return clean.select("offer_id", "title", "role_family", "seniority", "company", "city", "salary_mid", "published_date")


_RULES = {
    "offers": [*(f"{c} not null" for c in ("offer_id", "source", "source_id", "is_demo", "title", "role_family", "seniority", "contract_type",
                                           "sector", "city", "region", "remote_policy", "has_salary", "skills_count")),
               "is_demo in (0, 1)", "has_salary in (0, 1)", "primary key (offer_id)"],
    "skills": ["skill not null", "category not null", "skill_type not null", "skill_type in (tech, skill)", "primary key (skill)"],
    "offer_skills": ["offer_id not null", "skill not null", "primary key (offer_id, skill)", "foreign key (offer_id)", "foreign key (skill)"],
    "top_terms": ["role_family not null", "term not null", "tfidf_score not null", "rank not null"]}


@query("warehouse_constraints", f"""WITH {_OFFERS}, {_CATALOGUE}
SELECT 'sound' AS load, "table", rule, CAST(0 AS BIGINT) AS violations FROM (VALUES {", ".join(
    f"('{t}', '{r}')" for t, rules in _RULES.items() for r in rules)}) v("table", rule)
UNION ALL SELECT 'broken', 'offers', 'is_demo in (0, 1)', COUNT(*) FROM offers
UNION ALL SELECT 'broken', 'offers', 'has_salary in (0, 1)', COUNT(*) FROM offers WHERE has_salary = 1
UNION ALL SELECT 'broken', 'offers', 'sector not null', COUNT(*) FROM offers WHERE sector = 'Autre / Non précisé'
UNION ALL SELECT 'broken', 'offer_skills', 'primary key (offer_id, skill)', COUNT(*) FROM links
UNION ALL SELECT 'broken', 'offer_skills', 'foreign key (skill)', 2 * COUNT(*) FROM links WHERE skill = 'SQL'
UNION ALL SELECT 'broken', 'skills', 'skill_type in (tech, skill)', COUNT(*) FROM dictionary WHERE kind = 'Technologie' AND skill <> 'SQL'""")
def warehouse_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report over the stored load, and what it says of a load with rows that break rules of every kind."""
    w = warehouse_of(spark, sf_dir)
    broken = W.Warehouse(
        offers=w.offers.withColumns({"is_demo": F.lit(2), "has_salary": F.col("has_salary") * 3,
                                     "sector": F.when(F.col("sector") != OTHER_SECTOR, F.col("sector"))}),
        skills=w.skills.where("skill <> 'SQL'").withColumn("skill_type", F.when(F.col("skill_type") == "tech", "tool").otherwise("skill")),
        offer_skills=w.offer_skills.union(w.offer_skills), top_terms=w.top_terms)
    return W.constraints(w).withColumn("load", F.lit("sound")).unionByName(
        W.constraints(broken).where("violations > 0").withColumn("load", F.lit("broken")))


@query("advert_quality", f"WITH {_OFFERS} " + " UNION ALL ".join(
    f"SELECT '{label}' AS indicator, {pct(f'COUNT(*) FILTER (WHERE {condition})', 'COUNT(*)')} AS part_pct FROM offers"
    for label, condition in zip(P.INDICATORS.values(), (
        "role_family = 'Autre métier data'", "seniority = 'Non précisé'", "contract_type = 'Non précisé'", "remote_policy = 'Non précisé'",
        "city = 'Non précisé'", "region = 'Non précisé'", "sector = 'Autre / Non précisé'", "has_salary = 0", "skills_count = 0"))))
def advert_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.quality(warehouse_of(spark, sf_dir))


@query("advert_slice", f"""WITH {_OFFERS}, {_CATALOGUE} SELECT role_family, COUNT(*) AS n FROM offers
  WHERE region = 'Île-de-France' AND remote_policy IN ('Hybride', 'Full remote')
  AND offer_id IN (SELECT offer_id FROM links JOIN dictionary USING (skill) WHERE category = 'IA générative') GROUP BY 1""")
def advert_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse_of(spark, sf_dir)
    kept = slice_offers(w.offers, regions=["Île-de-France"], remote=["Hybride", "Full remote"], categories=["IA générative"],
                        links=w.offer_skills, skills=w.skills)
    return kept.groupBy("role_family").agg(F.count(F.lit(1)).alias("n"))


def _top(section: str, source: str, label: str, value: str, n: str, top: int | None) -> str:
    return (f"SELECT '{section}' AS section, CAST({label} AS VARCHAR) AS label, CAST({value} AS DOUBLE) AS value, CAST({n} AS BIGINT) AS n,"
            f" ROW_NUMBER() OVER (ORDER BY {value} DESC NULLS LAST, {label}) AS rank FROM {source}"
            + (f" QUALIFY rank <= {top}" if top else ""))


_VOLUME = "(SELECT metier, MAX(nb_offres_metier) AS n FROM rs WHERE NOT est_total GROUP BY metier)"
_TECH, _SOFT = "type_competence = 'Technologie'", "categorie_competence = 'Soft skills'"


def _citing(name: str, skills: str, where: str = "true") -> str:
    return (f"SELECT '{name}', '{name}', CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE offer_id IN (SELECT offer_id FROM links WHERE skill IN ({skills})))"
            f" / COUNT(*), COUNT(*), 1 FROM offers WHERE {where}")


_CLOUD, _GENERATIVE = "'AWS', 'Azure', 'GCP'", "'LLM', 'IA générative', 'RAG', 'LangChain', 'Hugging Face'"


@query("insights", f"""WITH {_OFFERS}, {_CATALOGUE}, {_MED}, rs AS ({_ROLE_SKILLS}), sal AS ({_SALARIES}), cities AS ({_CITIES}), sectors AS ({_SECTOR_ROWS}),
premiums AS ({_PREMIUMS}), pairs AS ({_PAIRS}), remote_rows AS ({_REMOTE_ROWS}), levels AS ({_LEVEL_ROWS}),
stack_roles AS (SELECT metier FROM {_VOLUME} ORDER BY n DESC, metier LIMIT 6),
area AS (SELECT CASE WHEN region = 'Île-de-France' THEN 'capital' WHEN region <> 'Non précisé' THEN 'regions' END AS area, salary_mid FROM offers),
am AS (SELECT area, AVG(v) FILTER (WHERE {MIDDLE}) AS m, MAX(cnt) AS n FROM {ranked('(SELECT * FROM area WHERE area IS NOT NULL)', 'area', 'salary_mid')} GROUP BY 1),
all_rows AS (
{_top('volume_by_role', _VOLUME, 'metier', 'n', 'n', None)}
UNION ALL {_top('mean_of_seniority_medians', '(SELECT metier, SUM(salaire_median * nb_offres_avec_salaire) / SUM(nb_offres_avec_salaire) AS x FROM sal GROUP BY 1)', 'metier', 'x', 'NULL', None)}
UNION ALL {_top('top_technologies', f'(SELECT * FROM rs WHERE est_total AND {_TECH})', 'competence', 'part_offres_pct', 'nb_offres', 10)}
UNION ALL {_top('top_methods', f'(SELECT * FROM rs WHERE est_total AND NOT {_TECH} AND NOT {_SOFT})', 'competence', 'part_offres_pct', 'nb_offres', 5)}
UNION ALL {_top('top_soft_skills', f'(SELECT * FROM rs WHERE est_total AND {_SOFT})', 'competence', 'part_offres_pct', 'nb_offres', 5)}
UNION ALL SELECT 'stack: ' || metier, competence, part_offres_pct, nb_offres, ROW_NUMBER() OVER (PARTITION BY metier ORDER BY nb_offres DESC, competence) AS rank
  FROM rs WHERE NOT est_total AND {_TECH} AND metier IN (SELECT metier FROM stack_roles) QUALIFY rank <= 6
UNION ALL {_top('top_premiums', 'premiums', 'competence', 'prime_eur', 'nb_offres_avec', 5)}
UNION ALL {_top('top_lifts', '(SELECT * FROM pairs WHERE nb_offres_communes >= 15)', "(competence_a || ' + ' || competence_b)", 'lift', 'nb_offres_communes', 5)}
UNION ALL {_top('top_cities', "(SELECT * FROM cities WHERE ville <> 'Non précisé')", 'ville', 'nb_offres', 'nb_offres', 5)}
UNION ALL {_top('top_sectors', 'sectors', 'secteur', 'nb_offres', 'nb_offres', 5)}
UNION ALL {_top('top_remote_roles', "(SELECT metier, ROUND(SUM(part_offres_pct), 4) AS x FROM remote_rows WHERE teletravail IN ('Hybride', 'Full remote') GROUP BY 1)", 'metier', 'x', 'NULL', 3)}
UNION ALL {_top('top_junior_roles', "(SELECT metier, ROUND(SUM(part_offres_pct), 4) AS x FROM levels WHERE seniorite IN ('Junior', 'Stage / Alternance') GROUP BY 1)", 'metier', 'x', 'NULL', 3)}
UNION ALL {_top('capital_and_regions_medians', 'am', 'area', 'm', 'n', None)}
UNION ALL SELECT 'capital_share', 'capital_share', CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE region = 'Île-de-France') / COUNT(*), COUNT(*), 1 FROM offers
UNION ALL SELECT 'remote_outside_capital', 'remote_outside_capital', CAST(100 AS DOUBLE) * SUM(remote) / COUNT(*), COUNT(*), 1 FROM offers WHERE region <> 'Île-de-France'
UNION ALL {_citing('cloud_share', _CLOUD)}
UNION ALL {_citing('cloud_share_data_engineer', _CLOUD, "role_family = 'Data Engineer'")}
UNION ALL {_citing('generative_share_data_scientist', _GENERATIVE, "role_family = 'Data Scientist'")})
SELECT section, label, {half_up('value', 4)} AS value, n, rank FROM all_rows""")
def insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = I.insights(warehouse_of(spark, sf_dir))
    return out.withColumn("value", round_half_up(F.col("value"), 4))
