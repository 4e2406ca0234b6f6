"""Raw files to exported views in a temporary folder, with invariants recomputed in pandas."""

import glob
import json
from datetime import datetime, timezone

import pandas as pd
import pytest
from pyspark.sql import Observation, functions as F

from offerscope import schemas
from offerscope.operators.filters import slice_offers
from offerscope.plans.export import read_csv
from offerscope.plans import profile, warehouse
from offerscope.plans.clean import clean_offers, typed_offers
from offerscope.plans.insights import insights
from offerscope.plans.run import run
from offerscope.plans.views import VIEWS
from offerscope.settings import Settings
from offerscope.sources.landing import as_raw, read_landing, write_landing
from offerscope.streaming import incremental

BASE = {"source": "test", "source_id": "1", "title": "Data Analyst", "description": "SQL", "company": "ACME",
        "location_raw": "Paris", "published_at": "2026-09-01", "is_demo": False}


def raw(spark, *changes):
    rows = [json.dumps(BASE | c) for c in changes]
    lines = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "n long, j string")
    parsed = lines.select("n", F.from_json("j", schemas.RAW).alias("r")).select("n", "r.*")
    return as_raw(parsed.withColumn("_n", F.col("n")), "_n")


def clean(spark, *changes, **kw):
    settings = Settings(**({"max_age_days": None} | kw))
    return clean_offers(raw(spark, *changes), settings, arrival=["_n"])


def test_clean_schema_and_values(spark):
    df = clean(spark, {"salary_raw": "45K€ - 55K€", "contract_raw": "CDI", "description": "SQL. Télétravail 2 jours par semaine."})
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.CLEAN]
    (r,) = df.collect()
    assert (r.offer_id, r.salary_mid, r.has_salary, r.remote_policy, r.city, r.contract_type) == (
        "test:1", 50000, 1, "Hybride", "Paris", "CDI")
    assert str(r.published_month) == "2026-09-01" and r.experience_years is None


def test_same_offer_from_two_sources_keeps_the_oldest(spark):
    df = clean(spark, {"source": "x", "source_id": "A", "title": "Data Analyst H/F"},
               {"source": "y", "source_id": "B", "title": "data analyst h/f", "company": "Acme", "published_at": "2026-09-03"},
               {"source": "y", "source_id": "C", "title": "Data Engineer"})
    assert sorted(r.offer_id for r in df.collect()) == ["x:A", "y:C"]


def test_latest_arrival_wins_on_equal_dates(spark):
    df = clean(spark, {"description": "first"}, {"description": "second"})
    assert [r.description for r in df.collect()] == ["second"]


def test_salaries_left_out(spark):
    df = clean(spark, {"source_id": "s", "title": "Stage Data Analyst", "salary_raw": "Mensuel de 1500 Euros"},
               {"source_id": "o", "title": "Data Analyst II", "salary_raw": "5 000 000 € par an"},
               {"source_id": "d", "title": "Data Analyst III", "salary_raw": "500 € par jour", "company": "  "})
    rows = {r.source_id: r for r in df.collect()}
    assert all(r.salary_mid is None and r.has_salary == 0 for r in rows.values()) and len(rows) == 3
    assert rows["d"].daily_rate == 500 and rows["d"].company == "Non précisé"


def test_rejected_titles_are_counted(spark):
    seen = Observation("rejected")
    rows = raw(spark, {"title": ""}, {"title": None}, {"title": "  "}, {"title": "Boulanger"}, {"title": "Professeur de data"}, {})
    df = typed_offers(rows, Settings(), rejected=seen)
    assert [r.title for r in df.collect()] == ["Data Analyst"] and seen.get["out_of_scope"] == 2


def test_age_limit_comes_before_deduplication(spark):
    changes = [{"source_id": "new"}, {"source_id": "old", "title": "Data Scientist", "published_at": "2024-01-15"},
               {"source_id": "nodate", "title": "Data Engineer", "published_at": None},
               {"source_id": "repost", "published_at": "2024-02-01"}]
    assert {r.source_id for r in clean(spark, *changes, max_age_days=365).collect()} == {"new", "nodate"}
    assert {r.source_id for r in clean(spark, *changes).collect()} == {"repost", "old", "nodate"}


CITIES = ["75 - PARIS 08", "Lyon 3e Arrondissement", "Nantes, Pays de la Loire", "79 - Niort", "France", "Hauts-de-Seine"]
TITLES = ["Data Analyst H/F", "Senior Data Engineer", "Data Scientist Junior", "Stage Data Analyst", "Consultant BI"]
BODIES = ["SQL, Python et Tableau. Télétravail possible 2 jours par semaine.", "Spark, Python, AWS. Poste en full remote.",
          "Excel, SQL et Power BI. Pas de télétravail.", "", "LLM, RAG, Python. Mode hybride."]
PAY = ["Annuel de {a}.0 Euros à {b}.0 Euros sur 12.0 mois", "Mensuel de {m} Euros sur 12 mois", None, "{d} € par jour", "{k}k€"]


def records(demo, n, source):
    for i in range(n):
        a = 30000 + 137 * i
        pay = PAY[i % 5]
        yield {"source": source, "source_id": str(i), "title": TITLES[i % 5 if i % 7 else 0], "description": BODIES[(i // 2) % 5],
               "company": f"Société {i % 90}", "location_raw": CITIES[i % 6], "contract_raw": ["CDI", "CDD", "Freelance", None][i % 4],
               "published_at": f"2026-0{1 + i % 9}-{1 + i % 27:02d}" if i % 13 else None, "is_demo": demo,
               "salary_raw": pay and pay.format(a=a, b=a + 4000, m=a // 12, d=300 + i, k=a // 1000)}


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    for source, demo, n in (("real", False, 300), ("demo", True, 60)):
        folder = root / "raw" / source
        folder.mkdir(parents=True)
        (folder / f"{source}_20260901_000000.jsonl").write_text(
            "\n\n".join(json.dumps(r, ensure_ascii=False) for r in records(demo, n, source)), encoding="utf-8")
    summary = run(spark, str(root / "raw"), str(root / "warehouse"), str(root / "exports"))
    return root, summary


def exported(root, name):
    parts = glob.glob(f"{root}/exports/{name}.csv/part-*.csv")
    return pd.concat([pd.read_csv(p) for p in parts])


def test_run_summary(spark, done):
    root, summary = done
    assert summary.dataset_label == "réel" and summary.n_raw == 300
    assert set(summary.exports) == set(VIEWS) and len(VIEWS) == 14
    for name, rows in summary.exports.items():
        assert len(exported(root, name)) == rows
    (log,) = spark.read.parquet(f"{root}/warehouse/pipeline_runs").collect()
    assert (log.dataset_label, log.n_raw, log.n_offers, log.n_offer_skills) == (
        "réel", 300, summary.n_offers, summary.n_offer_skills)


def test_exports_agree_with_pandas(done):
    root, summary = done
    offers, kpi = exported(root, "offres"), exported(root, "kpi_globaux").iloc[0]
    assert offers["id_offre"].is_unique and "description" not in offers.columns and offers["est_demo"].eq(0).all()
    pd.to_datetime(offers["date_publication"].dropna(), format="%Y-%m-%d")
    assert kpi["nb_offres"] == len(offers) == summary.n_offers
    assert kpi["salaire_median"] == pytest.approx(offers["salaire_annuel"].median(), abs=0.51)
    assert kpi["salaire_moyen"] == pytest.approx(offers["salaire_annuel"].mean(), abs=0.51)
    assert kpi["pct_offres_avec_competence"] == pytest.approx(100 * (offers["nb_competences"] > 0).mean(), abs=0.051)
    assert kpi["jeu_de_donnees"] == "Réel"

    pay = exported(root, "salaires_metier_seniorite").set_index(["metier", "seniorite"])
    want = offers.dropna(subset=["salaire_annuel"]).groupby(["metier", "seniorite"])["salaire_annuel"].median()
    assert pay["salaire_median"].sort_index().values == pytest.approx(want.sort_index().values, abs=0.51)
    assert (pay["salaire_q1"] <= pay["salaire_median"] + 0.51).all() and (pay["salaire_median"] <= pay["salaire_q3"] + 0.51).all()

    links = exported(root, "offres_competences")
    assert links["id_offre"].isin(offers["id_offre"]).all() and not links.duplicated(["id_offre", "competence"]).any()
    assert len(links) == summary.n_offer_skills == offers["nb_competences"].sum()
    shares = exported(root, "competences_par_metier")
    assert shares["part_offres_pct"].between(0, 100).all() and "Tous métiers" in set(shares["metier"])
    assert shares[shares["est_total"]]["nb_offres"].sum() == len(links) == shares[~shares["est_total"]]["nb_offres"].sum()
    pairs = exported(root, "paires_competences")
    assert (pairs["competence_a"] < pairs["competence_b"]).all() and (pairs["nb_offres_communes"] >= 5).all()
    premium = exported(root, "prime_salariale_competences")
    assert len(premium) and (premium["nb_offres_avec"] >= 10).all()
    for name in ("villes", "secteurs", "contrats", "seniorite_metier", "teletravail_metier"):
        assert exported(root, name)["nb_offres"].sum() == len(offers)


def test_views_are_readable_with_sql(spark, done):
    _, summary = done
    assert spark.sql("SELECT COUNT(*) AS n FROM v_offres").first().n == summary.n_offers
    assert spark.table("v_secteurs").columns[0] == "secteur"


def test_constraints_hold_and_violations_show(spark, done):
    root, _ = done
    w = warehouse.load(spark, f"{root}/warehouse")
    report = warehouse.constraints(w).collect()
    assert len(report) > 25 and all(r.violations == 0 for r in report)
    broken = warehouse.Warehouse(w.offers.union(w.offers.limit(1)).withColumn("is_demo", F.lit(2)), w.skills.where("skill <> 'SQL'"),
                                 w.offer_skills, w.top_terms)
    bad = {(r.table, r.rule) for r in warehouse.constraints(broken).collect() if r.violations}
    assert bad == {("offers", "primary key (offer_id)"), ("offers", "is_demo in (0, 1)"), ("offer_skills", "foreign key (skill)")}


def test_profile_and_insights(spark, done):
    root, summary = done
    w = warehouse.load(spark, f"{root}/warehouse")
    rates = {r.indicator: r.part_pct for r in profile.quality(w).collect()}
    assert set(rates) == set(profile.INDICATORS.values()) and rates["Métier = Autre métier data"] == 0
    sample = profile.review_sample(w).collect()
    assert len(sample) == 15 and any("," in r.skills for r in sample)
    assert sum(r.n for r in profile.role_volume(w).collect()) == summary.n_offers
    assert sum(r.n for r in profile.salary_histogram(w).collect()) <= summary.n_offers
    assert {r.role_family for r in profile.remote_crosstab(w).collect()} == {r.role_family for r in profile.junior_share(w).collect()}
    box = profile.salary_box(w).first()
    assert box.low <= box.q1 <= box.median <= box.q3 <= box.high
    assert profile.salary_matrix(w).count() >= 1 and profile.monthly_volume(w).count() == 9
    assert profile.unclassified_titles(w).count() == 0 and profile.cities_without_region(w).count() == 0
    heat = profile.skill_heatmap(VIEWS["competences_par_metier"](w))
    assert heat.count() <= 12 and heat.columns[:2] == ["competence", "rank"]
    sections = {r.section for r in insights(w).collect()}
    assert {"volume_by_role", "top_technologies", "top_premiums", "capital_share", "cloud_share"} <= sections
    paris = slice_offers(w.offers, regions=["Île-de-France"], categories=["Cloud"], links=w.offer_skills, skills=w.skills)
    assert 0 < paris.count() < summary.n_offers


def test_reload_replaces_tables_and_keeps_the_log(spark, done):
    root, summary = done
    again = run(spark, f"{root}/raw", f"{root}/warehouse")
    assert (again.n_offers, again.n_offer_skills) == (summary.n_offers, summary.n_offer_skills)
    assert warehouse.load(spark, f"{root}/warehouse").offers.count() == summary.n_offers
    assert spark.read.parquet(f"{root}/warehouse/published").count() == spark.read.parquet(f"{root}/warehouse/pipeline_runs").count() == 2


def test_a_load_that_breaks_a_rule_leaves_the_former_one(spark, done):
    root, summary = done
    former = warehouse.load(spark, f"{root}/warehouse").offers
    clean = former.drop("skills_count")
    with pytest.raises(ValueError, match=r"primary key \(offer_id\)"):
        warehouse.store(clean.union(clean.limit(1)), f"{root}/warehouse")
    again = warehouse.load(spark, f"{root}/warehouse").offers
    assert again.count() == summary.n_offers and again.exceptAll(former).isEmpty()
    with pytest.raises(ValueError, match="nothing is published"):
        warehouse.load(spark, f"{root}/elsewhere")


def test_lines_that_are_no_records_go_to_quarantine(spark, tmp_path):
    folder = tmp_path / "raw" / "real"
    folder.mkdir(parents=True)
    lines = [json.dumps(r) for r in records(False, 40, "real")]
    (folder / "real_20260901_080000.jsonl").write_text("\n".join([*lines[:20], "{broken", '{"title": "Data Analyst", "salary_min_raw": "x"}', *lines[20:]]))
    with pytest.raises(Exception):
        run(spark, str(tmp_path / "raw"), str(tmp_path / "strict"))
    got = run(spark, str(tmp_path / "raw"), str(tmp_path / "lenient"), quarantine_dir=str(tmp_path / "quarantine"),
              processed_dir=str(tmp_path / "processed"))
    assert (got.n_bad_lines, got.n_raw) == (2, 40)
    kept = spark.read.json(str(tmp_path / "quarantine")).collect()
    assert sorted(r["line"] for r in kept) == sorted(["{broken", '{"title": "Data Analyst", "salary_min_raw": "x"}'])
    assert {r["file_name"] for r in kept} == {"real_20260901_080000.jsonl"}
    back = read_csv(spark, str(tmp_path / "processed" / "offers.csv"), schemas.OFFERS)
    assert back.count() == got.n_offers > 0


def test_empty_landing_zone_is_an_error(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    with pytest.raises(ValueError):
        run(spark, str(tmp_path / "raw"), str(tmp_path / "w"))


def test_bad_lines_alone_are_kept_and_no_load(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.jsonl").write_text("no record\n{broken\n")
    with pytest.raises(ValueError, match="no raw records"):
        run(spark, str(tmp_path / "raw"), str(tmp_path / "w"), quarantine_dir=str(tmp_path / "q"))
    assert spark.read.json(str(tmp_path / "q")).count() == 2


def test_incremental_equals_batch(spark, tmp_path):
    landing, staging, marks = (str(tmp_path / n) for n in ("raw", "staging", "marks"))
    rows = spark.createDataFrame([json.dumps(r) for r in records(False, 120, "real")], "string")
    rows = rows.select(F.from_json("value", schemas.RAW).alias("r")).select("r.*")
    for part in (0, 1):
        stamp = datetime(2026, 9, 1 + part, tzinfo=timezone.utc)
        write_landing(rows.where(F.col("source_id").cast("int") % 3 != part), landing, stamp)
        incremental.start(spark, landing, staging, marks).awaitTermination()
    streamed = incremental.unique_staged(spark, staging)
    batch = clean_offers(read_landing(spark, landing))
    assert streamed.count() == batch.count() > 50
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
