"""The analytical views over the warehouse tables. Column names are those of the exported files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from offerscope.functions.labels import flag, seniority_order, skill_kind_label
from offerscope.functions.text import percent, round_half_up
from offerscope.operators.groups import rank_within, share_within, with_grand_total
from offerscope.operators.pairs import pair_lift
from offerscope.operators.premium import premium
from offerscope.operators.quantiles import QUARTILES_NEAREST, Quantile, quantiles
from offerscope.plans.warehouse import Warehouse
from offerscope.vocab import labels as V



def remote_flag() -> Column:
    return flag(F.col("remote_policy").isin(*V.REMOTE_POSSIBLE))


def permanent_flag() -> Column:
    return flag(F.col("contract_type") == V.PERMANENT)


def share_of(condition_flag: Column) -> Column:
    """Percentage of rows whose 0/1 flag is set."""
    return percent(F.sum(condition_flag), F.count(condition_flag))


def offres(w: Warehouse) -> DataFrame:
    c = F.col
    return w.offers.select(
        c("offer_id").alias("id_offre"), "source", c("is_demo").alias("est_demo"), c("title").alias("intitule"),
        c("role_family").alias("metier"), c("seniority").alias("seniorite"),
        c("experience_years").alias("annees_experience"), c("contract_type").alias("type_contrat"),
        c("company").alias("entreprise"), c("sector").alias("secteur"), c("city").alias("ville"),
        c("department_code").alias("departement"), "region", F.lit(V.COUNTRY).alias("pays"), "latitude", "longitude",
        c("remote_policy").alias("teletravail"), remote_flag().alias("teletravail_possible"),
        c("salary_min").alias("salaire_min"), c("salary_max").alias("salaire_max"),
        c("salary_mid").alias("salaire_annuel"), c("has_salary").alias("salaire_affiche"), c("daily_rate").alias("tjm"),
        permanent_flag().alias("est_cdi"), c("published_date").alias("date_publication"),
        c("published_month").alias("mois_publication"), c("skills_count").alias("nb_competences"), "url")


def offres_competences(w: Warehouse) -> DataFrame:
    return w.offer_skills.join(w.skills, "skill").select(
        F.col("offer_id").alias("id_offre"), F.col("skill").alias("competence"),
        F.col("category").alias("categorie_competence"), skill_kind_label(F.col("skill_type")).alias("type_competence"))


def kpi_globaux(w: Warehouse) -> DataFrame:
    o = w.offers
    middle = quantiles(o, [], "salary_mid", [Quantile("m")]).select("m").scalar()
    known_city = F.when(F.col("city") != V.UNKNOWN, F.col("city"))
    demo, real = V.DATASET_LABELS["demo"], V.DATASET_LABELS["real"]
    out = o.agg(
        F.count(F.lit(1)).alias("nb_offres"),
        F.count_distinct("company").alias("nb_entreprises"),
        F.count_distinct(known_city).alias("nb_villes"),
        round_half_up(F.avg("salary_mid"), 0).alias("salaire_moyen"),
        percent(F.sum("has_salary"), F.count("has_salary")).alias("pct_offres_avec_salaire"),
        share_of(remote_flag()).alias("pct_teletravail"),
        share_of(permanent_flag()).alias("pct_cdi"),
        share_of(flag(F.col("seniority").isin(*V.JUNIOR_LEVELS))).alias("pct_offres_junior"),
        round_half_up(F.avg("skills_count"), 1).alias("nb_competences_moyen"),
        share_of(flag(F.col("skills_count") > 0)).alias("pct_offres_avec_competence"),
        F.min("published_date").alias("date_min"), F.max("published_date").alias("date_max"),
        F.when(F.max("is_demo") == 1, F.lit(demo)).otherwise(F.lit(real)).alias("jeu_de_donnees"))
    out = out.withColumn("salaire_median", round_half_up(middle, 0))
    return out.select("nb_offres", "nb_entreprises", "nb_villes", "salaire_moyen", "salaire_median",
                      *out.columns[4:-1])


def salaires_metier_seniorite(w: Warehouse) -> DataFrame:
    keys = ["role_family", "seniority"]
    ranks = quantiles(w.offers, keys, "salary_mid", QUARTILES_NEAREST)
    moments = w.offers.where(F.col("salary_mid").isNotNull()).groupBy(*keys).agg(
        F.avg("salary_mid").alias("mean"), F.min("salary_mid").alias("low"), F.max("salary_mid").alias("high"))
    n = F.col("n")
    band = F.when(n >= 30, F.lit("Bonne")).when(n >= 10, F.lit("Moyenne")).otherwise(F.lit("Faible (< 10 offres)"))
    return moments.join(ranks, keys).select(
        F.col("role_family").alias("metier"), F.col("seniority").alias("seniorite"),
        n.alias("nb_offres_avec_salaire"), round_half_up(F.col("mean"), 0).alias("salaire_moyen"),
        round_half_up(F.col("median"), 0).alias("salaire_median"), F.col("q1").alias("salaire_q1"),
        F.col("q3").alias("salaire_q3"), F.col("low").alias("salaire_min"), F.col("high").alias("salaire_max"),
        band.alias("fiabilite"))


def villes(w: Warehouse, median_by_region: bool = False) -> DataFrame:
    """City summary. The salary median is taken per city name, so it repeats on every region of a city
    (the unknown city above all); ``median_by_region`` takes it per (city, region) instead."""
    keys = ["city", "region"]
    grain = keys if median_by_region else ["city"]
    total = w.offers.agg(F.count(F.lit(1)).alias("n")).scalar()
    middle = quantiles(w.offers, grain, "salary_mid", [Quantile("m")])
    cities = w.offers.groupBy(*keys).agg(
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"),
        F.count(F.lit(1)).alias("nb_offres"), share_of(remote_flag()).alias("pct_teletravail"))
    return cities.join(middle, grain, "left").select(
        F.col("city").alias("ville"), "region", F.lit(V.COUNTRY).alias("pays"), "latitude", "longitude", "nb_offres",
        percent(F.col("nb_offres"), total, 2).alias("part_offres_pct"),
        round_half_up(F.col("m"), 0).alias("salaire_median"),
        F.coalesce(F.col("n"), F.lit(0)).alias("nb_offres_avec_salaire"), "pct_teletravail")


def secteurs(w: Warehouse) -> DataFrame:
    total = w.offers.agg(F.count(F.lit(1)).alias("n")).scalar()
    middle = quantiles(w.offers, ["sector"], "salary_mid", [Quantile("m")])
    sectors = w.offers.groupBy("sector").agg(
        F.count(F.lit(1)).alias("nb_offres"), share_of(remote_flag()).alias("pct_teletravail"),
        share_of(permanent_flag()).alias("pct_cdi"))
    return sectors.join(middle, "sector", "left").select(
        F.col("sector").alias("secteur"), "nb_offres", percent(F.col("nb_offres"), total, 2).alias("part_offres_pct"),
        round_half_up(F.col("m"), 0).alias("salaire_median"), "pct_teletravail", "pct_cdi")


def competences_par_metier(w: Warehouse) -> DataFrame:
    """Share of each role's offers citing a skill. Rows with ``est_total`` repeat all offers: never add them up."""
    cited = w.offer_skills.join(w.offers.select("offer_id", "role_family"), "offer_id")
    counts = with_grand_total(cited, "role_family", ["skill"], V.ALL_ROLES, F.count(F.lit(1)), "n")
    bases = with_grand_total(w.offers, "role_family", [], V.ALL_ROLES, F.count(F.lit(1)), "base")
    out = counts.join(bases, ["role_family", "is_total"]).join(w.skills, "skill")
    out = out.withColumn("rang", F.rank().over(
        Window.partitionBy("role_family", "is_total").orderBy(F.desc("n"))))
    return out.select(
        F.col("role_family").alias("metier"), F.col("skill").alias("competence"),
        F.col("category").alias("categorie_competence"), skill_kind_label(F.col("skill_type")).alias("type_competence"),
        F.col("n").alias("nb_offres"), F.col("base").alias("nb_offres_metier"),
        percent(F.col("n"), F.col("base")).alias("part_offres_pct"), "rang", F.col("is_total").alias("est_total"))


def prime_salariale_competences(w: Warehouse) -> DataFrame:
    """Salary median of the offers citing a skill against the others: a description, no causal effect."""
    out = premium(w.offers, w.offer_skills, "offer_id", "skill", "salary_mid", minimum=10).join(w.skills, "skill")
    band = F.when(F.col("n_with") >= 20, F.lit("Moyenne")).otherwise(F.lit("Faible (10 à 19 offres)"))
    return out.select(
        F.col("skill").alias("competence"), F.col("category").alias("categorie_competence"),
        F.col("n_with").alias("nb_offres_avec"), F.col("n_without").alias("nb_offres_sans"),
        F.col("median_with").alias("salaire_median_avec"), F.col("median_without").alias("salaire_median_sans"),
        F.col("premium").alias("prime_eur"), F.col("premium_pct").alias("prime_pct"), band.alias("fiabilite"))


def paires_competences(w: Warehouse) -> DataFrame:
    total = w.offers.agg(F.count(F.lit(1)).alias("n")).scalar()
    return pair_lift(w.offer_skills, "offer_id", "skill", total, minimum=5).select(
        F.col("item_a").alias("competence_a"), F.col("item_b").alias("competence_b"),
        F.col("n").alias("nb_offres_communes"), F.col("pct_a_with_b").alias("pct_offres_a_avec_b"), "lift")


def tendance_mensuelle(w: Warehouse) -> DataFrame:
    dated = w.offers.where(F.col("published_month").isNotNull())
    return dated.groupBy(F.col("published_month").alias("mois"), F.col("role_family").alias("metier")).agg(
        F.count(F.lit(1)).alias("nb_offres"), round_half_up(F.avg("salary_mid"), 0).alias("salaire_moyen"),
        F.sum(remote_flag()).alias("nb_offres_teletravail"))


def teletravail_metier(w: Warehouse) -> DataFrame:
    shares = share_within(w.offers, ["role_family"], "remote_policy", "nb_offres", "part_offres_pct")
    return shares.withColumnsRenamed({"role_family": "metier", "remote_policy": "teletravail"})


def seniorite_metier(w: Warehouse) -> DataFrame:
    shares = share_within(w.offers, ["role_family"], "seniority", "nb_offres", "part_offres_pct")
    return shares.select(
        F.col("role_family").alias("metier"), F.col("seniority").alias("seniorite"),
        seniority_order(F.col("seniority")).alias("ordre_seniorite"), "nb_offres", "part_offres_pct")


def contrats(w: Warehouse) -> DataFrame:
    return w.offers.groupBy(F.col("contract_type").alias("type_contrat"), F.col("role_family").alias("metier")).agg(
        F.count(F.lit(1)).alias("nb_offres"), round_half_up(F.avg("daily_rate"), 0).alias("tjm_moyen"))


def termes_tfidf(w: Warehouse) -> DataFrame:
    return w.top_terms.select(F.col("role_family").alias("metier"), F.col("term").alias("terme"),
                              F.col("tfidf_score").alias("score_tfidf"), F.col("rank").alias("rang"))


VIEWS: dict[str, Callable[[Warehouse], DataFrame]] = {
    view.__name__: view for view in (
        offres, offres_competences, kpi_globaux, salaires_metier_seniorite, villes, secteurs, competences_par_metier,
        prime_salariale_competences, paires_competences, tendance_mensuelle, teletravail_metier, seniorite_metier,
        contrats, termes_tfidf)
}
# Views at the grain of the facts keep one file per partition; the others are bounded by closed vocabularies.
FACT_VIEWS = ("offres", "offres_competences", "villes")


def register(w: Warehouse) -> None:
    """Makes every view readable with SQL as ``v_<name>``."""
    for name, view in VIEWS.items():
        view(w).createOrReplaceTempView(f"v_{name}")
