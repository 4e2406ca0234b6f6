"""Figures of the written report as one long table ``(section, label, rank, value, n)``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from offerscope.operators.groups import top_n_per_group, weighted_mean
from offerscope.operators.quantiles import Quantile, quantiles
from offerscope.plans import views
from offerscope.plans.views import remote_flag
from offerscope.plans.warehouse import Warehouse
from offerscope.vocab import labels as V


def _section(df: DataFrame, section: str, label: str | Column, value: str, n: str | None = None,
             top: int | None = None, tie: str = "label") -> DataFrame:
    """Rows of one section ranked by value; ties go by label. The inputs are aggregates of bounded size."""
    text = F.col(label) if isinstance(label, str) else label
    rows = df.select(F.lit(section).alias("section"), text.cast("string").alias("label"),
                     F.col(value).cast("double").alias("value"),
                     (F.col(n) if n else F.lit(None)).cast("long").alias("n"))
    order = [F.desc_nulls_last("value"), F.asc(tie)]
    if top is not None:
        return top_n_per_group(rows, ["section"], order, top)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("section").orderBy(*order)))


def volume_by_role(w: Warehouse) -> DataFrame:
    """Offers per role among the roles with at least one detected skill."""
    skills = views.competences_par_metier(w).where(~F.col("est_total"))
    return skills.groupBy("metier").agg(F.max("nb_offres_metier").alias("n"))


def mean_of_medians_by_role(w: Warehouse) -> DataFrame:
    """Mean of the seniority medians weighted by salaried offers (not the median of the role)."""
    return weighted_mean(views.salaires_metier_seniorite(w), ["metier"], "salaire_median", "nb_offres_avec_salaire",
                         "value")


def share_sum(shares: DataFrame, column: str, wanted: Sequence[str]) -> DataFrame:
    return shares.where(F.col(column).isin(*wanted)).groupBy("metier").agg(
        F.round(F.sum(F.col("part_offres_pct").cast("decimal(12,4)")), 4).cast("double").alias("value"))


def capital_share(w: Warehouse) -> DataFrame:
    inside = F.count_if(F.col("region") == V.CAPITAL_REGION).cast("double")
    return w.offers.agg((100.0 * F.try_divide(inside, F.count(F.lit(1)))).alias("value"),
                        F.count(F.lit(1)).alias("n"))


def capital_medians(w: Warehouse) -> DataFrame:
    """Salary medians of the capital region and of the other known regions."""
    area = F.when(F.col("region") == V.CAPITAL_REGION, F.lit("capital")) \
            .when(F.col("region") != V.UNKNOWN, F.lit("regions"))
    located = w.offers.withColumn("area", area).where(F.col("area").isNotNull())
    return quantiles(located, ["area"], "salary_mid", [Quantile("value")])


def remote_outside_capital(w: Warehouse) -> DataFrame:
    """Remote share of all offers outside the capital region, unknown regions included."""
    outside = w.offers.where(F.col("region") != V.CAPITAL_REGION)
    return outside.agg((100.0 * F.avg(remote_flag())).alias("value"), F.count(F.lit(1)).alias("n"))


def share_citing(w: Warehouse, skills: Sequence[str], role: str | None = None) -> DataFrame:
    """Share of offers (of a role) that cite any of ``skills``."""
    offers = w.offers if role is None else w.offers.where(F.col("role_family") == role)
    citing = w.offer_skills.where(F.col("skill").isin(*skills)).select("offer_id").distinct()
    citing = citing.withColumn("_hit", F.lit(1.0))
    joined = offers.select("offer_id").join(citing, "offer_id", "left")
    return joined.agg((100.0 * F.coalesce(F.avg(F.coalesce("_hit", F.lit(0.0))), F.lit(0.0))).alias("value"),
                      F.count(F.lit(1)).alias("n"))


def insights(w: Warehouse) -> DataFrame:
    """All report figures; the ranks restart in each section."""
    skills = views.competences_par_metier(w)
    total, by_role = skills.where("est_total"), skills.where(~F.col("est_total"))
    tech = F.col("type_competence") == V.SKILL_KIND_LABELS["tech"]
    soft = F.col("categorie_competence") == "Soft skills"
    cities, pairs = views.villes(w), views.paires_competences(w)
    stack_roles = _section(volume_by_role(w), "stack", "metier", "n", top=6).select(F.col("label").alias("metier"))
    stack = top_n_per_group(by_role.where(tech).join(stack_roles, "metier"), ["metier"],
                            [F.desc("nb_offres"), F.asc("competence")], 6)

    one = lambda df, name: _section(df, name, F.lit(name), "value", "n")
    parts = [
        _section(volume_by_role(w), "volume_by_role", "metier", "n", "n"),
        _section(mean_of_medians_by_role(w), "mean_of_seniority_medians", "metier", "value"),
        _section(total.where(tech), "top_technologies", "competence", "part_offres_pct", "nb_offres", 10),
        _section(total.where(~tech & ~soft), "top_methods", "competence", "part_offres_pct", "nb_offres", 5),
        _section(total.where(soft), "top_soft_skills", "competence", "part_offres_pct", "nb_offres", 5),
        stack.select(F.concat(F.lit("stack: "), "metier").alias("section"), F.col("competence").alias("label"),
                     F.col("part_offres_pct").alias("value"), F.col("nb_offres").alias("n"), "rank"),
        _section(views.prime_salariale_competences(w), "top_premiums", "competence", "prime_eur", "nb_offres_avec", 5),
        _section(pairs.where(F.col("nb_offres_communes") >= 15), "top_lifts",
                 F.concat_ws(" + ", "competence_a", "competence_b"), "lift", "nb_offres_communes", 5),
        _section(cities.where(F.col("ville") != V.UNKNOWN), "top_cities", "ville", "nb_offres", "nb_offres", 5),
        _section(views.secteurs(w), "top_sectors", "secteur", "nb_offres", "nb_offres", 5),
        _section(share_sum(views.teletravail_metier(w), "teletravail", V.REMOTE_POSSIBLE), "top_remote_roles",
                 "metier", "value", top=3),
        _section(share_sum(views.seniorite_metier(w), "seniorite", V.JUNIOR_LEVELS), "top_junior_roles", "metier",
                 "value", top=3),
        _section(capital_medians(w), "capital_and_regions_medians", "area", "value", "n"),
        one(capital_share(w), "capital_share"),
        one(remote_outside_capital(w), "remote_outside_capital"),
        one(share_citing(w, V.CLOUD_SKILLS), "cloud_share"),
        one(share_citing(w, V.CLOUD_SKILLS, "Data Engineer"), "cloud_share_data_engineer"),
        one(share_citing(w, V.GENERATIVE_SKILLS, "Data Scientist"), "generative_share_data_scientist"),
    ]
    return reduce(DataFrame.unionByName, parts)
