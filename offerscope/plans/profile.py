"""Data-quality profile and the queries behind the exploration charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from offerscope.functions.labels import flag
from offerscope.functions.text import percent
from offerscope.operators.groups import crosstab, fixed_bins, seeded_sample, top_n, value_counts
from offerscope.operators.quantiles import BOX, Quantile, quantiles
from offerscope.plans.warehouse import Warehouse
from offerscope.vocab import labels as V

# Indicator -> label of the quality profile.
INDICATORS = {
    "role": "Métier = Autre métier data",
    "seniority": "Séniorité non précisée",
    "contract": "Contrat non précisé",
    "remote": "Télétravail non précisé",
    "city": "Ville non précisée",
    "region": "Région non reconnue",
    "sector": "Secteur non reconnu",
    "salary": "Sans salaire exploitable",
    "skills": "Sans aucune compétence détectée",
}
LEVELS = ("Junior", "Confirmé", "Senior")
REMOTE_CATEGORIES = ("Full remote", "Hybride", "Sur site", V.UNKNOWN)


def rates(df: DataFrame, conditions: dict) -> DataFrame:
    """(indicator, part_pct): percentage of rows meeting each condition, in one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("_all"),
                     *[F.count_if(c).alias(f"_{i}") for i, c in enumerate(conditions.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("indicator"), F.col(f"_{i}").alias("hits"))
                     for i, name in enumerate(conditions)])
    long = counted.select("_all", F.explode(rows).alias("r"))
    return long.select("r.indicator", percent(F.col("r.hits"), F.col("_all")).alias("part_pct"))


def quality(w: Warehouse) -> DataFrame:
    c = F.col
    return rates(w.offers, {
        INDICATORS["role"]: c("role_family") == V.OTHER_ROLE,
        INDICATORS["seniority"]: c("seniority") == V.UNKNOWN,
        INDICATORS["contract"]: c("contract_type") == V.UNKNOWN,
        INDICATORS["remote"]: c("remote_policy") == V.UNKNOWN,
        INDICATORS["city"]: c("city") == V.UNKNOWN,
        INDICATORS["region"]: c("region") == V.UNKNOWN,
        INDICATORS["sector"]: c("sector") == V.OTHER_SECTOR,
        INDICATORS["salary"]: c("has_salary") == 0,
        INDICATORS["skills"]: c("skills_count") == 0,
    })


def unclassified_titles(w: Warehouse, n: int = 20) -> DataFrame:
    return value_counts(w.offers.where(F.col("role_family") == V.OTHER_ROLE), "title", n)


def cities_without_region(w: Warehouse, n: int = 20) -> DataFrame:
    return value_counts(w.offers.where((F.col("region") == V.UNKNOWN) & (F.col("city") != V.UNKNOWN)), "city", n)


def review_sample(w: Warehouse, n: int = 15, seed: int = 0) -> DataFrame:
    """A repeatable handful of offers with their sorted skill list, to compare with the text by hand."""
    drawn = seeded_sample(w.offers, "offer_id", n, seed)
    cited = w.offer_skills.join(F.broadcast(drawn.select("offer_id")), "offer_id", "left_semi")
    listed = cited.groupBy("offer_id").agg(F.array_join(F.array_sort(F.collect_set("skill")), ", ").alias("skills"))
    return drawn.join(listed, "offer_id", "left").select(
        "offer_id", "title", "role_family", "seniority", F.coalesce("skills", F.lit("—")).alias("skills"),
        "description")


def role_volume(w: Warehouse) -> DataFrame:
    return value_counts(w.offers, "role_family")


def monthly_volume(w: Warehouse) -> DataFrame:
    return value_counts(w.offers, "published_month")


def salary_histogram(w: Warehouse) -> DataFrame:
    return fixed_bins(w.offers, "salary_mid", 20000.0, 100000.0, 5000.0)


def salary_box(w: Warehouse) -> DataFrame:
    """Spread per role: interpolated quartiles, minimum, maximum."""
    ends = w.offers.where(F.col("salary_mid").isNotNull()).groupBy("role_family").agg(
        F.min("salary_mid").alias("low"), F.max("salary_mid").alias("high"))
    box = quantiles(w.offers, ["role_family"], "salary_mid", BOX)
    return box.join(ends, "role_family")


def median_matrix(offers: DataFrame, row: str, column: str, columns: Sequence[str], value: str, minimum: int = 5) -> DataFrame:
    """One line per ``row`` with the median and the size of each column; medians of small cells are hidden.

    ``row_mean`` (mean of the shown medians) orders the lines of a heat map.
    """
    wanted = offers.where(F.col(column).isin(*columns))
    cells = quantiles(wanted, [row, column], value, [Quantile("m")])
    shown = F.when(F.col("n") >= minimum, F.col("m"))
    matrix = cells.groupBy(row).pivot(column, list(columns)).agg(F.max(shown).alias("median"), F.max("n").alias("n"))
    medians = [F.col(f"`{c}_median`") for c in columns]
    filled = F.filter(F.array(*medians), lambda v: v.isNotNull())
    mean = F.when(F.size(filled) > 0, F.aggregate(filled, F.lit(0.0), lambda a, v: a + v) / F.size(filled))
    return matrix.withColumn("row_mean", mean)


def salary_matrix(w: Warehouse) -> DataFrame:
    return median_matrix(w.offers, "role_family", "seniority", LEVELS, "salary_mid")


def skill_heatmap(skills_by_role: DataFrame, n: int = 12) -> DataFrame:
    """Share of each role's offers citing the ``n`` most cited technologies; a role not citing one shows 0."""
    tech = F.col("type_competence") == V.SKILL_KIND_LABELS["tech"]
    best = top_n(skills_by_role.where(F.col("est_total") & tech), [F.desc("part_offres_pct"), F.asc("competence")], n)
    best = best.select("competence", "rank")
    roles = [label for label, _ in V.ROLE_RULES] + [V.OTHER_ROLE]
    cells = skills_by_role.where(~F.col("est_total")).join(F.broadcast(best), "competence")
    return cells.groupBy("competence", "rank").pivot("metier", roles).agg(F.max("part_offres_pct")).na.fill(0.0)


def remote_crosstab(w: Warehouse) -> DataFrame:
    return crosstab(w.offers, "role_family", "remote_policy", REMOTE_CATEGORIES)


def junior_share(w: Warehouse) -> DataFrame:
    junior = flag(F.col("seniority").isin(*V.JUNIOR_LEVELS))
    return w.offers.groupBy("role_family").agg(percent(F.sum(junior), F.count(junior), 4).alias("junior_pct"))
