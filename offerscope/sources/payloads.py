"""Search payloads of the two job interfaces -> raw records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from offerscope import schemas
from offerscope.functions.text import blank_to_null, strip
from offerscope.sources.landing import as_raw


def place_text(display_name: Column, area: Column) -> Column:
    """Display name, then the area hierarchy from the most to the least precise without the country.

    Names are split at commas; each is kept once, whatever its case.
    """
    chunks = F.concat(F.array(F.coalesce(display_name, F.lit(""))),
                      F.coalesce(F.reverse(F.slice(area, 2, 1 << 30)), F.array().cast("array<string>")))
    names = F.filter(F.transform(F.flatten(F.transform(chunks, lambda c: F.split(c, ","))), strip),
                     lambda p: p != "")
    keys = F.transform(names, F.lower)
    first = F.filter(names, lambda p, i: F.array_position(keys, F.lower(p)) == i + 1)
    return blank_to_null(F.array_join(first, ", "))


def aggregator_offers(items: DataFrame, keyword: Column | None = None, item: str = "item") -> DataFrame:
    """Rows of one aggregator result each (struct column ``item``). Predicted salaries are dropped."""
    c = F.col(item)
    stated = F.coalesce(c["salary_is_predicted"], F.lit("0")) != "1"
    rows = items.select(
        F.lit("adzuna").alias("source"), c["id"].alias("source_id"),
        F.coalesce(c["title"], F.lit("")).alias("title"),
        F.coalesce(c["description"], F.lit("")).alias("description"),
        c["company"]["display_name"].alias("company"),
        place_text(c["location"]["display_name"], c["location"]["area"]).alias("location_raw"),
        c["created"].alias("published_at"),
        blank_to_null(F.concat_ws(" ", blank_to_null(c["contract_type"]), blank_to_null(c["contract_time"])))
        .alias("contract_raw"),
        F.when(stated, c["salary_min"]).alias("salary_min_raw"),
        F.when(stated, c["salary_max"]).alias("salary_max_raw"),
        F.when(stated, F.lit("year")).alias("salary_unit_raw"),
        c["category"]["label"].alias("sector_raw"), c["redirect_url"].alias("url"),
        c["latitude"].alias("latitude"), c["longitude"].alias("longitude"),
        (F.lit(None) if keyword is None else keyword).cast("string").alias("search_keyword"),
        F.lit(False).alias("is_demo"))
    return as_raw(rows)


def employment_offers(items: DataFrame, keyword: Column | None = None, item: str = "item") -> DataFrame:
    """Rows of one public-employment result each; structured skills join the description."""
    c = F.col(item)
    skills = F.transform(c["competences"], lambda s: F.coalesce(s["libelle"], F.lit("")))
    text = F.coalesce(c["description"], F.lit(""))
    rows = items.select(
        F.lit("france_travail").alias("source"), c["id"].alias("source_id"),
        F.coalesce(c["intitule"], F.lit("")).alias("title"),
        F.when(F.size(c["competences"]) > 0, F.concat(text, F.lit("\nCompétences : "), F.array_join(skills, ", ")))
        .otherwise(text).alias("description"),
        c["entreprise"]["nom"].alias("company"), c["lieuTravail"]["libelle"].alias("location_raw"),
        c["dateCreation"].alias("published_at"),
        F.coalesce(blank_to_null(c["typeContratLibelle"]), c["typeContrat"]).alias("contract_raw"),
        F.coalesce(blank_to_null(c["salaire"]["libelle"]), c["salaire"]["commentaire"]).alias("salary_raw"),
        c["experienceLibelle"].alias("experience_raw"), c["secteurActiviteLibelle"].alias("sector_raw"),
        c["origineOffre"]["urlOrigine"].alias("url"),
        c["lieuTravail"]["latitude"].alias("latitude"), c["lieuTravail"]["longitude"].alias("longitude"),
        (F.lit(None) if keyword is None else keyword).cast("string").alias("search_keyword"),
        F.lit(False).alias("is_demo"))
    return as_raw(rows)


def read_aggregator(spark: SparkSession, path: str, keyword: str | None = None) -> DataFrame:
    """Landed response pages of the aggregator, one JSON document per file."""
    pages = spark.read.schema(schemas.AGGREGATOR).option("multiLine", True).json(path)
    return aggregator_offers(pages.select(F.explode("results").alias("item")), F.lit(keyword))


def read_employment(spark: SparkSession, path: str, keyword: str | None = None) -> DataFrame:
    """Landed response pages of the public employment service, one JSON document per file."""
    pages = spark.read.schema(schemas.EMPLOYMENT).option("multiLine", True).json(path)
    return employment_offers(pages.select(F.explode("resultats").alias("item")), F.lit(keyword))
