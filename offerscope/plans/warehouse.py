"""The tables every view reads: built from clean offers, checked, written, registered."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from offerscope import schemas
from offerscope.operators import checks
from offerscope.operators.skew import spread
from offerscope.operators.skills import catalogue, links, with_skills
from offerscope.operators.terms import top_terms
from offerscope.settings import Settings
from offerscope.vocab.stopwords import advert_stopwords

TABLES = ("offers", "skills", "offer_skills", "top_terms")
_PUBLISHED = "number long, load string"
_CITED = T.StructType(schemas.OFFERS.fields + [T.StructField("skills", T.ArrayType(T.StringType()))])


@dataclass(frozen=True)
class Warehouse:
    offers: DataFrame
    skills: DataFrame
    offer_skills: DataFrame
    top_terms: DataFrame


def with_cited_skills(clean: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Clean offers with the array of cited skills and its size: no join, no shuffle."""
    cited = with_skills(clean, ["title", "description"], settings.skills)
    return cited.withColumn("skills_count", F.size("skills"))


def build(cited: DataFrame, settings: Settings = Settings()) -> Warehouse:
    """Warehouse over offers that carry their cited skills (see ``with_cited_skills``)."""
    terms = top_terms(cited, "offer_id", "role_family", "description", advert_stopwords(), n=settings.top_terms,
                      min_df=settings.term_min_df, max_df=settings.term_max_df)
    return Warehouse(
        offers=cited.select(*schemas.OFFERS.fieldNames()),
        skills=catalogue(cited.sparkSession, settings.skills),
        offer_skills=links(cited, "offer_id"),
        top_terms=terms)


def store(clean: DataFrame, path: str, settings: Settings = Settings()) -> dict[str, int]:
    """Full reload: write, check, publish. Returns row counts observed while writing.

    The tables go to a folder of their own below ``path/loads``. Only when they keep all rules, one row in ``path/published`` makes
    them the current load; until then, and after a failed check, readers get the former one.

    The offers are written once, with their skills; bridge and terms are derived from that table, so the raw text
    is cleaned and searched in one pass.
    """
    spark, name = clean.sparkSession, uuid4().hex
    folder = f"{path}/loads/{name}"
    counts = {"offers": _written(with_cited_skills(spread(clean, ["offer_id"]), settings), f"{folder}/offers")}
    derived = build(spark.read.schema(_CITED).parquet(f"{folder}/offers"), settings)
    for table in TABLES[1:]:
        counts[table] = _written(getattr(derived, table), f"{folder}/{table}")
    broken = constraints(_tables(spark, folder)).where("violations > 0").collect()  # one row per rule at most
    if broken:
        raise ValueError(f"the load breaks its rules, the former one stays published: {[tuple(r) for r in broken]}")
    row = spark.createDataFrame([(_current(spark, path)[0] + 1, name)], _PUBLISHED)
    row.coalesce(1).write.mode("append").parquet(f"{path}/published")
    return counts


def _written(table: DataFrame, path: str) -> int:
    seen = Observation()
    table.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return seen.get["rows"]


def _current(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """Number and name of the load that was published last; (0, None) before the first."""
    try:
        published = spark.read.parquet(f"{path}/published")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, None
    return tuple(published.select("number", "load").orderBy(F.desc("number")).first())


def _tables(spark: SparkSession, folder: str) -> Warehouse:
    schema = {"offers": schemas.OFFERS, "skills": schemas.SKILLS, "offer_skills": schemas.OFFER_SKILLS,
              "top_terms": schemas.TOP_TERMS}
    return Warehouse(**{name: spark.read.schema(schema[name]).parquet(f"{folder}/{name}") for name in TABLES})


def load(spark: SparkSession, path: str) -> Warehouse:
    """The tables of the current load."""
    _, name = _current(spark, path)
    if name is None:
        raise ValueError(f"nothing is published below {path}")
    return _tables(spark, f"{path}/loads/{name}")


def log_run(spark: SparkSession, path: str, label: str, n_raw: int, n_offers: int, n_links: int,
            at: datetime | None = None) -> None:
    """Appends one row to the run log, the only table a reload keeps."""
    row = [(at or datetime.now(), label, n_raw, n_offers, n_links)]
    spark.createDataFrame(row, schemas.RUNS).write.mode("append").parquet(f"{path}/pipeline_runs")


def constraints(warehouse: Warehouse) -> DataFrame:
    """(table, rule, violations) for the keys, references, mandatory columns and value lists of the model."""
    zero_one = lambda c: F.col(c).isin(0, 1)
    offer_rules = checks.not_null(
        "offer_id", "source", "source_id", "is_demo", "title", "role_family", "seniority", "contract_type", "sector",
        "city", "region", "remote_policy", "has_salary", "skills_count")
    offer_rules |= {"is_demo in (0, 1)": zero_one("is_demo"), "has_salary in (0, 1)": zero_one("has_salary")}
    skill_rules = checks.not_null("skill", "category", "skill_type")
    skill_rules |= {"skill_type in (tech, skill)": F.col("skill_type").isin("tech", "skill")}
    return checks.report(
        checks.column_rules(warehouse.offers, "offers", offer_rules),
        checks.primary_key(warehouse.offers, "offers", ["offer_id"]),
        checks.column_rules(warehouse.skills, "skills", skill_rules),
        checks.primary_key(warehouse.skills, "skills", ["skill"]),
        checks.column_rules(warehouse.offer_skills, "offer_skills", checks.not_null("offer_id", "skill")),
        checks.primary_key(warehouse.offer_skills, "offer_skills", ["offer_id", "skill"]),
        checks.foreign_key(warehouse.offer_skills, "offer_skills", "offer_id", warehouse.offers),
        checks.foreign_key(warehouse.offer_skills, "offer_skills", "skill", warehouse.skills),
        checks.column_rules(warehouse.top_terms, "top_terms",
                            checks.not_null("role_family", "term", "tfidf_score", "rank")))
