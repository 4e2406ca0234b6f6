"""Raw records -> the clean, deduplicated offers table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, functions as F

from offerscope import schemas
from offerscope.functions import labels
from offerscope.functions.keys import content_key, month_of, utc_date
from offerscope.functions.location import with_location
from offerscope.functions.salary import plausible, with_salary
from offerscope.functions.text import blank_to_null, norm, strip
from offerscope.operators.dedup import oldest_then_latest_arrival, two_pass
from offerscope.operators.filters import select_dataset, within_age
from offerscope.operators.skew import spread
from offerscope.settings import Settings
from offerscope.sources.landing import ARRIVAL
from offerscope.sources.places import DEFAULT_PLACES, Places
from offerscope.vocab.labels import INTERN


def in_market(raw: DataFrame, rejected: Observation | None = None) -> DataFrame:
    """Rows with a title that names a data or AI trade; adds ``_title`` (normalised).

    ``rejected`` counts the titled rows outside the market without another pass.
    """
    titled = raw.withColumn("_title", norm(F.col("title")))
    inside = labels.in_scope(F.col("_title"))
    if rejected is not None:
        titled = titled.observe(rejected, F.count_if((F.col("_title") != "") & ~inside).alias("out_of_scope"))
    # A blank title matches no rule. The stripped title comes after the filter, which is pushed below it.
    return titled.where(inside).withColumn("title", strip(F.col("title")))


def typed_offers(raw: DataFrame, settings: Settings = Settings(), places: Places = DEFAULT_PLACES,
                 rejected: Observation | None = None) -> DataFrame:
    """All narrow steps: one clean row per raw record in scope, before any row competes with another.

    Keeps the columns of ``raw`` it does not know (arrival columns among them) and adds ``_content_key``.
    """
    df = in_market(raw, rejected)
    df = df.withColumn("description", F.coalesce(F.col("description"), F.lit("")))
    df = df.withColumns({
        "_body": norm(F.col("description")),
        "_contract": norm(F.col("contract_raw")),
        "_company": norm(F.col("company")),
    })
    df = df.withColumns({
        "contract_type": labels.contract_type(F.col("_contract"), F.col("_title")),
        "experience_years": labels.experience_years(norm(F.col("experience_raw"))),
    })
    df = df.withColumn("seniority", labels.seniority(
        F.col("_title"), F.col("contract_type"), F.col("experience_years"), labels.experience_years(F.col("_body"))))

    df = with_location(df, places=places)
    df = with_salary(df, hours_per_year=settings.hours_per_year)
    keep = F.col("salary_mid").between(*settings.salary_bounds) & (F.col("seniority") != INTERN)
    df = plausible(df, keep)
    df = df.withColumn("has_salary", labels.flag(F.col("salary_mid").isNotNull()))
    df = df.withColumns({c: whole_or_null(F.col(c)) for c in ("salary_min", "salary_max", "salary_mid")})

    remote_text = F.concat_ws(" ", blank_to_null(norm(F.col("remote_raw"))), blank_to_null(F.col("_body")))
    df = df.withColumns({
        "offer_id": F.concat(F.col("source"), F.lit(":"), F.col("source_id")),
        "is_demo": labels.flag(F.col("is_demo")),
        "role_family": labels.role_family(F.col("_title")),
        "sector": labels.sector(norm(F.col("sector_raw")), F.col("_company")),
        "remote_policy": labels.remote_policy(remote_text),
        "published_date": utc_date(F.col("published_at")),
        "_content_key": content_key(F.col("_title"), F.col("_company"), norm(F.col("city"))),
    })
    df = df.withColumns({
        "published_month": month_of(F.col("published_date")),
        "company": labels.company_or_unknown(F.col("company")),
    })
    return df.drop("_title", "_body", "_contract", "_company", "salary_period")


def whole_or_null(amount: Column) -> Column:
    """Half-even rounding to whole units; zero counts as missing."""
    return F.when(amount != 0, F.bround(amount, 0))


def staged_columns(arrival: Sequence[str] = ARRIVAL) -> list[str]:
    """Columns a staging table of typed offers keeps for ``unique_offers``."""
    return [*schemas.CLEAN.fieldNames(), "_content_key", *arrival]


def unique_offers(typed: DataFrame, settings: Settings = Settings(), arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """Age limit, then the two-pass deduplication; the 27 clean columns in order."""
    recent = within_age(typed, "published_date", settings.max_age_days)
    columns = schemas.CLEAN.fieldNames()
    narrow = recent.select(*columns, "_content_key", *[a for a in arrival if a not in columns])
    best = two_pass(narrow, ["offer_id"], ["_content_key"],
                    oldest_then_latest_arrival("published_date", arrival), arrival)
    return best.select(*[F.col(f.name).cast(f.dataType) for f in schemas.CLEAN.fields])


@dataclass(frozen=True)
class Staged:
    """Typed rows as Parquet, and what was counted while they were written."""

    rows: DataFrame
    real: int
    demo: int
    out_of_scope: int
    bad_lines: int = 0

    def chosen(self, mode: str) -> DataFrame:
        """The rows of a dataset mode; raw records outside the market count for the choice of ``auto``."""
        if mode == "auto":
            mode = "real" if self.real else "demo"
        if mode not in ("real", "demo", "all"):
            raise ValueError(f"unknown mode {mode!r}")
        return self.rows if mode == "all" else self.rows.where(F.col("is_demo") == (1 if mode == "demo" else 0))


def stage_offers(raw: DataFrame, path: str, settings: Settings = Settings(), places: Places = DEFAULT_PLACES,
                 arrival: Sequence[str] = ARRIVAL) -> Staged:
    """Reads the raw text once. What needs the whole set reads narrow columns of the staged rows afterwards."""
    demo = F.coalesce(F.col("is_demo"), F.lit(False))
    bad = F.col("_bad_line").isNotNull() if "_bad_line" in raw.columns else F.lit(False)
    counted, rejected = Observation("landed"), Observation("rejected")
    counts = [F.count_if(~demo & ~bad).alias("real"), F.count_if(demo & ~bad).alias("demo"), F.count_if(bad).alias("bad")]
    landed, raw = raw, raw.observe(counted, *counts)
    if "_bad_line" in raw.columns:
        raw = raw.where(~bad).drop("_bad_line")
    typed = typed_offers(spread(raw, arrival), settings, places, rejected).select(*staged_columns(arrival))
    typed.write.parquet(path)
    try:
        seen, out_of_scope = counted.get, rejected.get["out_of_scope"]
    except Py4JJavaError:  # no row was dealt, so adaptive execution dropped the plan with what it had observed
        seen, out_of_scope = landed.agg(*counts).first().asDict(), 0
    return Staged(raw.sparkSession.read.schema(typed.schema).parquet(path), seen["real"], seen["demo"], out_of_scope, seen["bad"])


def clean_offers(raw: DataFrame, settings: Settings = Settings(), places: Places = DEFAULT_PLACES,
                 arrival: Sequence[str] = ARRIVAL, rejected: Observation | None = None) -> DataFrame:
    """Raw records -> clean table. ``arrival`` orders the records as they came in (ascending)."""
    chosen = select_dataset(raw, settings.data_mode)
    return unique_offers(typed_offers(chosen, settings, places, rejected), settings, arrival)
