"""Row selection rules."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from offerscope.vocab.labels import SELECTION_LABELS


def select_dataset(df: DataFrame, mode: str = "auto", flag: str = "is_demo") -> DataFrame:
    """Never mixes real and demo rows unless asked: ``real``, ``all`` or ``auto`` (real if any, else demo)."""
    demo = F.coalesce(F.col(flag).cast("boolean"), F.lit(False))
    if mode == "all":
        return df
    if mode == "real":
        return df.where(~demo)
    if mode != "auto":
        raise ValueError(f"unknown mode {mode!r}")
    any_real = df.agg(F.max(~demo).alias("any_real")).scalar()
    return df.where(~demo | ~F.coalesce(any_real, F.lit(False)))


def dataset_label(df: DataFrame, mode: str = "auto", flag: str = "is_demo") -> DataFrame:
    """One row ``dataset_label`` naming what ``select_dataset`` keeps."""
    demo = F.coalesce(F.col(flag).cast("boolean"), F.lit(False))
    real, fake = F.coalesce(F.max(~demo), F.lit(False)), F.coalesce(F.max(demo), F.lit(False))
    names = {k: F.lit(v) for k, v in SELECTION_LABELS.items()}
    if mode == "real":
        label = names["real"]
    elif mode == "all":
        label = F.when(real & fake, names["both"]).when(real, names["real"]).otherwise(names["demo"])
    else:
        label = F.when(real, names["real"]).otherwise(names["demo"])
    return df.agg(label.alias("dataset_label"))


def within_age(df: DataFrame, day: str, max_age_days: int | None) -> DataFrame:
    """Drops rows strictly older than the latest day minus ``max_age_days``; undated rows stay."""
    if not max_age_days:
        return df
    latest = df.agg(F.max(day).alias("latest")).scalar()
    return df.where(F.col(day).isNull() | (F.col(day) >= F.date_sub(latest, max_age_days)))


def between_or_null(value: Column, bounds: tuple[float, float]) -> Column:
    return F.when(value.between(*bounds), value)


def slice_offers(df: DataFrame, *, roles: Sequence[str] | None = None, seniorities: Sequence[str] | None = None,
                 regions: Sequence[str] | None = None, contracts: Sequence[str] | None = None,
                 remote: Sequence[str] | None = None, sectors: Sequence[str] | None = None,
                 since: date | None = None, until: date | None = None,
                 categories: Sequence[str] | None = None, links: DataFrame | None = None,
                 skills: DataFrame | None = None) -> DataFrame:
    """Dashboard slicing before any view; ``categories`` keeps offers citing a skill of those categories."""
    for column, wanted in (("role_family", roles), ("seniority", seniorities), ("region", regions),
                           ("contract_type", contracts), ("remote_policy", remote), ("sector", sectors)):
        if wanted is not None:
            df = df.where(F.col(column).isin(list(wanted)))
    if since is not None:
        df = df.where(F.col("published_date") >= F.lit(since))
    if until is not None:
        df = df.where(F.col("published_date") <= F.lit(until))
    if categories is not None:
        if links is None or skills is None:
            raise ValueError("slicing by category needs the links and skills tables")
        cited = links.join(skills.where(F.col("category").isin(list(categories))), "skill", "left_semi")
        df = df.join(cited, "offer_id", "left_semi")
    return df
