"""Identifiers and dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def content_key(title: Column, company: Column, city: Column) -> Column:
    """Fingerprint of an advert, from its normalised title, company and city."""
    return F.md5(F.concat_ws("|", title, company, city))


# Written forms of a day, tried in this order: with slashes the month comes first where it can.
WRITTEN_DAYS = ("M/d/yyyy", "d/M/yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy")
WRITTEN_INSTANTS = ("d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss xx")


def utc_date(text: Column) -> Column:
    """Any ISO date or instant, extended or compact, or a written date, as its UTC date; unreadable text becomes NULL.

    Instants without an offset are read as UTC whatever the session time zone.
    """
    value = F.regexp_replace(F.trim(text), r"^(\d{4})(\d{2})(\d{2})[T ](\d{2}):?(\d{2}):?(\d{2})", "$1-$2-$3T$4:$5:$6")
    has_clock = value.rlike(r"\d[T ]\d")
    has_zone = value.rlike(r"(?i)(z|utc|gmt|\d[T ]\d.*[+-]\d{2}(:?\d{2})?)$")
    instant = F.try_to_timestamp(F.when(has_zone, value).otherwise(F.concat(value, F.lit("Z"))))
    compact = F.when(value.rlike(r"^\d{8}$"), F.to_date(F.try_to_timestamp(value, F.lit("yyyyMMdd"))))

    def utc(at: Column) -> Column:
        return F.to_date(F.to_utc_timestamp(at, F.current_timezone()))

    iso = F.coalesce(compact, F.when(has_clock, utc(instant)).otherwise(value.try_cast("date")))
    bare = F.regexp_replace(value, r"^[A-Za-z]{3,9},\s*(?=\d)", "")
    written = F.coalesce(*[F.to_date(F.try_to_timestamp(bare, F.lit(form))) for form in WRITTEN_DAYS],
                         *[utc(F.try_to_timestamp(bare, F.lit(form))) for form in WRITTEN_INSTANTS])
    return F.coalesce(iso, F.when(value.rlike(r"[/\s]"), written))


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")
