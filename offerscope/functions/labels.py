"""Typed labels read from advert text. Each builder takes normalised text (``text.norm``)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from offerscope.functions.text import blank_to_null, first_match, rx
from offerscope.vocab import labels as V


def in_scope(title: Column, included: str = V.SCOPE_INCLUDED, excluded: str = V.SCOPE_EXCLUDED) -> Column:
    """True where the title names the trade and none of the excluded ones."""
    return title.rlike(rx(included)) & ~title.rlike(rx(excluded))


def experience_years(text: Column) -> Column:
    years = F.regexp_extract(text, rx(V.YEARS_OF_EXPERIENCE), 1)
    months = F.regexp_extract(text, rx(V.MONTHS_OF_EXPERIENCE), 1)
    return (F.when(text.rlike(V.BEGINNER), F.lit(0.0))
            .when(years != "", F.replace(years, F.lit(","), F.lit(".")).try_cast("double"))
            .when(months != "", F.bround(months.try_cast("double") / 12, 1)))


def seniority(title: Column, contract: Column, years: Column, description_years: Column) -> Column:
    """The title speaks first, then the stated years, then the years found in the description."""
    span = F.coalesce(years, description_years)
    from_years = (F.when(span <= 2, F.lit("Junior")).when(span <= 5, F.lit("Confirmé"))
                  .when(span > 5, F.lit("Senior")).otherwise(F.lit(V.UNKNOWN)))
    intern = title.rlike(rx(V.INTERN_TITLE)) | F.coalesce(contract.isin(*V.INTERN_CONTRACTS), F.lit(False))
    return (F.when(intern, F.lit(V.INTERN))
            .otherwise(first_match(title, V.SENIORITY_TITLE_RULES, default=from_years)))


def role_family(title: Column, rules=V.ROLE_RULES, default: str = V.OTHER_ROLE) -> Column:
    return first_match(title, rules, default=F.lit(default))


def remote_policy(text: Column) -> Column:
    return first_match(text, V.REMOTE_RULES, default=F.lit(V.UNKNOWN))


def contract_type(contract: Column, title: Column) -> Column:
    chain = F.when(F.lit(False), F.lit(V.UNKNOWN))
    for label, pattern, title_pattern in V.CONTRACT_RULES:
        hit = contract.rlike(rx(pattern))
        chain = chain.when(hit | title.rlike(rx(title_pattern)) if title_pattern else hit, F.lit(label))
    return chain.otherwise(F.lit(V.UNKNOWN))


def sector(activity: Column, company: Column) -> Column:
    """Rules on the activity text; the company name is read only where no rule matches it."""
    return F.coalesce(first_match(activity, V.SECTOR_RULES), first_match(company, V.SECTOR_RULES),
                      F.lit(V.OTHER_SECTOR))


def seniority_order(level: Column) -> Column:
    chain = F.when(F.lit(False), F.lit(5))
    for label, weight in V.SENIORITY_ORDER.items():
        chain = chain.when(level == label, F.lit(weight))
    return chain.otherwise(F.lit(max(V.SENIORITY_ORDER.values())))


def skill_kind_label(kind: Column) -> Column:
    return F.when(kind == "tech", F.lit(V.SKILL_KIND_LABELS["tech"])).otherwise(F.lit(V.SKILL_KIND_LABELS["skill"]))


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def company_or_unknown(company: Column) -> Column:
    from offerscope.functions.text import strip

    return F.coalesce(blank_to_null(strip(company)), F.lit(V.UNKNOWN))
