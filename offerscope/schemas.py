"""Declared schemas: nothing in the library infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()


def _fields(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in spec])


# The raw record common to all sources.
RAW = _fields([
    ("source", _S), ("source_id", _S), ("title", _S), ("description", _S), ("company", _S),
    ("location_raw", _S), ("published_at", _S), ("contract_raw", _S), ("salary_raw", _S),
    ("salary_min_raw", _D), ("salary_max_raw", _D), ("salary_unit_raw", _S), ("experience_raw", _S),
    ("sector_raw", _S), ("remote_raw", _S), ("url", _S), ("latitude", _D), ("longitude", _D),
    ("search_keyword", _S), ("is_demo", T.BooleanType()), ("collected_at", _S),
])

# The clean table, in order.
CLEAN = _fields([
    ("offer_id", _S), ("source", _S), ("source_id", _S), ("is_demo", _I), ("title", _S), ("role_family", _S),
    ("seniority", _S), ("experience_years", _D), ("contract_type", _S), ("company", _S), ("sector", _S),
    ("city", _S), ("department_code", _S), ("region", _S), ("latitude", _D), ("longitude", _D),
    ("remote_policy", _S), ("salary_min", _D), ("salary_max", _D), ("salary_mid", _D), ("has_salary", _I),
    ("daily_rate", _D), ("published_date", T.DateType()), ("published_month", T.DateType()), ("url", _S),
    ("search_keyword", _S), ("description", _S),
])

OFFERS = T.StructType(CLEAN.fields + [T.StructField("skills_count", _I, True)])
SKILLS = _fields([("skill", _S), ("category", _S), ("skill_type", _S)])
OFFER_SKILLS = _fields([("offer_id", _S), ("skill", _S)])
TOP_TERMS = _fields([("role_family", _S), ("term", _S), ("tfidf_score", _D), ("rank", _I)])
RUNS = _fields([("run_at", T.TimestampType()), ("dataset_label", _S), ("n_raw", T.LongType()),
                ("n_offers", T.LongType()), ("n_offer_skills", T.LongType())])
CITIES = _fields([("city", _S), ("dept_code", _S), ("region", _S), ("latitude", _D), ("longitude", _D)])

# Payloads of the two search interfaces, as DDL.
AGGREGATOR_ITEM = (
    "struct<id:string, title:string, description:string, created:string,"
    " location:struct<display_name:string, area:array<string>>, company:struct<display_name:string>,"
    " salary_min:double, salary_max:double, salary_is_predicted:string, contract_type:string,"
    " contract_time:string, category:struct<label:string>, redirect_url:string, latitude:double,"
    " longitude:double>")
AGGREGATOR = f"results array<{AGGREGATOR_ITEM}>"

EMPLOYMENT_ITEM = (
    "struct<id:string, intitule:string, description:string, dateCreation:string,"
    " lieuTravail:struct<libelle:string, latitude:double, longitude:double, codePostal:string>,"
    " entreprise:struct<nom:string>, typeContrat:string, typeContratLibelle:string,"
    " experienceLibelle:string, salaire:struct<libelle:string, commentaire:string>,"
    " secteurActiviteLibelle:string, competences:array<struct<libelle:string>>,"
    " origineOffre:struct<urlOrigine:string>>")
EMPLOYMENT = f"resultats array<{EMPLOYMENT_ITEM}>"
