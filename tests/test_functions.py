"""Case tables, one DataFrame per function; each test counts the rows that differ."""

import csv
import re
import unicodedata
from decimal import Decimal
from io import StringIO

import pytest
from pyspark.sql import functions as F

from offerscope.functions import labels
from offerscope.functions.keys import content_key, month_of, utc_date
from offerscope.functions.location import with_location
from offerscope.functions.salary import with_salary
from offerscope.functions.text import collapse, fold, norm, round_half_up, strip_accents, title_case
from offerscope.sources.places import DEFAULT_PLACES, Places
from offerscope.vocab import labels as L
from offerscope.vocab import places as V
from offerscope.vocab.labels import UNKNOWN
from offerscope.vocab.salary import PERIOD_FLOORS, PERIOD_RULES
from tests.samples import samples


def differing(df, got, want):
    bad = df.withColumn("_got", got).where(~F.col("_got").eqNullSafe(want))
    return [r.asDict() for r in bad.collect()]


def salaries(spark, rows):
    schema = ("salary_raw string, salary_min_raw double, salary_max_raw double, salary_unit_raw string,"
              " lo double, hi double, day double")
    return with_salary(spark.createDataFrame(rows, schema))


def test_strip_accents_agrees_with_the_unicode_database(spark):
    texts = ["Éléonore", "Œuvre", "ﬁnance", "naïve…", "½ année", "m²", "ＤＡＴＡ", "plain ascii", "ß straße",
             "Ångström™", "áb", "İstanbul", "Ελλάδα", " x y", "𝐛𝐨𝐥𝐝"]
    rows = [(t, "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))) for t in texts]
    df = spark.createDataFrame(rows, "t string, want string")
    assert differing(df, strip_accents(F.col("t")), F.col("want")) == []


def test_strip_accents_holds_for_every_code_point(spark):
    """Each assigned code point alone, and all of a plane's block in one text."""
    codes = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    plain = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    texts = ["x".join(map(chr, codes[i:i + 64])) for i in range(0, len(codes), 64)]
    df = spark.createDataFrame([(t, plain(t)) for t in texts], "t string, want string")
    assert differing(df, strip_accents(F.col("t")), F.col("want")) == []


def test_norm(spark):
    rows = [(None, ""), ("", ""), ("  L’Été \n à  Paris ", "l'ete a paris"), ("CHEF\tde PROJET", "chef de projet"),
            ("40 000 €", "40 000 €"), ("Résumé", "resume")]
    df = spark.createDataFrame(rows, "t string, want string")
    assert differing(df, norm(F.col("t")), F.col("want")) == []
    assert df.select(collapse(F.lit(" a \n b "))).first()[0] == "a b"
    assert df.select(fold(F.lit("L’Été"))).first()[0] == "L'Ete"


def test_title_case_capitalises_after_every_non_letter(spark):
    rows = [(t, t.title()) for t in ("aix-en-provence", "L'ISLE d'abeau", "indre-et-loire", "évry 2e", "a", "",
                                     "saint-étienne du rouvray")]
    df = spark.createDataFrame(rows, "t string, want string")
    assert differing(df, title_case(F.col("t")), F.col("want")) == []


def test_rounding_is_decimal(spark):
    rows = [(1.005, 2, 1.01), (12.35, 1, 12.4), (0.5, 0, 1.0), (-2.5, 0, -3.0)]
    for value, digits, want in rows:
        assert spark.range(1).select(round_half_up(F.lit(value), digits)).first()[0] == want


def amounts(spark, texts):
    """(text, least, most, per day) as read."""
    rows = salaries(spark, [(t, *[None] * 6) for t in texts]).select("salary_raw", "salary_min", "salary_max", "daily_rate").collect()
    return {r[0]: tuple(r)[1:] for r in rows}


def test_every_period_cue_sets_its_period(spark):
    """300 with each wording a period rule knows; a day rate stays apart, the others are taken to a year."""
    factor = {"hour": 1607, "month": 12, "year": 1}
    cases = {}
    for period, pattern in PERIOD_RULES:
        for cue in samples(pattern):
            text = f"300 {cue}" if not cue[0].isdigit() else f"300{cue[1:]}"
            first = next(p for p, rule in PERIOD_RULES if re.search(rule, text))
            assert first == period or re.search(dict(PERIOD_RULES)[first], text)
            thousand = first == "year" or re.search(r"\d ?k\b", text)
            value = 300.0 * (1000 if thousand else 1)
            cases[text] = (None, None, value) if first == "day" else (value * factor[first],) * 2 + (None,)
    got = amounts(spark, cases)
    assert len(cases) > 25 and {t: got[t] for t in cases} == cases


def test_amounts_without_a_period_go_by_their_size(spark):
    """Around each floor of the table: the amount itself, and one less."""
    scale = {"year": 1.0, "month": 12.0, "hour": 1607.0}
    floors = [*PERIOD_FLOORS, ("hour", 0.0)]
    cases = {}
    for i, (period, floor) in enumerate(PERIOD_FLOORS):
        for value, kind in ((floor, period), (floor - 1, floors[i + 1][0])):
            cases[f"{int(value)} euros"] = (None, None, value) if kind == "day" else (value * scale[kind],) * 2 + (None,)
    got = amounts(spark, cases)
    assert {t: got[t] for t in cases} == cases


def test_forms_of_numbers(spark):
    """The same two yearly amounts with every separator, as thousands, and beside numbers that are none."""
    forms = ["{0} - {1} annuel", "{0} a {1} par an", "annuel {0}/{1}", "annuel {0} {2} {1}"]
    number = [lambda v: str(v), lambda v: f"{v // 1000} {v % 1000:03}", lambda v: f"{v // 1000}.{v % 1000:03}", lambda v: f"{v},00",
              lambda v: f"{v / 1000:g}k", lambda v: f"{v / 1000:g} K".replace(".", ",")]
    other = ["sur 13 mois", "39h par semaine", "37,5 heures/semaine"]
    cases = [f.format(n(41500), n(48200), o) for f in forms for n in number for o in other]
    got = amounts(spark, cases)
    assert {t: v for t, v in got.items() if v != (41500.0, 48200.0, None)} == {}
    assert set(amounts(spark, ["", "selon convention"]).values()) == {(None, None, None)}


def test_salary_from_fields(spark):
    rows = [
        ("ignored 99999", 3000.0, 3500.0, "MONTH", 36000.0, 42000.0, None),
        (None, 60000.0, 70000.0, "year", 60000.0, 70000.0, None),
        (None, 20.0, None, "hour", 20.0 * 1607, 20.0 * 1607, None),
        (None, 1000.0, 900.0, "week", 46800.0, 52000.0, None),
        (None, 500.0, 600.0, "DAY", None, None, 550.0),
        (None, 2000.0, 2500.0, "lunar", 24000.0, 30000.0, None),
        (None, None, 45000.0, None, 45000.0, 45000.0, None),
        (None, 45000.0, 45000.0, "", 45000.0, 45000.0, None),
    ]
    df = salaries(spark, rows)
    for column, want in (("salary_min", "lo"), ("salary_max", "hi"), ("daily_rate", "day")):
        assert differing(df, F.col(column), F.col(want)) == []


def test_every_city_of_the_reference_in_every_spelling(spark):
    """City, department, region and coordinates come from the reference, whatever is written around the name."""
    cities = list(csv.reader(StringIO(V.CITY_CSV)))
    rows = []
    for city, dept, region, lat, _ in cities:
        folded = unicodedata.normalize("NFKD", city).encode("ascii", "ignore").decode().upper()
        for text in (city, folded, f"{dept} - {folded}", f"{city}, {region}", f"{city}, {region}, France", f"  {city.lower()} ,, {region}",
                     f"{folded} CEDEX 3", f"{city} ({dept})", f"{city} 4e Arrondissement", f"2e Arrondissement, {city}", f"{dept} - {folded} 07"):
            rows.append((text, city, dept, region, float(lat)))
    df = spark.createDataFrame([(*r, -1.0, -1.0) for r in rows], "location_raw string, want_city string, want_dept string,"
                               " want_region string, want_lat double, latitude double, longitude double")
    out = with_location(df)
    assert out.count() == len(rows) == 11 * 57
    for column, want in (("city", "want_city"), ("region", "want_region"), ("department_code", "want_dept"), ("latitude", "want_lat")):
        assert differing(out, F.col(column), F.col(want)) == []


def test_areas_and_unknown_places(spark):
    """Names of areas are no cities unless a city bears them; a place nobody knows keeps its name and its area's region."""
    known = {c[0] for c in DEFAULT_PLACES.cities}
    rows = [(t, UNKNOWN, UNKNOWN, None) for t in (None, "", "  ", *V.NOT_A_PLACE)]
    for key, code, region in DEFAULT_PLACES.admin_rows():
        if key.replace("saint ", "st ") not in known:
            rows.append((key.upper(), UNKNOWN, region, code))
        rows.append((f"bourg-neuf, {key}", "Bourg-Neuf", region, code))
    df = spark.createDataFrame([(*r, 1.0, 1.0) for r in rows], "location_raw string, want_city string, want_region string,"
                               " want_dept string, latitude double, longitude double")
    out = with_location(df)
    for column, want in (("city", "want_city"), ("region", "want_region"), ("department_code", "want_dept")):
        assert differing(out, F.col(column), F.col(want)) == []


def test_a_reference_of_200000_cities(spark):
    """A table of any size: the last row of a name counts, a department takes the region of its first row."""
    numbers = spark.range(0, 200_000, 1, 4).withColumn("name", F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"))
    table = numbers.select(
        F.concat(F.lit("Saint Lieu "), "name").alias("city"), F.concat(F.lit("D"), F.col("id") % 500).alias("dept_code"),
        F.concat(F.lit("Zone "), F.col("id") % 7).alias("region"), (F.col("id") / 1000).alias("latitude"),
        (F.col("id") / 500).alias("longitude"), F.col("id").alias("nth"))
    again = spark.createDataFrame([("SAINT-LIEU HH", "D1", "Neue Zone", 0.5, 0.25, 900_000)], table.schema)
    places = Places((), table.union(again))
    rows = numbers.where("id % 100 = 77").select(
        F.concat(F.lit("saint-lieu "), "name", F.lit(" cedex")).alias("location_raw"), "id", "name", F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"))
    out = with_location(rows, places=places)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Saint Lieu f" not in plan and len(plan) < 400_000
    bad = out.where("not (city = concat('Saint Lieu ', name) and region = concat('Zone ', id % 7) and latitude = id / 1000)").collect()
    assert [r["city"] for r in bad] == ["SAINT-LIEU HH"] and bad[0]["region"] == "Neue Zone" and out.count() == 2000


def first_match(rules, text, other):
    return next((label for label, pattern in rules if re.search(pattern, text)), other)


def written(rules):
    """Each alternative of each rule alone and inside a sentence, and each pair of rules in both orders."""
    one = {label: samples(pattern) for label, pattern in rules}
    texts = [t for some in one.values() for s in some for t in (s, f"avant {s} apres", s.upper())]
    firsts = [some[0] for some in one.values()]
    return list(dict.fromkeys([*texts, *(f"{a} ; {b}" for a in firsts for b in firsts if a != b), "rien de tel", ""]))


@pytest.mark.parametrize(("rules", "label", "other"), [
    (L.ROLE_RULES, labels.role_family, L.OTHER_ROLE), (L.REMOTE_RULES, labels.remote_policy, UNKNOWN),
    (L.SECTOR_RULES, lambda text: labels.sector(text, F.lit("")), L.OTHER_SECTOR)], ids=["role", "remote", "sector"])
def test_ordered_rules(spark, rules, label, other):
    rows = [(t, first_match(rules, t.lower(), other)) for t in written(rules)]
    assert {want for _, want in rows} == {*(name for name, _ in rules), other}
    df = spark.createDataFrame(rows, "t string, want string")
    assert differing(df, label(norm(F.col("t"))), F.col("want")) == []


def test_the_company_speaks_where_the_sector_says_nothing(spark):
    firsts = {name: samples(pattern)[0] for name, pattern in L.SECTOR_RULES}
    rows = [(a, b, first_match(L.SECTOR_RULES, a, "")) for a in firsts.values() for b in firsts.values()]
    rows += [(a, b, first_match(L.SECTOR_RULES, b, "")) for a in ("", None, "xyz") for b in firsts.values()]
    df = spark.createDataFrame([*rows, (None, None, L.OTHER_SECTOR)], "raw string, company string, want string")
    assert differing(df, labels.sector(norm(F.col("raw")), norm(F.col("company"))), F.col("want")) == []


def test_contracts_from_text_and_title(spark):
    def want(raw, title):
        return next((name for name, text, head in L.CONTRACT_RULES
                     if re.search(text, raw or "") or head and re.search(head, title)), UNKNOWN)

    texts = [s for _, text, _ in L.CONTRACT_RULES for s in samples(text)] + [None, "autre"]
    titles = [s for _, _, head in L.CONTRACT_RULES if head for s in samples(head)[:3]] + ["metier"]
    rows = [(a, b, want(a, b)) for a in texts for b in titles]
    df = spark.createDataFrame(rows, "raw string, title string, want string")
    assert differing(df, labels.contract_type(norm(F.col("raw")), norm(F.col("title"))), F.col("want")) == []


def test_seniority_by_title_then_years(spark):
    """Every cue of every title rule with every contract and number of years; years of the field before those of the text."""
    def want(title, years, contract, told):
        if re.search(L.INTERN_TITLE, title) or contract in L.INTERN_CONTRACTS:
            return L.INTERN
        found = first_match(L.SENIORITY_TITLE_RULES, title, None)
        years = told if years is None else years
        return found or (UNKNOWN if years is None else "Junior" if years <= 2 else "Confirmé" if years <= 5 else "Senior")

    titles = [s for _, p in L.SENIORITY_TITLE_RULES for s in samples(p)] + samples(L.INTERN_TITLE) + ["metier"]
    rows = [(t, y, c, told, want(t, y, c, told)) for t in titles for y in (None, 0.0, 2.0, 2.1, 5.0, 5.5)
            for c in ("CDI", *L.INTERN_CONTRACTS) for told in (None, 2.0, 5.0, 9.0)]
    df = spark.createDataFrame(rows, "title string, years double, contract string, told double, want string")
    got = labels.seniority(norm(F.col("title")), F.col("contract"), F.col("years"), F.col("told"))
    assert differing(df, got, F.col("want")) == []


def test_years_of_experience(spark):
    rows = [(s, 0.0) for s in samples(L.BEGINNER)] + [(f"{s} ou 7 ans", 0.0) for s in samples(L.BEGINNER)[:2]]
    for n in (0, 1, 4, 15):
        rows += [(f"{lead}{n}{tail}", float(n)) for lead in ("", "au moins ", "de ") for tail in (" an(s)", " ans", " years", "ans", " year")]
        rows += [(f"{n}{sign}5 ans", n + 0.5) for sign in ".,"]
    rows += [(f"{n} mois", float(round(Decimal(n) / 12, 1))) for n in (1, 5, 7, 12, 26, 40)]
    rows += [("8 ans puis 3 ans", 8.0), ("30 mois et 2 ans", 2.0), ("annees", None), ("", None), (None, None)]
    df = spark.createDataFrame(rows, "t string, want double")
    assert differing(df, labels.experience_years(norm(F.col("t"))), F.col("want")) == []


def test_scope_exclusion_wins(spark):
    inside, outside = samples(L.SCOPE_INCLUDED), samples(L.SCOPE_EXCLUDED)
    rows = [(t, True) for t in inside] + [(t, False) for t in outside] + [("metier", False)]
    rows += [(f"{a} {b}", False) for a in inside[:4] for b in outside]
    rows = [(t, w and not re.search(L.SCOPE_EXCLUDED, t)) for t, w in rows]
    df = spark.createDataFrame(rows, "t string, want boolean")
    assert differing(df, labels.in_scope(norm(F.col("t"))), F.col("want")) == []


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_dates_are_utc_whatever_the_session(spark, zone):
    rows = [("2026-09-01", "2026-09-01"), ("2026-09-12T10:21:33.000Z", "2026-09-12"),
            ("2026-09-12T23:30:00-05:00", "2026-09-13"), ("2026-09-12T00:30:00+02:00", "2026-09-11"),
            ("2026-09-12 23:59:59", "2026-09-12"), ("20260912", "2026-09-12"), ("soon", None), (None, None),
            ("", None), ("2026-13-45", None), ("20260912T233000-0500", "2026-09-13"), ("20260912T101010Z", "2026-09-12"),
            ("2026-09-12T00:30:00+02", "2026-09-11"), ("25/09/2026", "2026-09-25"), ("05/09/2026", "2026-05-09"),
            ("Sep 25, 2026", "2026-09-25"), ("September 5, 2026", "2026-09-05"), ("25 Sep 2026", "2026-09-25"),
            ("Fri, 25 Sep 2026 10:00:00 GMT", "2026-09-25"), ("Fri, 25 Sep 2026 23:30:00 -0500", "2026-09-26")]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(rows, "t string, want string")
        assert differing(df, utc_date(F.col("t")).cast("string"), F.col("want")) == []
        assert df.select(month_of(utc_date(F.lit("2026-09-12"))).cast("string")).first()[0] == "2026-09-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_content_key_ignores_spelling(spark):
    df = spark.range(1)
    a = df.select(content_key(norm(F.lit("Data Analyst H/F")), norm(F.lit("ACME")), norm(F.lit("Paris")))).first()[0]
    b = df.select(content_key(norm(F.lit("data  analyst h/f")), norm(F.lit("Acmé")), norm(F.lit("PARIS")))).first()[0]
    c = df.select(content_key(norm(F.lit("data analyst h/f")), norm(F.lit(None).cast("string")), norm(F.lit("PARIS")))).first()[0]
    assert a == b and a != c
