"""Job postings published as JSON-LD inside HTML pages -> raw records. Input: a table ``pages(url, html)``."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from offerscope.functions.text import blank_to_null, strip
from offerscope.operators.skew import explode_computed
from offerscope.session import stored
from offerscope.sources.landing import as_raw

# A comment or a whole script: a script inside a comment is no script, a comment inside a script is content.
_COMMENT_OR_SCRIPT = r"(?is)<!--.*?-->|<script\b([^>]*)>(.*?)</script\s*>"
_LD_JSON = r"(?i)\btype\s*=\s*[\"']?application/ld\+json"
_HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>"
_TAG = r"<[a-zA-Z/!?][^>]*>"
# Levels of lists and "@graph" members unfolded in one pass; see ``job_postings``.
ROUNDS = 4


def _get(value: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, path, kind)


def _is_text(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def _is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def _first(value: Column) -> Column:
    """First element of a list, other values as they are."""
    return F.coalesce(_get(value, "$[0]"), value)


def ld_blocks(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per readable JSON-LD block (column ``block``, a variant) instead of the page; broken JSON is skipped."""
    attributes = F.regexp_extract_all(html, F.lit(_COMMENT_OR_SCRIPT), F.lit(1))
    bodies = F.regexp_extract_all(html, F.lit(_COMMENT_OR_SCRIPT), F.lit(2))
    scripts = F.filter(F.arrays_zip(attributes.alias("attrs"), bodies.alias("body")),
                       lambda s: s["attrs"].rlike(_LD_JSON))
    mentioned = pages.where(F.contains(html, F.lit("ld+json")) | F.col(html).rlike(r"(?i)ld\+json"))
    keep = [c for c in pages.columns if c != html]
    bodies = explode_computed(mentioned, keep, F.transform(scripts, lambda s: s["body"]), "_script")
    # The parser ignores what follows the first value; inside brackets it cannot.
    wrapped = F.try_parse_json(F.concat(F.lit("["), "_script", F.lit("]")))
    single = F.when(_get(wrapped, "$[1]").isNull(), _get(wrapped, "$[0]"))
    return bodies.withColumn("block", single).where(F.col("block").isNotNull()).drop("_script")


def _unfold(values: Column) -> Column:
    """One round: lists give their elements, objects stay and add what is in their "@graph"."""
    def step(v: Column) -> Column:
        items = _get(v, "$", "array<variant>")
        graph = _get(v, '$["@graph"]')
        return F.when(items.isNotNull(), items).when(graph.isNotNull(), F.array(graph)) \
                .otherwise(F.array().cast("array<variant>"))

    return F.flatten(F.transform(values, step))


def _is_posting(v: Column) -> Column:
    kinds = _get(v, '$["@type"]', "array<string>")
    return F.coalesce(_get(v, '$["@type"]', "string") == "JobPosting", F.lit(False)) \
        | F.coalesce(F.array_contains(kinds, "JobPosting"), F.lit(False))


def job_postings(pages: DataFrame, html: str = "html", rounds: int = ROUNDS) -> DataFrame:
    """One row per object whose ``@type`` is, or contains, JobPosting (column ``posting``).

    Readable blocks are stored, then lists and "@graph" members are unfolded, ``rounds`` levels in one pass. What is left below them
    goes through the next pass, until nothing is left: one pass reaches any usual nesting, and depth has no limit.
    """
    keep = [c for c in pages.columns if c != html]
    blocks = stored(ld_blocks(pages, html).withColumn("block", F.to_json("block")), "ld-blocks")
    rows, found = blocks.select(*keep, F.array(F.parse_json("block")).alias("_level0")), None
    while True:
        for i in range(rounds):
            rows = rows.withColumn(f"_level{i + 1}", _unfold(F.col(f"_level{i}")))
        values = F.flatten(F.array(*[F.col(f"_level{i}") for i in range(rounds)]))
        postings = explode_computed(rows, keep, F.filter(values, _is_posting), "posting")
        found = postings if found is None else found.unionByName(postings)
        below = rows.where(F.size(f"_level{rounds}") > 0).select(
            *keep, F.transform(f"_level{rounds}", lambda v: F.to_json(v)).alias("_left"))
        below = stored(below, "ld-deeper")
        if below.isEmpty():
            return found
        rows = below.select(*keep, F.transform("_left", F.parse_json).alias("_level0"))


def _entity_decoded(text: Column) -> Column:
    """Named (HTML 5) and numeric character references decoded, each exactly once; the semicolon may be missing.

    A name is read whole; one that the table does not hold stays, without its semicolon. Numbers 128 to 159 are read as
    windows-1252; zero, surrogates and numbers that are no code point give U+FFFD.
    """
    by_letter: dict[str, dict[str, str]] = {}
    for name, char in html5.items():
        by_letter.setdefault(name[0], {})[name.rstrip(";")] = char
    # Names by their first letter: a look-up in a map of literals goes through its keys one by one.
    names = F.create_map(*[x for letter, some in by_letter.items() for x in (
        F.lit(letter), F.create_map(*[F.lit(y) for pair in some.items() for y in pair]))])
    windows = F.create_map(*[F.lit(x) for b in range(0x80, 0xA0) if (c := bytes([b]).decode("cp1252", "ignore"))
                             for x in (f"{b:X}", f"{ord(c):X}")])

    def piece(p: Column) -> Column:
        name = F.regexp_extract(p, r"^&([A-Za-z][A-Za-z0-9]*)", 1)
        named = F.try_element_at(F.try_element_at(names, F.substring(name, 1, 1)), name)
        decimal = F.regexp_extract(p, r"^&#0*(\d+)", 1)
        hexa = F.regexp_extract(p, r"^&#[xX]0*([0-9a-fA-F]+)", 1)
        number = F.when(hexa != "", F.upper(hexa)).when(decimal != "", F.coalesce(
            F.hex(decimal.try_cast("bigint")), F.lit("FFFFFFFFF")))
        size = F.length(number)
        wrong = (size > 6) | ((size == 6) & (number > "10FFFF")) | ((size == 4) & number.between("D800", "DFFF")) | (number == "0")
        code = F.when(wrong, F.lit("FFFD")).otherwise(F.coalesce(F.try_element_at(windows, number), number))
        rest = F.regexp_replace(p, r"^&(#[xX][0-9a-fA-F]+|#\d+|[A-Za-z][A-Za-z0-9]*);?", "")
        char = F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")
        return (F.when(code.isNotNull(), F.concat(char, rest))
                .when(name == "", p)
                .otherwise(F.concat(F.coalesce(named, F.concat(F.lit("&"), name)), rest)))

    decoded = F.array_join(F.transform(F.split(text, "(?=&)"), piece), "")
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def html_to_text(html: Column) -> Column:
    """Visible text: tags cut the text into pieces, each trimmed, non-empty ones joined by a blank."""
    visible = F.regexp_replace(F.coalesce(html, F.lit("")), _HIDDEN, "<x>")
    pieces = F.transform(F.split(visible, _TAG), lambda p: strip(_entity_decoded(p)))
    return F.array_join(F.filter(pieces, lambda p: p != ""), " ")


def posting_offers(postings: DataFrame, url: str = "url") -> DataFrame:
    """Maps the ``posting`` variants to raw records; every member may come in several shapes."""
    p = F.col("posting")
    df = postings.withColumns({
        "_org": _first(_get(p, "$.hiringOrganization")),
        "_place": _first(_get(p, "$.jobLocation")),
        "_pay": _get(p, "$.baseSalary.value"),
        "_months": F.try_divide(_get(p, "$.experienceRequirements.monthsOfExperience", "double"), F.lit(12.0)),
    })
    address = _get(F.col("_place"), "$.address")
    locality = blank_to_null(F.concat_ws(", ", blank_to_null(_get(address, "$.addressLocality", "string")),
                                         blank_to_null(_get(address, "$.addressRegion", "string"))))
    pay = F.col("_pay")

    def amount(bound: str) -> Column:
        def present(path: str) -> Column:
            number = _get(pay, path, "double")
            return F.when(number != 0, number)
        return F.when(_is_object(pay), F.coalesce(present(f"$.{bound}"), present("$.value"))) \
                .otherwise(_get(pay, "$", "double"))

    unit = F.when(_is_object(pay), _get(pay, "$.unitText", "string")).otherwise(
        _get(p, "$.baseSalary.unitText", "string"))
    kinds = _get(p, "$.employmentType", "array<string>")
    plain_id = F.when(~_is_object(_get(p, "$.identifier")), _get(p, "$.identifier", "string"))
    experience = F.when(_is_text(_get(p, "$.experienceRequirements")), _get(p, "$.experienceRequirements", "string"))
    org = F.col("_org")
    rows = df.select(
        F.lit("jsonld_scraper").alias("source"),
        F.coalesce(blank_to_null(_get(p, "$.identifier.value", "string")), blank_to_null(plain_id),
                   F.substring(F.md5(url), 1, 16)).alias("source_id"),
        F.coalesce(_get(p, "$.title", "string"), F.lit("")).alias("title"),
        html_to_text(_get(p, "$.description", "string")).alias("description"),
        F.when(_is_text(org), _get(org, "$", "string")).otherwise(_get(org, "$.name", "string")).alias("company"),
        F.when(_is_text(address), _get(address, "$", "string")).otherwise(locality).alias("location_raw"),
        _get(p, "$.datePosted", "string").alias("published_at"),
        F.when(kinds.isNotNull(), F.array_join(kinds, ", "))
         .otherwise(_get(p, "$.employmentType", "string")).alias("contract_raw"),
        amount("minValue").alias("salary_min_raw"), amount("maxValue").alias("salary_max_raw"),
        unit.alias("salary_unit_raw"),
        F.coalesce(experience, F.when(F.col("_months") > 0, F.concat(F.floor("_months").cast("string"),
                                                                      F.lit(" ans")))).alias("experience_raw"),
        F.when(_is_text(_get(p, "$.industry")), _get(p, "$.industry", "string")).alias("sector_raw"),
        F.when(_get(p, "$.jobLocationType", "string") == "TELECOMMUTE", F.lit("TELECOMMUTE")).alias("remote_raw"),
        F.col(url).alias("url"),
        _get(F.col("_place"), "$.geo.latitude", "double").alias("latitude"),
        _get(F.col("_place"), "$.geo.longitude", "double").alias("longitude"),
        F.lit(False).alias("is_demo"))
    return as_raw(rows)


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """One ``url`` per line; blank lines and lines starting with "#" are ignored."""
    lines = spark.read.text(path).select(strip(F.col("value")).alias("url"))
    return lines.where((F.col("url") != "") & ~F.col("url").startswith("#"))


def offers_from_pages(pages: DataFrame, urls: DataFrame | None = None) -> DataFrame:
    """Raw records of all postings in ``pages(url, html)``, restricted to the listed URLs when given."""
    if urls is not None:
        pages = pages.join(urls.select("url"), "url", "left_semi")
    return posting_offers(job_postings(pages))
