import json
from datetime import datetime, timezone
from html.entities import html5

from pyspark.sql import functions as F

from offerscope import schemas
from offerscope.sources import jsonld, landing, payloads
from offerscope.sources.places import DEFAULT_PLACES, read_cities
from offerscope.vocab.places import CITY_CSV


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_aggregator(spark, tmp_path):
    full = {"id": 11, "title": "Ingénieure Spark", "description": "Flux", "created": "2026-09-20T09:00:00Z",
            "location": {"display_name": "Metz, Moselle", "area": ["France", "Grand Est", "moselle", "METZ"]},
            "company": {"display_name": "Atelier Nord"}, "salary_min": 51000, "salary_max": 57000, "salary_is_predicted": "0",
            "contract_type": "permanent", "contract_time": "full_time", "category": {"label": "IT Jobs"}, "latitude": 45.76}
    bare = {"id": "12", "title": "Data Analyst", "location": {"display_name": "Paris"}, "salary_min": 41007.5,
            "salary_max": 41007.5, "salary_is_predicted": "1"}
    path = write(tmp_path / "page.json", json.dumps({"count": 3, "results": [full, bare, {"id": "13"}]}, indent=1))
    a, b, c = payloads.read_aggregator(spark, path, "data engineer").orderBy("source_id").collect()
    assert (a.source, a.source_id, a.company, a.location_raw) == ("adzuna", "11", "Atelier Nord", "Metz, Moselle, Grand Est")
    assert (a.salary_min_raw, a.salary_max_raw, a.salary_unit_raw) == (51000, 57000, "year")
    assert a.contract_raw == "permanent full_time" and a.search_keyword == "data engineer" and a.is_demo is False
    assert (b.salary_min_raw, b.salary_max_raw, b.salary_unit_raw, b.contract_raw, b.location_raw) == (None, None, None, None, "Paris")
    assert (c.title, c.description, c.location_raw, c.salary_unit_raw) == ("", "", None, "year")


def test_employment(spark, tmp_path):
    full = {"id": "A1", "intitule": "Statisticien", "description": "Enquêtes.", "dateCreation": "2026-08-03T08:00:00.000Z",
            "lieuTravail": {"libelle": "57 - METZ", "latitude": 49.12}, "entreprise": {"nom": "EXEMPLE"}, "typeContrat": "CDI",
            "typeContratLibelle": "Contrat à durée indéterminée", "experienceLibelle": "4 An(s)",
            "salaire": {"libelle": "Mensuel de 2300.0 Euros"}, "competences": [{"libelle": "Sonder"}, {"libelle": "SAS"}]}
    bare = {"id": "A2", "intitule": "Alternance", "entreprise": {}, "typeContrat": "CDD", "salaire": {"commentaire": "Selon profil"}}
    path = write(tmp_path / "page.json", json.dumps({"resultats": [full, bare]}))
    a, b = payloads.read_employment(spark, path).orderBy("source_id").collect()
    assert a.location_raw == "57 - METZ" and a.description == "Enquêtes.\nCompétences : Sonder, SAS"
    assert (a.contract_raw, a.salary_raw, a.experience_raw) == ("Contrat à durée indéterminée", "Mensuel de 2300.0 Euros", "4 An(s)")
    assert (b.description, b.company, b.contract_raw, b.salary_raw) == ("", None, "CDD", "Selon profil")


PAGE = """<html><body><p>Offres</p>
<script type="application/ld+json">[{"@type": "BreadcrumbList"}, {"@type": "JobPosting", "title": "Statisticienne",
 "description": "<ul><li>R &amp; SAS</li><li>caf&eacute;&#39;&#xE9; &rien; &amp;gt;</li></ul>", "identifier": {"value": "ST/7"},
 "jobLocation": {"address": {"addressLocality": "Brest", "addressRegion": "Bretagne"}},
 "baseSalary": {"value": {"minValue": 29500, "maxValue": 31250, "unitText": "YEAR"}}}]</script>
<script type="application/ld+json">{"@type": </script></body></html>"""


def wrap(*objects):
    return "".join(f"<SCRIPT id=x type='application/ld+json'>{json.dumps(o)}</SCRIPT>" for o in objects)


def test_postings(spark):
    pages = spark.createDataFrame([("https://jobs.example/7", PAGE)], "url string, html string")
    (r,) = jsonld.offers_from_pages(pages).collect()
    assert (r.title, r.source_id, r.location_raw) == ("Statisticienne", "ST/7", "Brest, Bretagne")
    assert (r.salary_min_raw, r.salary_max_raw, r.salary_unit_raw) == (29500, 31250, "YEAR")
    assert r.description == "R & SAS café'é &rien &gt;"


def test_posting_shapes(spark):
    job = {"@type": ["Thing", "JobPosting"], "title": "T"}
    rows = [
        ("u1", wrap([job | {"jobLocation": [{"address": "Lyon"}], "hiringOrganization": "Seule", "identifier": 77}])),
        ("u2", wrap(job | {"baseSalary": {"value": 2500, "unitText": "MONTH"}, "employmentType": ["A", "B"], "industry": ["x"]})),
        ("u3", wrap(job | {"baseSalary": {"value": "41000"}, "jobLocationType": "TELECOMMUTE",
                           "experienceRequirements": {"monthsOfExperience": 30}})),
        ("u4", wrap([[{"@graph": {"@graph": [job | {"experienceRequirements": "3 ans", "baseSalary": 5}]}}]])),
        ("u5", wrap(job, job) + wrap({"@type": "Thing"})),
        ("u6", "<!--" + wrap(job) + "--><script>var x = 1</script><p>ld+json</p>"),
        ("u7", wrap(job | {"baseSalary": {"value": {"value": 30000, "minValue": 0}}, "identifier": {"value": ""}})),
    ]
    out = jsonld.offers_from_pages(spark.createDataFrame(rows, "url string, html string"))
    got = {}
    for r in out.collect():
        got.setdefault(r.url, []).append(r)
    assert {u: len(v) for u, v in got.items()} == {"u1": 1, "u2": 1, "u3": 1, "u4": 1, "u5": 2, "u7": 1}
    one = {u: v[0] for u, v in got.items()}
    assert (one["u1"].location_raw, one["u1"].company, one["u1"].source_id) == ("Lyon", "Seule", "77")
    assert (one["u2"].salary_min_raw, one["u2"].salary_unit_raw, one["u2"].contract_raw, one["u2"].sector_raw) == (2500, "MONTH", "A, B", None)
    assert (one["u3"].salary_max_raw, one["u3"].remote_raw, one["u3"].experience_raw) == (41000, "TELECOMMUTE", "2 ans")
    assert (one["u4"].experience_raw, one["u4"].salary_min_raw) == ("3 ans", None)
    assert len(one["u5"].source_id) == 16 and (one["u7"].salary_min_raw, one["u7"].salary_max_raw) == (30000, 30000)


def test_deeper_nesting_is_found_too(spark):
    deep = {"@type": "JobPosting", "title": "T"}
    for _ in range(9):
        deep = [{"@type": "WebPage", "@graph": [deep]}]
    pages = spark.createDataFrame([("u1", wrap(deep)), ("u2", wrap({"@type": "JobPosting", "title": "S"}))], "url string, html string")
    assert sorted((r.url, r.title) for r in jsonld.offers_from_pages(pages).collect()) == [("u1", "T"), ("u2", "S")]


def test_url_list(spark, tmp_path):
    path = write(tmp_path / "urls.txt", "# commentaire\n\nhttps://a.fr/1\n  https://b.fr/2  \n")
    assert sorted(r.url for r in jsonld.read_urls(spark, path).collect()) == ["https://a.fr/1", "https://b.fr/2"]


def test_landing(spark, tmp_path):
    raw = str(tmp_path / "raw")
    rows = spark.createDataFrame([("s", str(i), f"Data Analyst {i}") for i in range(3)], "source string, source_id string, title string")
    landing.write_landing(rows, raw, datetime(2026, 9, 1, tzinfo=timezone.utc))
    write(tmp_path / "raw" / "other" / "other_20260901_000000.jsonl",
          '{"source": "o", "source_id": 9, "title": "x", "salary_min_raw": 1}\n\n{"source": "o", "source_id": "10"}\n')
    got = landing.read_landing(spark, raw)
    assert sorted(r.source_id for r in got.collect()) == ["0", "1", "10", "2", "9"]
    last = got.where("source = 'o'").orderBy(*landing.ARRIVAL).collect()
    assert [r.source_id for r in last] == ["9", "10"] and last[1].title is None
    assert [f.name for f in got.schema.fields][:21] == schemas.RAW.fieldNames()


def test_city_reference_from_csv(spark, tmp_path):
    path = write(tmp_path / "cities.csv", "city,dept_code,region,latitude,longitude\n" + CITY_CSV)
    read, fixed = (places.city_table(spark) for places in (read_cities(spark, path), DEFAULT_PLACES))
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, fixed.collect())) and fixed.count() == 57
    regions = [sorted(map(tuple, p.department_table(spark).collect())) for p in (read_cities(spark, path), DEFAULT_PLACES)]
    assert regions[0] == regions[1]


def test_every_named_reference_of_html_5(spark):
    """Whole names with and without a semicolon, before a blank, a tag and another reference; others stay."""
    whole = {name.rstrip(";"): char for name, char in html5.items()}
    texts = {f"x&{name}{tail[0]}": f"x{char}{tail[1]}" for name, char in whole.items() for tail in ((";", ""), ("", ""), (";q", "q"), ("&lt;y", "<y"))}
    texts |= {"&nosuchname; &; & &#38;amp; &AMP;amp;": "&nosuchname &; & &amp; &amp;"}
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("got", jsonld.html_to_text(F.col("t")))
    assert [tuple(r) for r in df.collect() if r["got"].strip() != texts[r["t"]].strip()] == []


def test_postings_thirty_levels_deep(spark):
    """Lists and graphs within each other, deeper than one pass reaches; postings on several levels are all found once."""
    value = {"@type": "JobPosting", "title": "unten"}
    for level in range(30):
        value = {"@graph": [value, {"@type": "JobPosting", "title": f"t{level}"}]} if level % 2 else [value]
    page = f'<script type="application/ld+json">{json.dumps(value)}</script>'
    flat = '<script type="application/ld+json">{"@type": ["Thing", "JobPosting"], "title": "oben"}</script>'
    pages = spark.createDataFrame([("u", page), ("v", flat), ("w", "none"), ("x", None)], "url string, html string")
    got = jsonld.job_postings(pages)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    titles = [(r["url"], r["t"]) for r in got.select("url", F.try_variant_get("posting", "$.title", "string").alias("t")).collect()]
    assert sorted(titles) == sorted([("u", "unten"), ("v", "oben"), *(("u", f"t{i}") for i in range(1, 30, 2))])
