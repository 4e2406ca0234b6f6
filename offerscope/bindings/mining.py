"""Skill extraction and characteristic terms on the document tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from offerscope.bindings.registry import half_up, query, table
from offerscope.operators import phrases as PH, skills as S, terms as T
from offerscope.operators.skew import explode_computed
from offerscope.session import shared_dir
from offerscope.vocab.skills import Skill
from offerscope.vocab.stopwords import FRENCH, RECRUITMENT


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


# A small dictionary over the words of the documents: plain, optional ending, look-ahead, case-sensitive, several words.
WORDS = (
    Skill("the", "en", "tech", ("the",)), Skill("erth", "en", "tech", ("erth", "therth")),
    Skill("un/une", "fr", "tech", ("une?",)), Skill("Is", "en", "skill", ("Is",), case_sensitive=True),
    Skill("of the", "en", "skill", ("of the", "to the")), Skill("réé", "fr", "skill", ("ré", "éré")),
    Skill("der", "de", "tech", ("der(?! die)",)), Skill("el/la", "es", "skill", ("el", "la")),
)
_EDGE, _END = r"(^|[^\p{L}\p{N}_+#])", r"([^\p{L}\p{N}_+#]|$)"
_LOWERED = r"LOWER(STRIP_ACCENTS(source || chr(10) || text))"
_CASED = r"STRIP_ACCENTS(source || chr(10) || text)"


def _found(pattern: str, text: str = "t") -> str:
    return f"regexp_matches({text}, '{_EDGE}({pattern}){_END}')"


# RE2 has no look-ahead: "der" counts when some occurrence is not followed by " die".
_EXTRACTED = f"""
SELECT doc_id, 'the' AS skill, 'en' AS category, 'tech' AS skill_type FROM d WHERE {_found('the')}
UNION ALL SELECT doc_id, 'erth', 'en', 'tech' FROM d WHERE {_found('erth|therth')}
UNION ALL SELECT doc_id, 'un/une', 'fr', 'tech' FROM d WHERE {_found('une?')}
UNION ALL SELECT doc_id, 'Is', 'en', 'skill' FROM d WHERE {_found('Is', 'raw')}
UNION ALL SELECT doc_id, 'of the', 'en', 'skill' FROM d WHERE {_found('of the|to the')}
UNION ALL SELECT doc_id, 'réé', 'fr', 'skill' FROM d WHERE {_found('re|ere')}
UNION ALL SELECT doc_id, 'der', 'de', 'tech' FROM d
  WHERE {_found('der', "REPLACE(t, 'der die', ' ')")}
UNION ALL SELECT doc_id, 'el/la', 'es', 'skill' FROM d WHERE {_found('el|la')}"""


@query("skill_extract", f"WITH d AS (SELECT doc_id, {_LOWERED} AS t, {_CASED} AS raw FROM documents) {_EXTRACTED}")
def skill_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long bridge (document, skill) with category and type, over whole texts."""
    cited = S.with_skills(documents(spark, sf_dir), ["source", "text"], WORDS)
    return S.labelled_links(cited, "doc_id", WORDS)


@query("skill_phrases", f"WITH d AS (SELECT doc_id, {_LOWERED} AS t, {_CASED} AS raw FROM documents) {_EXTRACTED}")
def skill_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bridge with the dictionary as a table: written to a file, read back, and met by a join."""
    path = shared_dir(spark, "dictionary")
    PH.as_table(spark, WORDS).write.json(path)
    return PH.extract(documents(spark, sf_dir), "doc_id", ["source", "text"], PH.read_dictionary(spark, path))


# Own sentences around entries of the dictionary, and what each must yield in dictionary order.
_ITEMS = ["Outils du poste : snowflake/DBT, Docker puis Kubernetes", "R, SAS et Matlab pour nos statisticiens", "Rust, Go et C++ au quotidien",
          "nous migrons d’Azure vers GCP avec Terraform", "Scrum, mode agile, GIT ; SQLite", "reporting Excel hebdomadaire",
          "aucun outil imposé", "PySpark + Scala sur Databricks, requêtes sql"]
_FOUND = [["Snowflake", "dbt", "Docker", "Kubernetes"], ["R", "SAS"], [], ["Azure", "GCP"], ["Git", "Agile/Scrum"],
          ["Excel", "KPI & reporting"], [], ["SQL", "Scala", "Spark", "Databricks"]]


@query("skill_dictionary", "SELECT p_partkey, CAST(CASE p_partkey % 8 " + " ".join(
    f"WHEN {i} THEN '{', '.join(v)}'" for i, v in enumerate(_FOUND)) + " END AS VARCHAR) AS skills FROM part")
def skill_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default dictionary, in dictionary order, on adverts written from the part names."""
    text = F.element_at(F.array(*[F.lit(t) for t in _ITEMS]), (F.col("p_partkey") % 8 + 1).cast("int"))
    adverts = table(spark, sf_dir, "part").select("p_partkey", "p_name", text.alias("text"))
    return S.with_skills(adverts, ["p_name", "text"]).select("p_partkey", F.array_join("skills", ", ").alias("skills"))


STOP = FRENCH | RECRUITMENT


def _in_sql(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(words)) + ")"


def tokens_sql(source: str, doc: str, group: str, text: str, stop) -> str:
    # "ß" is the one word character RE2 does not treat as such: nothing starts inside the word it belongs to.
    return rf"""
segments AS (SELECT {doc} AS doc_id, {group} AS lang, UNNEST(STRING_SPLIT_REGEX(STRIP_ACCENTS(LOWER({text})), '[,.;:!?()\n•|]+')) AS s
             FROM {source}),
lists AS (SELECT doc_id, lang, LIST_FILTER(REGEXP_EXTRACT_ALL(REGEXP_REPLACE(s, 'ß[a-z0-9_ß]*', ' ', 'g'),
            '\b[a-z][a-z0-9+#/\-]*[a-z0-9+#]'), lambda t: t NOT IN {_in_sql(stop)}) AS tokens FROM segments)"""


def grams_sql(*source) -> str:
    return f"""{tokens_sql(*source)},
grams AS (SELECT doc_id, lang, UNNEST(tokens) AS term FROM lists UNION ALL
          SELECT doc_id, lang, UNNEST(LIST_TRANSFORM(RANGE(1, LEN(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]))
          FROM lists WHERE LEN(tokens) > 1)"""


def terms_sql(source: str, doc: str, group: str, text: str, stop) -> str:
    """The steps from `grams` to `kept` and `ranked_terms`, as common table expressions."""
    return f"""{grams_sql(source, doc, group, text, stop)},
tf AS (SELECT doc_id, lang, term, COUNT(*) AS tf FROM grams GROUP BY 1, 2, 3),
n AS (SELECT COUNT(*) AS n FROM {source}),
df AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term HAVING COUNT(*) >= 3 AND COUNT(*) <= 0.6 * (SELECT n FROM n)),
w AS (SELECT doc_id, lang, term, (1 + LN(tf)) * (LN((1.0 + (SELECT n FROM n)) / (1.0 + df)) + 1) AS w FROM tf JOIN df USING (term)),
u AS (SELECT lang, term, w / SQRT(SUM(w * w) OVER (PARTITION BY doc_id)) AS w FROM w),
size AS (SELECT {group} AS lang, COUNT(*) AS docs FROM {source} GROUP BY 1 HAVING COUNT(*) >= 3),
score AS (SELECT lang, term, SUM(w) / docs AS score FROM u JOIN size USING (lang) GROUP BY lang, term, docs),
best AS (SELECT *, CAST(score AS DECIMAL(30,10)) AS o FROM score WHERE score > 0
         QUALIFY ROW_NUMBER() OVER (PARTITION BY lang ORDER BY CAST(score AS DECIMAL(30,10)) DESC, term DESC) <= 75),
carried AS (SELECT lang, word, MAX(o) AS carrier FROM (SELECT lang, o, UNNEST(STRING_SPLIT(term, ' ')) AS word FROM best
            WHERE CONTAINS(term, ' ')) GROUP BY 1, 2),
kept AS (SELECT b.* FROM best b LEFT JOIN carried c ON c.lang = b.lang AND c.word = b.term
         WHERE CONTAINS(b.term, ' ') OR c.carrier IS NULL OR c.carrier < 0.9 * b.o),
ranked_terms AS (SELECT lang, term, {half_up('score', 5)} AS tfidf_score,
         ROW_NUMBER() OVER (PARTITION BY lang ORDER BY o DESC, term DESC) AS rank FROM kept QUALIFY rank <= 25)"""


_DOCUMENTS = ("documents", "doc_id", "lang", "text", STOP)
_TOKENS, _GRAMS = tokens_sql(*_DOCUMENTS), grams_sql(*_DOCUMENTS)


@query("token_counts", f"WITH {_TOKENS} SELECT lang, term, COUNT(*) AS n FROM (SELECT lang, UNNEST(tokens) AS term FROM lists) GROUP BY 1, 2")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = F.flatten(T.tokens_by_segment(F.col("text"), STOP))
    return explode_computed(documents(spark, sf_dir), ["lang"], tokens, "term") \
        .groupBy("lang", "term").agg(F.count(F.lit(1)).alias("n"))


@query("gram_counts", f"WITH {_GRAMS} SELECT doc_id, term, COUNT(*) AS tf FROM grams GROUP BY 1, 2")
def gram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uni- and bigrams inside segments, repeats kept: the term frequencies of every document."""
    return T.term_frequencies(documents(spark, sf_dir), "doc_id", "lang", "text", STOP) \
        .select("doc_id", "term", "tf")


@query("tfidf_by_group", f"WITH {terms_sql(*_DOCUMENTS)} SELECT * FROM ranked_terms")
def tfidf_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.top_terms(documents(spark, sf_dir), "doc_id", "lang", "text", STOP)


@query("tfidf_guards", f"""WITH {terms_sql(*_DOCUMENTS)} SELECT 'whole' AS input, COUNT(*) AS terms FROM ranked_terms
UNION ALL SELECT 'no documents', 0 UNION ALL SELECT 'empty texts', 0 UNION ALL SELECT 'no text twice', 0""")
def tfidf_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs without documents, without text, or without a term that enough documents share give no rows, of the same columns."""
    docs = documents(spark, sf_dir)
    inputs = {"whole": docs, "no documents": docs.where("doc_id is null"), "empty texts": docs.withColumn("text", F.lit("")),
              "no text twice": docs.withColumn("text", F.concat(F.lit("wort"), F.translate(F.col("doc_id").cast("string"), "0123456789", "abcdefghij")))}
    counts = [T.top_terms(table, "doc_id", "lang", "text", STOP).select("lang", "term", "tfidf_score", "rank").agg(
        F.count(F.lit(1)).alias("terms")).select(F.lit(name).alias("input"), "terms") for name, table in inputs.items()]
    return reduce(DataFrame.unionByName, counts)
