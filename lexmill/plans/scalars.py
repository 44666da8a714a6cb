"""Text functions, predicates and record filters, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.plans.base import Plans
from lexmill.session import table

plans = Plans()
QUERIES, SQL, query = plans.queries, plans.sql, plans.query

#: Types of concept, first match wins.
CONCEPT_TYPES = [("assessment", "task"), ("detection", "task"), ("recognition", "task"), ("tracking", "task"), ("monitoring", "purpose"),
                 ("screening", "purpose"), ("feedback", "purpose"), ("planning", "purpose"), ("recovery", "purpose")]
#: Weights of sections, the first name that occurs in a section's name wins.
SECTION_WEIGHTS = [("abstract", 0.4), ("introduction", 0.5), ("background", 0.5), ("related", 0.5), ("method", 0.9), ("result", 1.0),
                   ("discussion", 0.9), ("conclusion", 0.8)]
#: Words that tell Spanish.
SPANISH = [" el ", " la ", " los ", " las ", " que ", " del ", " una ", " con ", " para "]


@query("title_normalised", f"SELECT rec_id, {X.sql_title('title')} AS title, sha1({X.sql_title('title')}) AS title_sha1 FROM canonical")
def title_normalised(spark: SparkSession, sf: str) -> DataFrame:
    name = X.normalized_title(F.col("title"))
    return table(spark, sf, "canonical").select("rec_id", name.alias("title"), F.sha1(name).alias("title_sha1"))


@query("text_normalised", f"SELECT doc_id, md5({X.sql_text('text')}) AS text_md5, length({X.sql_text('text')}) AS n FROM documents")
def text_normalised(spark: SparkSession, sf: str) -> DataFrame:
    text = X.normalize_text(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.md5(text).alias("text_md5"), F.length(text).alias("n"))


@query("doi_normalised", f"SELECT rec_id, {X.sql_doi('doi')} AS doi FROM canonical")
def doi_normalised(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "canonical").select("rec_id", X.normalize_doi(F.col("doi")).alias("doi"))


@query(
    "integers_parsed",
    """SELECT rec_id, CASE WHEN regexp_matches(trim(pmid), '^[+-]?[0-9]+$') THEN try_cast(trim(pmid) AS INT) END AS pmid,
CASE WHEN regexp_matches(trim(source_id), '^[+-]?[0-9]+$') THEN try_cast(trim(source_id) AS INT) END AS source_id FROM canonical""",
)
def integers_parsed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "canonical").select("rec_id", X.safe_int(F.col("pmid")).alias("pmid"), X.safe_int(F.col("source_id")).alias("source_id"))


@query(
    "file_names",
    f"SELECT text_id, regexp_replace(regexp_replace({X.sql_plain('title')}, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS file_name, "
    "sha1(paper_id) || '.pdf' AS vault_name FROM papers",
)
def file_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "papers").select(
        "text_id", X.safe_filename(F.col("title")).alias("file_name"), F.concat(F.sha1("paper_id"), F.lit(".pdf")).alias("vault_name")
    )


@query(
    "keywords_split",
    """SELECT hit_id, list_filter(list_transform(CASE WHEN contains(keywords, ';') THEN string_split(keywords, ';')
WHEN contains(keywords, '|') THEN string_split(keywords, '|') ELSE string_split(keywords, ',') END, lambda x: trim(x)), lambda x: x <> '') AS keywords
FROM search_records WHERE keywords IS NOT NULL""",
)
def keywords_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "search_records").where(F.col("keywords").isNotNull())
    return rows.select("hit_id", X.split_keywords(F.col("keywords")).alias("keywords"))


@query(
    "abstract_prefixes",
    f"SELECT rec_id, md5(regexp_replace(trim(abstract), '(?i)^({'|'.join(X.ABSTRACT_PREFIXES)})[\\s:.—-]*', '')) AS abstract_md5 FROM canonical WHERE abstract IS NOT NULL",
)
def abstract_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "canonical").where(F.col("abstract").isNotNull())
    return rows.select("rec_id", F.md5(X.strip_prefixes(F.col("abstract"), X.ABSTRACT_PREFIXES)).alias("abstract_md5"))


_TOKENS = "list_filter(list_distinct(string_split({t}, ' ')), lambda x: length(x) >= 2)"
_OVERLAP = (
    f"CASE WHEN least(len({_TOKENS.format(t='a')}), len({_TOKENS.format(t='b')})) > 0 THEN "
    f"len(list_intersect({_TOKENS.format(t='a')}, {_TOKENS.format(t='b')})) / least(len({_TOKENS.format(t='a')}), len({_TOKENS.format(t='b')}))::DOUBLE ELSE 0.0 END"
)


@query(
    "title_overlap_audit",
    f"""WITH firsts AS (SELECT paper_id, arg_min(title, rec_id) FILTER (WHERE title IS NOT NULL) AS title FROM canonical GROUP BY paper_id), p AS (
  SELECT s.hit_id, {X.sql_title('s.title')} AS a, {X.sql_title('f.title')} AS b, f.title IS NULL AS unknown
  FROM search_records s LEFT JOIN firsts f ON s.paper_id = f.paper_id)
SELECT hit_id, round({_OVERLAP}, 6) AS overlap, CASE WHEN unknown THEN 'unknown' WHEN {_OVERLAP} < 0.5 THEN 'mismatch' ELSE 'ok' END AS status FROM p""",
)
def title_overlap_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Does a hit's title agree with that of the paper it names?"""
    canonical = table(spark, sf, "canonical")
    held = F.when(F.col("title").isNotNull(), F.col("rec_id"))
    firsts = canonical.groupBy("paper_id").agg(F.min_by("title", held).alias("known"))
    rows = table(spark, sf, "search_records").select("hit_id", "paper_id", "title").join(firsts, "paper_id", "left")
    overlap = X.token_overlap(F.col("title"), F.col("known"))
    status = F.when(F.col("known").isNull(), "unknown").when(overlap < 0.5, "mismatch").otherwise("ok")
    return rows.select("hit_id", F.round(overlap, 6).alias("overlap"), status.alias("status"))


@query(
    "domain_normalised",
    "SELECT rec_id, regexp_replace(regexp_replace(regexp_replace(lower(trim(doi)), '^[a-z]+://', ''), '[/:?#].*$', ''), '^www\\.', '') AS domain "
    "FROM canonical WHERE doi LIKE '%://%'",
)
def domain_normalised(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "canonical").where(F.col("doi").contains("://"))
    return rows.select("rec_id", X.domain_of(F.col("doi")).alias("domain"))


@query(
    "domain_blacklist",
    "SELECT rec_id, coalesce(contains(lower(doi), 'resolver.example') OR contains(lower(open_access), 'closed.example'), false) AS excluded FROM canonical",
)
def domain_blacklist(spark: SparkSession, sf: str) -> DataFrame:
    """A record is excluded if a listed domain occurs in any of its addresses."""
    domains = ["resolver.example"]
    found = F.coalesce(F.contains(F.lower("doi"), F.lit(domains[0])) | F.contains(F.lower("open_access"), F.lit("closed.example")), F.lit(False))
    return table(spark, sf, "canonical").select("rec_id", found.alias("excluded"))


@query(
    "preprint_ids",
    "SELECT rec_id, regexp_replace(regexp_replace(regexp_replace(trim(lower(doi)), '^.*/arxiv\\.', ''), '(?i)^arxiv:', ''), 'v[0-9]+$', '') AS preprint_id "
    "FROM canonical WHERE lower(doi) LIKE '%/arxiv.%'",
)
def preprint_ids(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "canonical").where(F.lower("doi").contains("/arxiv."))
    return rows.select("rec_id", X.arxiv_id(F.regexp_replace(F.trim(F.lower("doi")), r"^.*/arxiv\.", "")).alias("preprint_id"))


@query(
    "abstract_needs_recovery",
    """SELECT hit_id, abstract IS NULL OR abstract = '' OR contains(abstract, '…') OR rtrim(abstract) LIKE '%...' AS cut,
abstract IS NULL OR abstract = '' OR contains(abstract, '…') OR rtrim(abstract) LIKE '%...' OR length(abstract) < 100 AS poor FROM search_records""",
)
def abstract_needs_recovery(spark: SparkSession, sf: str) -> DataFrame:
    cut = X.needs_recovery(F.col("abstract"))
    return table(spark, sf, "search_records").select("hit_id", cut.alias("cut"), (cut | (F.length("abstract") < 100)).alias("poor"))


@query(
    "abstract_recovery",
    f"""WITH donors AS (
  SELECT {X.sql_doi('doi')} AS d, arg_min(abstract, rec_id) AS donor FROM canonical
  WHERE {X.sql_doi('doi')} <> '' AND length(abstract) >= 100 AND NOT contains(abstract, '…') AND NOT rtrim(abstract) LIKE '%...' GROUP BY d
), needy AS (
  SELECT hit_id, {X.sql_doi('doi')} AS d, abstract FROM search_records
  WHERE abstract IS NULL OR abstract = '' OR contains(abstract, '…') OR rtrim(abstract) LIKE '%...'
)
SELECT n.hit_id, md5(coalesce(donor, n.abstract)) AS abstract_md5, CASE WHEN donor IS NOT NULL THEN 'doi' WHEN n.abstract <> '' THEN 'own' ELSE 'none' END AS origin
FROM needy n LEFT JOIN donors USING (d)""",
)
def abstract_recovery(spark: SparkSession, sf: str) -> DataFrame:
    """Missing or cut abstracts are taken from a record with the same doi; where each came from is kept."""
    canonical, hits = table(spark, sf, "canonical"), table(spark, sf, "search_records")
    doi = X.normalize_doi(F.col("doi"))
    whole = (F.length("abstract") >= 100) & ~X.needs_recovery(F.col("abstract"))
    donors = canonical.where((doi != "") & whole).groupBy(doi.alias("d")).agg(F.min_by("abstract", "rec_id").alias("donor"))
    needy = hits.where(X.needs_recovery(F.col("abstract"))).select("hit_id", doi.alias("d"), "abstract")
    origin = F.when(F.col("donor").isNotNull(), "doi").when(F.col("abstract") != "", "own").otherwise("none")
    return needy.join(donors, "d", "left").select("hit_id", F.md5(F.coalesce("donor", "abstract")).alias("abstract_md5"), origin.alias("origin"))


@query(
    "sufficient_text",
    "SELECT rec_id, length(coalesce(title, '')) + length(coalesce(abstract, '')) AS n FROM canonical WHERE length(coalesce(title, '')) + length(coalesce(abstract, '')) >= 20",
)
def sufficient_text(spark: SparkSession, sf: str) -> DataFrame:
    n = F.length(F.coalesce("title", F.lit(""))) + F.length(F.coalesce("abstract", F.lit("")))
    return table(spark, sf, "canonical").select("rec_id", n.alias("n")).where("n >= 20")


@query(
    "corpus_quality",
    f"""WITH w AS (SELECT text_id, full_text, CASE WHEN {X.sql_text('full_text')} = '' THEN 0 ELSE len(string_split({X.sql_text('full_text')}, ' ')) END AS words FROM papers)
SELECT text_id, words, coalesce(length(full_text), 0) AS chars, words >= 300 AND coalesce(length(full_text), 0) >= 1500 AS kept, words < 500 AS low FROM w""",
)
def corpus_quality(spark: SparkSession, sf: str) -> DataFrame:
    words, chars = X.word_count(F.col("full_text")), F.coalesce(F.length("full_text"), F.lit(0))
    return table(spark, sf, "papers").select(
        "text_id", words.alias("words"), chars.alias("chars"), ((words >= 300) & (chars >= 1500)).alias("kept"), (words < 500).alias("low")
    )


_REF = {
    "initials": r"\b[A-Z]\.",
    "years": r"\b(?:19|20)[0-9]{2}\b",
    "surnames": r"\b[A-Z][a-z]+,\s*[A-Z]\.",
}


@query(
    "reference_like",
    rf"""WITH s AS (SELECT doc_id,
  (CASE WHEN len(regexp_extract_all(text, '{_REF['initials']}')) >= 4 THEN 2 ELSE 0 END)
  + (CASE WHEN len(regexp_extract_all(text, '{_REF['surnames']}')) >= 2 THEN 2 ELSE 0 END)
  + (CASE WHEN len(regexp_extract_all(text, '{_REF['years']}')) >= 3 THEN 1 ELSE 0 END)
  + (CASE WHEN contains(text, 'et al.') THEN 1 ELSE 0 END)
  + (CASE WHEN regexp_matches(lower(text), 'doi|https?://') THEN 1 ELSE 0 END)
  + (CASE WHEN regexp_matches(lower(text), '\b(vol|no|pp)\.') THEN 1 ELSE 0 END)
  + (CASE WHEN regexp_matches(lower(text), '\b(proceedings|conference|symposium|journal|transactions)\b') THEN 1 ELSE 0 END) AS score
  FROM documents WHERE text IS NOT NULL)
SELECT doc_id, score, score >= 4 AS is_reference FROM s""",
)
def reference_like(spark: SparkSession, sf: str) -> DataFrame:
    """Is a passage part of a reference list? Several signs have to come together."""
    text, low = F.col("text"), F.lower("text")

    def many(pattern: str, least: int, points: int):
        return F.when(F.regexp_count(text, F.lit(pattern)) >= least, points).otherwise(0)

    def has(condition):
        return F.when(condition, 1).otherwise(0)

    score = (
        many(_REF["initials"], 4, 2) + many(_REF["surnames"], 2, 2) + many(_REF["years"], 3, 1) + has(text.contains("et al."))
        + has(low.rlike("doi|https?://")) + has(low.rlike(r"\b(vol|no|pp)\.")) + has(low.rlike(r"\b(proceedings|conference|symposium|journal|transactions)\b"))
    )
    return table(spark, sf, "documents").where(text.isNotNull()).select("doc_id", score.alias("score"), (score >= 4).alias("is_reference"))


@query(
    "claim_score",
    f"SELECT evidence_id, {X.sql_hits('text', X.CLAIM_STEMS)} + least({X.sql_hits('text', ['gait', 'pain', 'sleep', 'walking', 'balance', 'grip'])}, 5) AS score FROM evidences",
)
def claim_score(spark: SparkSession, sf: str) -> DataFrame:
    focus = F.least(X.hits(F.col("text"), ["gait", "pain", "sleep", "walking", "balance", "grip"]), F.lit(5))
    return table(spark, sf, "evidences").select("evidence_id", (X.hits(F.col("text"), X.CLAIM_STEMS) + focus).alias("score"))


_NOISE = ["copyright", "permission", "proceedings", "doi:", "http://", "https://", "www.", "et al.", "fig.", "table", "reference"]
_WORDS = f"CASE WHEN {X.sql_text('text')} = '' THEN 0 ELSE len(string_split({X.sql_text('text')}, ' ')) END"


@query("noise_filter", f"SELECT evidence_id, ({X.sql_hits('text', _NOISE)} > 0 AND {_WORDS} < 40) OR {_WORDS} < 20 AS noise FROM evidences")
def noise_filter(spark: SparkSession, sf: str) -> DataFrame:
    words = X.word_count(F.col("text"))
    noise = ((X.hits(F.col("text"), _NOISE) > 0) & (words < 40)) | (words < 20)
    return table(spark, sf, "evidences").select("evidence_id", noise.alias("noise"))


def _case(value: str, steps, default: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({value}, '{w}') THEN {r!r}" for w, r in steps) + f" ELSE {default} END"


@query("section_weights", f"SELECT evidence_id, {_case('lower(coalesce(section, chr(0)))', SECTION_WEIGHTS, '0.7')}::DOUBLE AS weight FROM evidences")
def section_weights(spark: SparkSession, sf: str) -> DataFrame:
    weight = X.ladder(F.lower(F.coalesce("section", F.lit(""))), SECTION_WEIGHTS, 0.7)
    return table(spark, sf, "evidences").select("evidence_id", weight.alias("weight"))


@query("concept_types", f"SELECT concept_id, {_case('lower(concept_name)', CONCEPT_TYPES, chr(39) + 'general' + chr(39))} AS kind FROM concepts")
def concept_types(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "concepts").select("concept_id", X.ladder(F.lower("concept_name"), CONCEPT_TYPES, "general").alias("kind"))


@query(
    "looks_spanish",
    "SELECT doc_id, length(regexp_replace(lower(text), '[^áéíóúñü¿¡]', '', 'g')) >= 3 OR "
    + X.sql_hits("text", SPANISH) + " >= 3 AS spanish FROM documents WHERE text IS NOT NULL",
)
def looks_spanish(spark: SparkSession, sf: str) -> DataFrame:
    marks = F.length(F.regexp_replace(F.lower("text"), "[^áéíóúñü¿¡]", "")) >= 3
    return table(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", (marks | (X.hits(F.col("text"), SPANISH) >= 3)).alias("spanish"))


@query("first_words", f"SELECT text_id, md5(array_to_string(list_slice(string_split({X.sql_text('full_text')}, ' '), 1, 50), ' ')) AS head_md5 FROM papers")
def first_words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "papers").select("text_id", F.md5(X.first_words(F.col("full_text"), 50)).alias("head_md5"))


@query(
    "citation_markers",
    r"""SELECT doc_id, list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(text, '\[([0-9]{1,4})\]', 1), lambda x: x::INT), lambda x: x BETWEEN 1 AND 30))) AS cited
FROM documents WHERE text IS NOT NULL""",
)
def citation_markers(spark: SparkSession, sf: str) -> DataFrame:
    """Cited numbers that exist; markers out of range are dropped."""
    found = F.transform(F.regexp_extract_all("text", F.lit(r"\[([0-9]{1,4})\]"), 1), lambda x: x.cast("int"))
    cited = F.array_sort(F.array_distinct(F.filter(found, lambda x: x.between(1, 30))))
    return table(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", cited.alias("cited"))


@query(
    "document_text",
    "SELECT rec_id, md5(concat_ws(chr(10), 'TITLE: ' || coalesce(title, ''), 'ABSTRACT: ' || coalesce(abstract, ''), 'KEYWORDS: ' || coalesce(array_to_string(keywords, ' '), ''))) AS text_md5 FROM canonical",
)
def document_text(spark: SparkSession, sf: str) -> DataFrame:
    """The text that a record is embedded with."""
    parts = [F.concat(F.lit("TITLE: "), F.coalesce("title", F.lit(""))), F.concat(F.lit("ABSTRACT: "), F.coalesce("abstract", F.lit(""))),
             F.concat(F.lit("KEYWORDS: "), F.coalesce(F.array_join("keywords", " "), F.lit("")))]
    return table(spark, sf, "canonical").select("rec_id", F.md5(F.concat_ws("\n", *parts)).alias("text_md5"))


@query(
    "venue_from_doi",
    f"""SELECT rec_id, string_split(array_last(string_split({X.sql_doi('doi')}, '/')), '.')[1] AS kind, try_cast(string_split(array_last(string_split({X.sql_doi('doi')}, '/')), '.')[2] AS INT) AS doi_year
FROM canonical WHERE {X.sql_doi('doi')} LIKE '%/%'""".replace("array_last(", "list_last("),
)
def venue_from_doi(spark: SparkSession, sf: str) -> DataFrame:
    """What the last part of a doi tells: its first component names the kind of venue."""
    doi = X.normalize_doi(F.col("doi"))
    parts = F.split(F.element_at(F.split(doi, "/"), -1), r"\.")
    return table(spark, sf, "canonical").where(doi.contains("/")).select("rec_id", parts[0].alias("kind"), F.get(parts, F.lit(1)).try_cast("int").alias("doi_year"))


plans.integers({"text_normalised": ["n"], "sufficient_text": ["n"], "corpus_quality": ["words", "chars"]})
