"""Texts of whole papers: reference tails, enriched texts, extractions computed once, exhaustive retrieval, news and file indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.plans.base import Plans
from lexmill.session import table

plans = Plans()
QUERIES, SQL, query = plans.queries, plans.sql, plans.query

#: Headings of bibliographies, and what shows that a text is one.
HEADING = (
    r"(?i)(?:[.!?]\s+|\n|^)(?:references|bibliography|works cited|literature cited|references and notes|reference list)\s*(?=[A-Z0-9\[\(]|et al|\d)"
)
CITED = (
    r"(?i)\b(?:doi|et al\.|vol\.|pp\.|journal|transactions|proceedings|conference|symposium|springer|elsevier|ieee)\b|\[[0-9]{1,3}\]|https?://"
)
YEARS, SURNAMES, YEARS_IN_BRACKETS = r"\b(?:19|20)\d{2}\b", r"\b[A-Z][a-z]{1,},\s*[A-Z]\.", r"\(\d{4}[a-z]?\)"
SHORT_TAIL, PROBED = 80, 1500
#: Words of a favourable and of an unfavourable tone, and parties.
FAVOURABLE = ("good", "great", "excellent", "positive", "success", "benefit", "improve")
UNFAVOURABLE = ("bad", "poor", "negative", "risk", "danger", "fail", "loss", "critic")
PARTIES = ("government", "company", "industry", "academia", "consumer", "regulator")
#: Sections in the order in which they join an enriched text, and the limits of its parts.
SECTIONS = ("methodology", "methods", "results", "findings", "conclusion", "introduction", "discussion")
LEAST_TEXT, LEAST_SECTION, MOST_SECTION = 500, 100, 8000


def without_reference_tail(text: Column) -> Column:
    """The text up to the first heading of a bibliography that is followed by one, or by next to nothing.

    The pieces between the headings and the headings themselves give every heading's place, in one pass in the JVM.
    """
    heads = F.regexp_extract_all(text, F.lit(HEADING), F.lit(0))
    pieces = F.split(text, HEADING, -1)
    number = lambda tail, pattern: F.size(F.regexp_extract_all(tail, F.lit(pattern), F.lit(0)))

    def bibliography(tail: Column) -> Column:
        cited = (number(tail, CITED) >= 2) | (number(tail, SURNAMES) >= 3) | (number(tail, YEARS_IN_BRACKETS) >= 3)
        return (F.length(tail) < SHORT_TAIL) | ((number(tail, YEARS) >= 3) & cited)

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["piece"])
        end = start + F.length(x["head"])
        tail = F.substr(text, end + 1, F.lit(PROBED))
        cut = F.when(state["cut"] >= 0, state["cut"]).when(bibliography(tail), start).otherwise(-1)
        return F.struct(end.alias("at"), cut.alias("cut"))

    pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(heads)), heads, lambda p, h: F.struct(p.alias("piece"), h.alias("head")))
    cut = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.lit(-1).alias("cut")), step)["cut"]
    return F.when((F.size(heads) > 0) & (cut >= 0), F.regexp_replace(F.substr(text, F.lit(1), cut), r"\s+$", "")).otherwise(text)


@query("reference_tail")
def reference_tail(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "papers").where(F.col("full_text").isNotNull())
    kept = without_reference_tail(F.col("full_text"))
    return rows.select("text_id", F.length(kept).alias("kept"), F.md5(kept).alias("text_md5"))


@query(
    "question_papers_exhaustive",
    """SELECT concept_id, doc_id, round(max(similarity), 4) AS best, count(*) AS n, list(evidence_id ORDER BY similarity DESC, evidence_id) AS passages
FROM evidences WHERE similarity BETWEEN 0.35 AND 1 AND doc_id IS NOT NULL GROUP BY concept_id, doc_id""",
)
def question_papers_exhaustive(spark: SparkSession, sf: str) -> DataFrame:
    """Of each question all papers with a passage above the threshold, their passages best first."""
    near = table(spark, sf, "evidences").where(F.col("similarity").between(0.35, 1.0) & F.col("doc_id").isNotNull())
    found = F.array_sort(F.collect_list(F.struct((-F.col("similarity")).alias("s"), "evidence_id")))
    return near.groupBy("concept_id", "doc_id").agg(
        F.round(F.max("similarity"), 4).alias("best"), F.count("*").alias("n"), F.transform(found, lambda x: x["evidence_id"]).alias("passages")
    )


@query(
    "paper_extraction_joined",
    r"""WITH p AS (SELECT paper_id, min(text_id) AS text_id FROM papers WHERE full_text IS NOT NULL GROUP BY paper_id),
x AS (SELECT p.paper_id, nullif(regexp_extract(t.full_text, '([0-9]+(?:\.[0-9]+)?)%', 1), '')::DOUBLE AS percent, regexp_matches(lower(t.full_text), 'limitations include') AS limits FROM p JOIN papers t USING (text_id))
SELECT e.evidence_id, x.percent, coalesce(x.limits, false) AS limits FROM evidences e LEFT JOIN x ON e.doc_id = x.paper_id""",
)
def paper_extraction_joined(spark: SparkSession, sf: str) -> DataFrame:
    """What is extracted from a paper is worked out once for each paper, then joined with all of its passages."""
    papers = table(spark, sf, "papers").where(F.col("full_text").isNotNull())
    first = papers.groupBy("paper_id").agg(F.min("text_id").alias("text_id"))
    found = first.join(papers.select("text_id", "full_text"), "text_id").select(
        F.col("paper_id").alias("doc_id"), F.nullif(F.regexp_extract("full_text", r"([0-9]+(?:\.[0-9]+)?)%", 1), F.lit("")).cast("double").alias("percent"),
        F.lower("full_text").rlike("limitations include").alias("limits"),
    )
    joined = table(spark, sf, "evidences").select("evidence_id", "doc_id").join(found, "doc_id", "left")
    return joined.select("evidence_id", "percent", F.coalesce("limits", F.lit(False)).alias("limits"))


def enriched_text(clean: Column, sections: Column, contributions: Column, takeaway: Column) -> Column:
    """A paper's text, its sections by priority, and what is known of it as sections of their own; short parts are left out."""
    parts = [F.when(F.length(clean) > LEAST_TEXT, F.substring(clean, 1, 2 * MOST_SECTION))]
    for name in SECTIONS:
        text = F.try_element_at(sections, F.lit(name))
        parts.append(F.when(F.length(text) > LEAST_SECTION, F.substring(text, 1, MOST_SECTION)))
    listed = F.array_join(F.transform(contributions, lambda c: F.concat(F.lit("- "), c)), "\n")
    parts.append(F.when(F.size(contributions) > 0, F.concat(F.lit("CONTRIBUTIONS:\n"), listed)))
    parts.append(F.when(takeaway != "", F.concat(F.lit("TAKEAWAY: "), takeaway)))
    return F.concat_ws("\n\n", *parts)


@query(
    "enriched_papers",
    "WITH k AS (SELECT paper_id, min(rec_id) AS rec_id FROM canonical GROUP BY paper_id), c AS (SELECT k.paper_id, r.keywords FROM k JOIN canonical r USING (rec_id)),\n"
    "p AS (SELECT t.text_id, t.title, t.clean_text, t.clean_sections AS s, c.keywords FROM papers t LEFT JOIN c USING (paper_id))\n"
    "SELECT text_id, md5(concat_ws(chr(10) || chr(10), CASE WHEN length(clean_text) > 500 THEN left(clean_text, 16000) END, "
    + ", ".join(f"CASE WHEN length(s['{n}']) > 100 THEN left(s['{n}'], 8000) END" for n in ("methodology", "methods", "results", "findings", "conclusion", "introduction", "discussion"))
    + ", CASE WHEN len(keywords) > 0 THEN 'CONTRIBUTIONS:' || chr(10) || array_to_string(list_transform(keywords, lambda x: '- ' || x), chr(10)) END, CASE WHEN title <> '' THEN 'TAKEAWAY: ' || title END)) AS text_md5 FROM p",
)
def enriched_papers(spark: SparkSession, sf: str) -> DataFrame:
    first = table(spark, sf, "canonical").groupBy("paper_id").agg(F.min_by("keywords", "rec_id").alias("keywords"))
    rows = table(spark, sf, "papers").join(first, "paper_id", "left")
    text = enriched_text(F.col("clean_text"), F.col("clean_sections"), F.col("keywords"), F.col("title"))
    return rows.select("text_id", F.md5(text).alias("text_md5"))


@query(
    "news_enriched",
    r"""WITH d AS (SELECT doc_id, text, lower(text) AS low FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, text, len(list_filter(['good', 'great', 'excellent', 'positive', 'success', 'benefit', 'improve'], lambda w: contains(low, w))) AS up,
  len(list_filter(['bad', 'poor', 'negative', 'risk', 'danger', 'fail', 'loss', 'critic'], lambda w: contains(low, w))) AS down,
  list_filter(['government', 'company', 'industry', 'academia', 'consumer', 'regulator'], lambda w: contains(low, w)) AS parties FROM d)
SELECT doc_id, CASE WHEN up > down THEN 'positive' WHEN down > up THEN 'negative' ELSE 'neutral' END AS tone, parties,
  list_slice(list_sort(list_distinct(regexp_extract_all(text, '(?:^|[^A-Za-z0-9])([A-Z][a-z]{3,})', 1))), 1, 5) AS names FROM s""",
)
def news_enriched(spark: SparkSession, sf: str) -> DataFrame:
    """Tone by words of either kind, parties that are named, and the first five capitalised words in order."""
    low = F.lower("text")
    count = lambda words: sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0))
    up, down = count(FAVOURABLE), count(UNFAVOURABLE)
    parties = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(p)), F.lit(p)) for p in PARTIES]))
    names = F.slice(F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?:^|[^A-Za-z0-9])([A-Z][a-z]{3,})"), F.lit(1)))), 1, 5)
    rows = table(spark, sf, "documents").where(F.col("text").isNotNull())
    tone = F.when(up > down, "positive").when(down > up, "negative").otherwise("neutral")
    return rows.select("doc_id", tone.alias("tone"), parties.alias("parties"), names.alias("names"))


def file_index(log: Column) -> Column:
    """Paper -> file of an index in either of its shapes: an object with `index`, or a list of events of which the last counts."""
    own = F.from_json(log, "index map<string,string>")["index"]
    events = F.filter(F.from_json(log, "array<struct<paper_id:string,pdf_file:string>>"), lambda e: (e["paper_id"] != "") & (e["pdf_file"] != ""))
    latest = F.aggregate(
        events, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")),
        lambda m, e: F.map_concat(F.map_filter(m, lambda k, v: k != e["paper_id"]), F.create_map(e["paper_id"], e["pdf_file"])),
    )
    return F.coalesce(own, latest)


@query(
    "file_index_read",
    """SELECT text_id, CASE WHEN text_id % 4 = 3 THEN CASE WHEN pdf_file LIKE '/%' THEN pdf_file ELSE 'out/' || pdf_file END
  ELSE 'out/new_' || pdf_file END AS path FROM papers WHERE pdf_file IS NOT NULL""",
)
def file_index_read(spark: SparkSession, sf: str) -> DataFrame:
    """Files by the index, in both of its shapes, else by the paper's own path; relative paths are joined with the folder."""
    new = F.concat(F.lit("new_"), "pdf_file")
    event = lambda f: F.struct(F.col("paper_id").alias("paper_id"), f.alias("pdf_file"))
    log = (
        F.when(F.col("text_id") % 4 == 0, F.to_json(F.struct(F.create_map("paper_id", new).alias("index"))))
        .when(F.col("text_id") % 4 == 3, F.lit("broken {"))
        .otherwise(F.to_json(F.array(event(F.col("pdf_file")), event(new))))
    )
    rows = table(spark, sf, "papers").where(F.col("pdf_file").isNotNull()).select("text_id", "paper_id", "pdf_file", log.alias("log"))
    found = F.coalesce(F.try_element_at(file_index(F.col("log")), F.col("paper_id")), F.col("pdf_file"))
    return rows.select("text_id", F.when(F.startswith(found, F.lit("/")), found).otherwise(F.concat(F.lit("out/"), found)).alias("path"))
