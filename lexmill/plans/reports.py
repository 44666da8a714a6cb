"""Reports as tables of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import greedy
from lexmill.plans.base import Plans
from lexmill.session import table
from lexmill.sinks import reports

plans = Plans()
QUERIES, SQL, query = plans.queries, plans.sql, plans.query


@query(
    "selection_report",
    """WITH s AS (SELECT source, count(*) AS n, count(DISTINCT paper_id) AS p FROM canonical GROUP BY source), y AS (SELECT year, count(*) AS n FROM canonical WHERE year BETWEEN 1900 AND 2025 GROUP BY year)
SELECT 'Records by source' AS part, row_number() OVER (ORDER BY n DESC, source) + 2 AS place, '| ' || source || ' | ' || n || ' | ' || p || ' |' AS line FROM s
UNION ALL SELECT 'Records by year', row_number() OVER (ORDER BY year DESC) + 2, '| ' || year || ' | ' || n || ' |' FROM y
UNION ALL SELECT * FROM (VALUES ('Records by source', 1, '| source | records | papers |'), ('Records by source', 2, '|---|---|---|'), ('Records by year', 1, '| year | records |'), ('Records by year', 2, '|---|---|'))""",
)
def selection_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.selection_report(table(spark, sf, "canonical"))


@query(
    "evidence_cards",
    """WITH g AS (SELECT * FROM evidences WHERE similarity BETWEEN 0.35 AND 1 AND trim(text) <> ''),
b AS (SELECT concept_id, doc_id, arg_max(evidence_id, (similarity, -evidence_id)) AS evidence_id FROM g GROUP BY ALL),
r AS (SELECT b.concept_id, b.doc_id, g.text, row_number() OVER (PARTITION BY b.concept_id ORDER BY g.similarity DESC, b.evidence_id) AS place FROM b JOIN g USING (evidence_id))
SELECT lpad(c.concept_id::VARCHAR, 3, '0') || ' ' || c.concept_name AS part, r.place, '- ' || r.text || ' [' || r.doc_id || ']' AS line FROM r JOIN concepts c USING (concept_id) WHERE r.place <= 3""",
)
def evidence_cards(spark: SparkSession, sf: str) -> DataFrame:
    return reports.evidence_cards(table(spark, sf, "evidences"), table(spark, sf, "concepts"))


#: Papers in order with the container of each, step by step.
PACKED_SQL = """o AS (SELECT text_id, coalesce(word_count, 0) AS w, row_number() OVER (ORDER BY coalesce(word_count, 0) DESC, text_id) AS p FROM papers),
r AS (SELECT p, text_id, 0::BIGINT AS container, 1 AS held, w AS total FROM o WHERE p = 1
  UNION ALL SELECT o.p, o.text_id, r.container + CASE WHEN r.held >= 20 OR r.total + o.w > 12000 THEN 1 ELSE 0 END,
    CASE WHEN r.held >= 20 OR r.total + o.w > 12000 THEN 1 ELSE r.held + 1 END, CASE WHEN r.held >= 20 OR r.total + o.w > 12000 THEN o.w ELSE r.total + o.w END
  FROM r JOIN o ON o.p = r.p + 1)"""


@query(
    "notebook_export",
    f"""WITH RECURSIVE {PACKED_SQL}, b AS (SELECT text_id, title, full_text, string_split_regex(trim(full_text), '\\s+') AS ws FROM papers)
SELECT 'notebook ' || r.container AS part, r.p AS place,
  'TITLE: ' || coalesce(b.title, '') || chr(10) || chr(10) || coalesce(CASE WHEN len(b.ws) > 500 THEN array_to_string(list_slice(b.ws, 1, 500), ' ') ELSE b.full_text END, '') AS line
FROM r JOIN b USING (text_id)""",
)
def notebook_export(spark: SparkSession, sf: str) -> DataFrame:
    papers = table(spark, sf, "papers")
    sized = papers.select("text_id", F.coalesce("word_count", F.lit(0)).alias("words"))
    packed = greedy.pack_in_order(sized, "text_id", "words", [F.desc("words"), F.col("text_id")], 20, 12_000)
    return reports.notebooks(packed, papers.select("text_id", "title", "full_text"), 500)


def _bib(name: str, value: str) -> str:
    return f"CASE WHEN trim({value}) <> '' THEN '  {name} = {{' || regexp_replace({value}, '[{{}}]', '', 'g') || '}},' || chr(10) ELSE '' END"


@query(
    "bibtex_file",
    f"""WITH r AS (SELECT *, 'r' || rec_id AS key, CASE WHEN regexp_matches(lower(venue), 'conference|symposium|workshop') THEN 'inproceedings' ELSE 'article' END AS kind FROM canonical)
SELECT key, '@' || kind || '{{' || key || ',' || chr(10) || {_bib('title', 'title')} || {_bib('author', "array_to_string(authors, ' and ')")} || {_bib('year', 'year::VARCHAR')}
  || CASE WHEN kind = 'article' THEN {_bib('journal', 'venue')} ELSE {_bib('booktitle', 'venue')} END || {_bib('doi', 'doi')} || '}}' || chr(10) AS entry FROM r""",
)
def bibtex_file(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.lower("venue").rlike("conference|symposium|workshop"), "inproceedings").otherwise("article")
    rows = table(spark, sf, "canonical").select(kind.alias("kind"), F.concat(F.lit("r"), F.col("rec_id").cast("string")).alias("key"), "title", "authors", "year", "venue", "doi")
    return reports.bibtex_text(rows)
