"""Queries of the training-data operators, each over its whole tables, and SQL twins where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import findings, matching, names, packing, quality, scans, survivors, tokens, truncation
from lexmill.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match(table(spark, sf_dir, "canonical")).select("paper_id_a", "paper_id_b")


def p1_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match(table(spark, sf_dir, "canonical"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    canonical, venues = table(spark, sf_dir, "canonical"), table(spark, sf_dir, "venues")
    chosen = survivors.survivors(canonical, "paper_id", "rec_id", "retrieved_at", venues)
    return chosen.where(F.col("n_values") > 1).select("paper_id", "field", "rec_id")


def p2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    canonical, venues = table(spark, sf_dir, "canonical"), table(spark, sf_dir, "venues")
    return survivors.golden(canonical, "paper_id", "rec_id", "retrieved_at", venues)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings.finding_pairs(table(spark, sf_dir, "evidences"), "evidence_id", "text")


def p3_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings.finding_clusters(table(spark, sf_dir, "evidences"), "evidence_id", "text", "similarity")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.name_pairs(table(spark, sf_dir, "canonical"), "authors")


def p4_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.link_names(table(spark, sf_dir, "canonical"), "authors")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.faults(table(spark, sf_dir, "papers"), table(spark, sf_dir, "venues"))


def p5_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.repaired(table(spark, sf_dir, "papers"), table(spark, sf_dir, "venues"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncated(table(spark, sf_dir, "search_records"), "hit_id", "abstract").select("hit_id")


def p6_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.cut_share(table(spark, sf_dir, "search_records"), "hit_id", "abstract", "source")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether decoding gives back each text; null texts come back empty."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("given"))
    back = tokens.decode(tokens.encode(docs), text="back")
    return back.select("doc_id", (F.col("back") == F.coalesce("given", F.lit(""))).alias("same"))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.containers(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "pack_limits"))


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = table(spark, sf_dir, "pack_limits")
    return packing.fill(packing.packed_shards(table(spark, sf_dir, "documents"), "doc_id", "text", limits), limits)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_prose(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "common_words"))


def p10_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.statistics(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "common_words"))


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_confidence, p2_found, p2_records, p3_found, p3_clusters, p4_found, p4_entities, p5_found, p5_text,
        p6_found, p6_share, p8_ids, p8_round_trip, p9_containers, p9_fill, p10_found, p10_statistics,
    )
}

_FILLER = r"^\W*(no abstract( is)?( available)?|(the )?abstract( is)?( not available| unavailable| missing|:? none)|not available|unknown|none|null|n/?a|tba|tbd)?\W*$"



def _cut_sql() -> str:
    """The statement of `truncation` in the other engine's dialect."""
    q = lambda p: "'" + p.replace("'", "''") + "'"
    mark, stop, filler = q(truncation.MARK), q(truncation.STOP_MARK), q(truncation.FILLER)
    clean = (
        "regexp_replace(regexp_replace(regexp_replace(w, '[0-9]+', '#', 'g'), '^[^\\p{L}\\p{N}#]+', ''), '[^\\p{L}\\p{N}#%]+$', '')"
    )
    ends = q(r"[.!?][\"')\]”’]*$")
    return f"""
WITH texts AS (SELECT abstract AS t, lower(abstract) AS low FROM search_records WHERE abstract IS NOT NULL GROUP BY abstract),
judged AS (
  SELECT low, md5(t) AS id, regexp_matches(low, {mark}) AS marked, regexp_matches(low, {stop}) AS stopped,
         length(regexp_replace(low, '[^(]', '', 'g')) > length(regexp_replace(low, '[^)]', '', 'g')) AS open
  FROM texts WHERE NOT regexp_matches(low, {filler})
), words AS (
  SELECT id, marked, stopped, open, list_filter(list_transform(string_split_regex(regexp_replace(low, {mark}, ''), '\\s+'),
    lambda w: {{'w': {clean}, 's': regexp_matches(w, {ends})}}), lambda x: x.w <> '') AS ws FROM judged
), flat AS (
  SELECT id, len(ws) AS n, unnest(ws) AS x, generate_subscripts(ws, 1) AS i, ws FROM words
), placed AS (
  SELECT id, n, i, x.w AS c, x.s AS s, CASE WHEN i > 1 THEN ws[i - 1].w ELSE '' END AS b, CASE WHEN i > 2 THEN ws[i - 2].w ELSE '' END AS a FROM flat
), grams AS (
  SELECT a, b, c, count(*) FILTER (WHERE NOT s AND i < n) AS goes, count(*) FILTER (WHERE s) AS closes, count(*) FILTER (WHERE NOT s AND i = n) AS bare FROM placed GROUP BY a, b, c
), pairs AS (SELECT b, c, sum(goes) AS goes, sum(closes) AS closes FROM grams GROUP BY b, c),
singles AS (SELECT c, sum(goes) AS goes, sum(closes) AS closes FROM pairs GROUP BY c),
finals AS (
  SELECT id, marked, stopped, open AND NOT stopped AS open, ws[len(ws)].w AS c, CASE WHEN len(ws) > 1 THEN ws[len(ws) - 1].w ELSE '' END AS b,
         CASE WHEN len(ws) > 2 THEN ws[len(ws) - 2].w ELSE '' END AS a FROM words WHERE len(ws) > 0
), asked AS (SELECT DISTINCT a, b, c FROM finals WHERE NOT marked AND NOT open),
by3 AS (
  SELECT q.a, q.b, q.c, sum(CASE WHEN g.c = q.c THEN g.goes ELSE g.goes + g.closes END) AS goes, sum(CASE WHEN g.c = q.c THEN g.closes ELSE 0 END) AS closes,
         sum(CASE WHEN g.c = q.c THEN g.bare ELSE 0 END) AS bare FROM asked q JOIN grams g ON q.a = g.a AND q.b = g.b AND starts_with(g.c, q.c) GROUP BY q.a, q.b, q.c
), by2 AS (
  SELECT q.b, q.c, sum(CASE WHEN g.c = q.c THEN g.goes ELSE g.goes + g.closes END) AS goes, sum(CASE WHEN g.c = q.c THEN g.closes ELSE 0 END) AS closes
  FROM (SELECT DISTINCT b, c FROM asked) q JOIN pairs g ON q.b = g.b AND starts_with(g.c, q.c) GROUP BY q.b, q.c
), counted AS (
  SELECT f.*, t.goes AS g3, t.closes - f.stopped::INT AS s3, t.bare AS e3, d.goes AS g2, d.closes - f.stopped::INT AS s2, s.goes AS g1, s.closes - f.stopped::INT AS s1
  FROM finals f LEFT JOIN by3 t ON f.a = t.a AND f.b = t.b AND f.c = t.c LEFT JOIN by2 d ON f.b = d.b AND f.c = d.c LEFT JOIN singles s ON f.c = s.c
), decided AS (
  SELECT id, CASE WHEN marked THEN 'mark' WHEN open THEN 'open bracket'
    WHEN stopped THEN CASE WHEN g3 >= {truncation.LEAST_DOUBT} AND s3 = 0 AND g2 >= {truncation.LEAST_DOUBT} AND s2 = 0 THEN 'goes on' END
    WHEN g3 + s3 > 0 THEN CASE WHEN s3 <= {truncation.MOST_CLOSING} * (g3 + s3) THEN 'goes on' END
    WHEN e3 >= {truncation.USUAL} THEN NULL
    WHEN g2 + s2 > 0 THEN CASE WHEN s2 <= {truncation.MOST_CLOSING} * (g2 + s2) THEN 'goes on' END
    WHEN g1 + s1 > 0 THEN CASE WHEN s1 <= {truncation.MOST_CLOSING} * (g1 + s1) THEN 'goes on' END
    ELSE 'torn word' END AS why FROM counted
)
SELECT r.hit_id FROM search_records r JOIN decided d ON md5(r.abstract) = d.id WHERE d.why IS NOT NULL"""


SQL = {
    # Of every field, what no other value outranks; of venues of one grade the first, by length, that the group's types confirm.
    "p2_found": rf"""
WITH long AS (
  SELECT paper_id, rec_id, 'abstract' AS field, abstract AS value, '' AS cls,
         CASE WHEN abstract IS NULL OR regexp_matches(lower(abstract), '{_FILLER}') THEN 0
              ELSE 1000000 + length(abstract) - CASE WHEN regexp_matches(abstract, '(\.\.\.|…|\]|WORDS\))\s*$') THEN 40 ELSE 0 END
         END::DOUBLE AS s1, coalesce(length(abstract), 0)::DOUBLE AS s2 FROM canonical
  UNION ALL
  SELECT paper_id, rec_id, 'venue', c.venue, coalesce(v.venue_category, ''),
         CASE WHEN v.venue IS NOT NULL THEN 2 WHEN c.venue IS NULL OR regexp_matches(lower(c.venue), '{_FILLER}') THEN 0 ELSE 1 END,
         coalesce(length(c.venue), 0) FROM canonical c LEFT JOIN venues v ON c.venue = v.venue
  UNION ALL
  SELECT paper_id, rec_id, 'year', year::VARCHAR, '', CASE WHEN year BETWEEN 1800 AND 2025 THEN 1 ELSE 0 END,
         epoch_us(retrieved_at)::DOUBLE FROM canonical
  UNION ALL
  SELECT paper_id, rec_id, 'authors', authors::VARCHAR, '',
         coalesce(len(list_filter(authors, lambda x: x IS NOT NULL AND lower(trim(x)) NOT IN ('', 'et al.', 'et al'))), 0),
         CASE WHEN authors IS NULL THEN 0 WHEN len(list_filter(authors, lambda x: lower(trim(x)) IN ('', 'et al.', 'et al'))) = 0 THEN 2 ELSE 1 END
  FROM canonical
), groups AS (
  SELECT paper_id, field FROM long GROUP BY ALL
  HAVING count(DISTINCT value) + max(CASE WHEN value IS NULL THEN 1 ELSE 0 END) > 1
), typed AS (
  SELECT paper_id, max(CASE WHEN document_type = 'article' THEN 1 ELSE 0 END) AS fits_all, list(DISTINCT document_type) AS types FROM canonical GROUP BY paper_id
), graded AS (
  SELECT l.*, CASE WHEN field = 'venue' AND s1 = 2 AND NOT (t.fits_all = 1 OR cls = '' OR list_contains(t.types, cls) OR len(list_filter(t.types, lambda x: x IS NOT NULL)) = 0)
                   THEN 0 ELSE 1 END AS agrees
  FROM long l JOIN typed t USING (paper_id) SEMI JOIN groups USING (paper_id, field)
), best AS (
  SELECT paper_id, field, value,
         row_number() OVER (PARTITION BY paper_id, field ORDER BY CASE WHEN field = 'venue' THEN s1 END DESC, agrees DESC, s1 DESC, s2 DESC, rec_id DESC) AS r
  FROM graded
)
SELECT b.paper_id, b.field, min(l.rec_id) AS rec_id
FROM best b JOIN long l ON b.paper_id = l.paper_id AND b.field = l.field AND b.value IS NOT DISTINCT FROM l.value
WHERE b.r = 1 GROUP BY b.paper_id, b.field""",
    # Decoding gives back every text.
    "p8_round_trip": "SELECT doc_id, TRUE AS same FROM documents",
    "p6_found": _cut_sql(),
    "p6_share": f"""
WITH found AS ({_cut_sql()})
SELECT r.source, count(*) AS n_records,
       count(*) FILTER (WHERE r.abstract IS NOT NULL AND NOT regexp_matches(lower(r.abstract), '{truncation.FILLER}')) AS n_texts,
       count(f.hit_id) AS n_cut,
       round(count(f.hit_id)::DOUBLE / greatest(1, count(*) FILTER (WHERE r.abstract IS NOT NULL AND NOT regexp_matches(lower(r.abstract), '{truncation.FILLER}'))), 6) AS share
FROM search_records r LEFT JOIN found f ON r.hit_id = f.hit_id GROUP BY r.source""",
}
