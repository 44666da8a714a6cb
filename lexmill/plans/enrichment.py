"""Enrichment of records, configuration of searches, and the remaining joins and functions on passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators import greedy, overlap
from lexmill.plans.base import Plans
from lexmill.plans.passages import _SENTENCES, _sentences
from lexmill.session import table

plans = Plans()
QUERIES, SQL, query = plans.queries, plans.sql, plans.query


@query(
    "record_enrichment",
    f"""WITH d AS (SELECT {X.sql_doi('doi')} AS d, max(citation_count) AS citations, arg_max(year, (retrieved_at, rec_id)) FILTER (WHERE year BETWEEN 1900 AND 2025) AS year, bool_or(open_access IS NOT NULL AND trim(open_access) <> '') AS open
  FROM canonical WHERE {X.sql_doi('doi')} <> '' GROUP BY d)
SELECT s.hit_id, coalesce(d.year, s.year) AS year, d.citations, coalesce(d.open, false) AS has_file FROM search_records s LEFT JOIN d ON {X.sql_doi('s.doi')} = d.d""",
)
def record_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    """Values of an outside source where it has them, else the record's own; nothing is destroyed."""
    doi = X.normalize_doi(F.col("doi"))
    possible = F.when(F.col("year").between(1900, 2025), F.struct("retrieved_at", "rec_id"))
    outside = table(spark, sf, "canonical").where(doi != "").groupBy(doi.alias("d")).agg(
        F.max("citation_count").alias("citations"), F.max_by("year", possible).alias("oy"),
        F.bool_or(F.col("open_access").isNotNull() & (F.trim("open_access") != "")).alias("open"),
    )
    hits = table(spark, sf, "search_records").select("hit_id", "year", doi.alias("d"))
    return hits.join(outside, "d", "left").select("hit_id", F.coalesce("oy", "year").alias("year"), "citations", F.coalesce("open", F.lit(False)).alias("has_file"))


@query(
    "scores_with_default",
    "WITH s AS (SELECT doc_id, round(max(similarity), 4) AS score FROM evidences WHERE similarity BETWEEN 0 AND 1 GROUP BY doc_id) SELECT p.text_id, coalesce(s.score, 0.0) AS score FROM papers p LEFT JOIN s ON p.paper_id = s.doc_id",
)
def scores_with_default(spark: SparkSession, sf: str) -> DataFrame:
    good = table(spark, sf, "evidences").where(F.col("similarity").between(0.0, 1.0))
    best = good.groupBy(F.col("doc_id").alias("paper_id")).agg(F.round(F.max("similarity"), 4).alias("score"))
    return table(spark, sf, "papers").select("text_id", "paper_id").join(best, "paper_id", "left").select("text_id", F.coalesce("score", F.lit(0.0)).alias("score"))


@query(
    "passages_joined_by_text",
    f"""WITH d AS (SELECT DISTINCT md5({X.sql_text('text')}) AS h FROM evidences WHERE trim(text) <> ''), e AS (SELECT evidence_id, md5({X.sql_text('text')}) AS h FROM evidences WHERE trim(text) <> ''),
z AS (SELECT h, min(evidence_id) AS first FROM e GROUP BY h) SELECT e.evidence_id, z.first FROM e JOIN z USING (h)""",
)
def passages_joined_by_text(spark: SparkSession, sf: str) -> DataFrame:
    """Passages joined on the digest of their normalised text instead of the text."""
    rows = table(spark, sf, "evidences").where(F.trim("text") != "").select("evidence_id", F.md5(X.normalize_text(F.col("text"))).alias("h"))
    firsts = rows.groupBy("h").agg(F.min("evidence_id").alias("first"))
    return rows.join(firsts, "h").select("evidence_id", "first")


@query(
    "doi_audit",
    f"""SELECT source, count(*) FILTER (WHERE {X.sql_doi('doi')} <> '') AS with_doi, count(*) FILTER (WHERE trim(doi) <> '' AND {X.sql_doi('doi')} <> trim(doi)) AS rewritten,
count(*) FILTER (WHERE coalesce(trim(doi), '') = '') AS missing FROM canonical GROUP BY source""",
)
def doi_audit(spark: SparkSession, sf: str) -> DataFrame:
    doi = X.normalize_doi(F.col("doi"))
    return table(spark, sf, "canonical").groupBy("source").agg(
        F.count_if(doi != "").alias("with_doi"), F.count_if((F.trim("doi") != "") & (doi != F.trim("doi"))).alias("rewritten"),
        F.count_if(F.coalesce(F.trim("doi"), F.lit("")) == "").alias("missing"),
    )


@query(
    "bibliography_sets",
    """WITH cited AS (SELECT DISTINCT doc_id AS paper_id FROM evidences WHERE similarity BETWEEN 0.5 AND 1), read AS (SELECT DISTINCT paper_id FROM papers)
SELECT paper_id, CASE WHEN paper_id IN (SELECT paper_id FROM cited) THEN 'included' ELSE 'emerging' END AS part FROM read""",
)
def bibliography_sets(spark: SparkSession, sf: str) -> DataFrame:
    cited = table(spark, sf, "evidences").where(F.col("similarity").between(0.5, 1.0)).select(F.col("doc_id").alias("paper_id")).distinct().withColumn("c", F.lit(1))
    read = table(spark, sf, "papers").select("paper_id").distinct()
    return read.join(cited, "paper_id", "left").select("paper_id", F.when(F.col("c") == 1, "included").otherwise("emerging").alias("part"))


@query(
    "display_thresholds",
    """WITH e AS (SELECT concept_id, list(evidence_id ORDER BY evidence_id) FILTER (WHERE similarity BETWEEN 0.35 AND 1) AS shown FROM (
  SELECT concept_id, evidence_id, similarity, row_number() OVER (PARTITION BY concept_id ORDER BY evidence_id) AS r FROM evidences) WHERE r <= 50 GROUP BY concept_id)
SELECT concept_id, shown FROM e WHERE len(shown) > 0""",
)
def display_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    """Nested passages of each concept's first fifty above a threshold; concepts left without any are dropped."""
    from lexmill.operators.ranking import top_per_group

    first = top_per_group(table(spark, sf, "evidences").select("concept_id", "evidence_id", "similarity"), ["concept_id"], [F.col("evidence_id")], 50)
    nested = first.groupBy("concept_id").agg(F.array_sort(F.collect_list(F.struct("evidence_id", "similarity"))).alias("es"))
    shown = F.transform(F.filter("es", lambda e: e["similarity"].between(0.35, 1.0)), lambda e: e["evidence_id"])
    return nested.select("concept_id", shown.alias("shown")).where(F.size("shown") > 0)


@query(
    "field_merge",
    """WITH o AS (SELECT paper_id, arg_min(struct_pack(venue := venue, doi := doi, language := language), rec_id) AS o, arg_max(struct_pack(venue := venue, doi := doi, language := language), rec_id) AS n FROM canonical GROUP BY paper_id)
SELECT paper_id, coalesce(nullif(trim(o.venue), ''), n.venue) AS venue, coalesce(nullif(trim(o.doi), ''), n.doi) AS doi, coalesce(nullif(trim(o.language), ''), n.language) AS language FROM o""",
)
def field_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Old values stay, a newer record fills what is empty."""
    fields = F.struct("venue", "doi", "language")
    rows = table(spark, sf, "canonical").groupBy("paper_id").agg(F.min_by(fields, "rec_id").alias("o"), F.max_by(fields, "rec_id").alias("n"))
    return rows.select("paper_id", *[F.coalesce(F.nullif(F.trim(f"o.{c}"), F.lit("")), F.col(f"n.{c}")).alias(c) for c in ("venue", "doi", "language")])


@query(
    "second_pass",
    """WITH c AS (SELECT source, avg(CASE WHEN trim(doi) <> '' THEN 1.0 ELSE 0.0 END) AS doi, avg(CASE WHEN trim(pmid) <> '' THEN 1.0 ELSE 0.0 END) AS pmid, avg(CASE WHEN trim(language) <> '' THEN 1.0 ELSE 0.0 END) AS language FROM canonical GROUP BY source)
SELECT source, least(doi, pmid, language) < 0.4 AS needed FROM c""",
)
def second_pass(spark: SparkSession, sf: str) -> DataFrame:
    """Does any dimension of a source fall below the coverage that spares a second pass?"""
    held = lambda c: F.avg(F.when(F.trim(c) != "", 1.0).otherwise(0.0))
    return table(spark, sf, "canonical").groupBy("source").agg((F.least(held("doi"), held("pmid"), held("language")) < 0.4).alias("needed"))


@query(
    "search_configuration",
    """WITH c AS (SELECT concept_name AS name, CASE WHEN concept_id % 3 <> 0 THEN concept_query END AS ranking_query, concept_description AS query, CASE WHEN concept_id % 2 = 0 THEN concept_id * 5 END AS top_k FROM concepts WHERE concept_id % 5 <> 0)
SELECT name, coalesce(nullif(trim(ranking_query), ''), nullif(trim(query), ''), 'the study') AS ranking_query, coalesce(nullif(trim(query), ''), 'the study') AS query, coalesce(top_k, 130)::INT AS top_k FROM c""",
)
def search_configuration(spark: SparkSession, sf: str) -> DataFrame:
    """Named searches, one for each question, with defaults for what they lack; disabled ones are skipped."""
    number = F.col("concept_id")
    given = table(spark, sf, "concepts").select(
        F.col("concept_name").alias("name"), F.when(number % 3 != 0, F.col("concept_query")).alias("ranking_query"), F.col("concept_description").alias("query"),
        F.when(number % 2 == 0, number * 5).cast("int").alias("top_k"), (number % 5 != 0).alias("enabled"),
    )
    return resolve_streams(given, "the study")


def resolve_streams(config: DataFrame, study: str, top_k: int = 130) -> DataFrame:
    """Streams with the first of their own ranking query, their query and the study's; a `default` one if none is enabled."""
    own = lambda c: F.nullif(F.trim(c), F.lit(""))
    live = config.where("enabled").select(
        "name", F.coalesce(own("ranking_query"), own("query"), F.lit(study)).alias("ranking_query"), F.coalesce(own("query"), F.lit(study)).alias("query"),
        F.coalesce("top_k", F.lit(top_k)).alias("top_k"),
    )
    spare = config.sparkSession.createDataFrame([("default", study, study, top_k)], live.schema)
    return live.unionByName(spare.join(live.limit(1).select(F.lit(1).alias("one")), F.lit(True), "left_anti"))


@query(
    "seed_terms",
    """WITH t AS (SELECT concept_id, list_slice(list_distinct_ordered, 1, 12) AS terms FROM (SELECT concept_id, list_transform(list_sort(list_transform(map_entries(m), lambda e: {'p': e.value, 't': e.key})), lambda x: x.t) AS list_distinct_ordered
  FROM (SELECT concept_id, map_from_entries(list(struct_pack(k := t, v := i))) AS m FROM (
    SELECT concept_id, t, min(i) AS i FROM (SELECT concept_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM (SELECT concept_id, list_filter(string_split_regex(lower(concept_query), '[^a-z-]+'), lambda x: length(x) > 3) AS w FROM concepts)) GROUP BY ALL) GROUP BY concept_id)))
SELECT concept_id, terms FROM t""",
)
def seed_terms(spark: SparkSession, sf: str) -> DataFrame:
    """The first twelve different words of more than three letters of each question, in order."""
    words = F.array_distinct(F.filter(F.split(F.lower("concept_query"), "[^a-z-]+"), lambda x: F.length(x) > 3))
    return table(spark, sf, "concepts").select("concept_id", F.slice(words, 1, 12).alias("terms"))


@query(
    "sentence_chunks",
    f"""WITH RECURSIVE s AS (SELECT doc_id, {_SENTENCES.format(t='text')} AS s FROM documents WHERE text IS NOT NULL),
f AS (SELECT doc_id, s, 1 AS i, '' AS cur, []::VARCHAR[] AS out FROM s
  UNION ALL SELECT doc_id, s, i + 1, CASE WHEN cur = '' THEN s[i] WHEN length(cur) + 1 + length(s[i]) <= 400 THEN cur || ' ' || s[i] ELSE s[i] END,
    CASE WHEN cur <> '' AND length(cur) + 1 + length(s[i]) > 400 THEN list_append(out, cur) ELSE out END FROM f WHERE i <= len(s))
SELECT doc_id, len(chunks) AS n, md5(array_to_string(chunks, '|')) AS chunks_md5 FROM (SELECT doc_id, CASE WHEN cur = '' THEN out ELSE list_append(out, cur) END AS chunks FROM f WHERE i = len(s) + 1)""",
)
def sentence_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences joined into chunks of at most 400 characters, by a fold inside each row."""
    rows = table(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", _sentences(F.col("text")).alias("s"))
    start = F.struct(F.lit("").alias("cur"), F.array().cast("array<string>").alias("out"))

    def step(state, x):
        room = F.length(state["cur"]) + 1 + F.length(x) <= 400
        cur = F.when(state["cur"] == "", x).when(room, F.concat_ws(" ", state["cur"], x)).otherwise(x)
        out = F.when((state["cur"] != "") & ~room, F.concat(state["out"], F.array(state["cur"]))).otherwise(state["out"])
        return F.struct(cur.alias("cur"), out.alias("out"))

    chunks = F.aggregate("s", start, step, lambda s: F.when(s["cur"] == "", s["out"]).otherwise(F.concat(s["out"], F.array(s["cur"]))))
    return rows.select("doc_id", chunks.alias("c")).select("doc_id", F.size("c").alias("n"), F.md5(F.array_join("c", "|")).alias("chunks_md5"))


@query(
    "pattern_fragments",
    r"""SELECT doc_id, list_slice(regexp_extract_all(text, '(?i)((?:limitations include|we found that|these findings imply that)[^.;]{10,200})', 1), 1, 3) AS fragments FROM documents
WHERE len(regexp_extract_all(text, '(?i)((?:limitations include|we found that|these findings imply that)[^.;]{10,200})', 1)) > 0""",
)
def pattern_fragments(spark: SparkSession, sf: str) -> DataFrame:
    """The first three fragments that begin with one of the known phrases; fragments cannot overlap."""
    pattern = r"(?i)((?:limitations include|we found that|these findings imply that)[^.;]{10,200})"
    rows = table(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", F.slice(F.regexp_extract_all("text", F.lit(pattern), 1), 1, 3).alias("fragments"))
    return rows.where(F.size("fragments") > 0)


@query(
    "titles_found_in_text",
    f"""WITH p AS (SELECT text_id, {X.sql_title('title')} AS t, {X.sql_title('full_text')} AS body FROM papers WHERE full_text IS NOT NULL AND length({X.sql_title('title')}) >= 25)
SELECT text_id, contains(body, t) AS whole, contains(body, left(t, 25)) AS beginning FROM p""",
)
def titles_found_in_text(spark: SparkSession, sf: str) -> DataFrame:
    """Does a file's text hold its title, or the title's beginning?"""
    rows = table(spark, sf, "papers").where(F.col("full_text").isNotNull())
    named = rows.select("text_id", X.normalized_title(F.col("title")).alias("t"), X.normalized_title(F.col("full_text")).alias("body")).where(F.length("t") >= 25)
    return named.select("text_id", F.contains("body", "t").alias("whole"), F.contains("body", F.substring("t", 1, 25)).alias("beginning"))


@query(
    "metadata_heuristics",
    r"""SELECT doc_id, nullif(regexp_extract(text, '(10\.[0-9]{4,9}/[^\s"<>]+)', 1), '') AS doi, try_cast(nullif(regexp_extract(text, '\b((?:19|20)[0-9]{2})\b', 1), '') AS INT) AS year, left(trim(string_split(text, chr(10))[1]), 120) AS title
FROM documents WHERE length(text) >= 20""",
)
def metadata_heuristics(spark: SparkSession, sf: str) -> DataFrame:
    """A doi, a year and a title guessed from a text."""
    rows = table(spark, sf, "documents").where(F.length("text") >= 20)
    found = lambda p: F.nullif(F.regexp_extract("text", p, 1), F.lit(""))
    return rows.select(
        "doc_id", found(r'(10\.[0-9]{4,9}/[^\s"<>]+)').alias("doi"), found(r"\b((?:19|20)[0-9]{2})\b").try_cast("int").alias("year"),
        F.substring(F.trim(F.split("text", "\n")[0]), 1, 120).alias("title"),
    )


@query("split_clusters")
def split_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters of more than ten vectors cut into as many parts as tens of them, by average linkage."""
    rows = table(spark, sf, "embeddings")
    clusters = greedy.average_linkage(rows, "label", "vec_id", "embedding").select("cluster", "vec_id")
    return greedy.split_large(clusters.join(rows.select("vec_id", "embedding"), "vec_id"), "cluster", "vec_id", "embedding", 10)


@query(
    "files_matched_to_titles",
    r"""WITH t AS (SELECT rec_id, list_slice(list_sort(list_transform(list_distinct(regexp_extract_all(lower(title), '[a-z]{4,}')), lambda w: {'n': -length(w), 'w': w})), 1, 4) AS l FROM canonical WHERE title IS NOT NULL),
u AS (SELECT rec_id, list_transform(l, lambda x: x.w) AS ws FROM t WHERE len(l) >= 3), b AS (SELECT text_id, regexp_extract_all(lower(left(full_text, 3000)), '[a-z]{4,}') AS bw FROM papers WHERE full_text IS NOT NULL),
d AS (SELECT text_id, list_distinct(bw) AS bw FROM b)
SELECT d.text_id, u.rec_id, len(list_intersect(u.ws, d.bw))::INT AS shared FROM d JOIN u ON len(list_intersect(u.ws, d.bw)) >= 3""",
)
def files_matched_to_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Files and the records of which three of the four longest words of the title stand on the file's first page.

    Title words are common, so blocks of titles meet blocks of files and no candidate is written (see `overlap`).
    """
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"([a-z]{4,})"), 1))
    ranked = F.array_sort(F.transform(words(F.col("title")), lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w"))))
    titled = table(spark, sf, "canonical").where(F.col("title").isNotNull())
    titles = titled.select(F.col("rec_id").alias("key"), F.transform(F.slice(ranked, 1, 4), lambda x: x["w"]).alias("words")).where(F.size("words") >= 3)
    files = table(spark, sf, "papers").where(F.col("full_text").isNotNull()).select(F.col("text_id").alias("key"), words(F.substring("full_text", 1, 3000)).alias("words"))
    found = overlap.sharing(titles, files, titled.count(), 4, 3)
    return found.select(F.col("text_key").alias("text_id"), F.col("set_key").alias("rec_id"), "shared")


plans.integers({"sentence_chunks": ["n"]})
