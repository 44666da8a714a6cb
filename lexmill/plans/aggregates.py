"""Counts, coverage, joins and set operations over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.plans.base import Plans
from lexmill.session import table

plans = Plans()
QUERIES, SQL, query = plans.queries, plans.sql, plans.query

FOCUS = ["gait", "pain", "sleep", "walking", "balance", "grip"]


@query(
    "counts_rollup",
    """SELECT source, document_type, count(*) AS n, (grouping(source) * 2 + grouping(document_type))::INT AS level
FROM canonical GROUP BY ROLLUP (source, document_type)""",
)
def counts_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Records by source and type, with subtotals and the total."""
    return table(spark, sf, "canonical").rollup("source", "document_type").agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))


@query(
    "incomplete_metadata",
    """SELECT source, count(*) AS n, count(*) FILTER (WHERE length(trim(coalesce(title, ''))) < 5) AS no_title,
count(*) FILTER (WHERE length(trim(coalesce(abstract, ''))) < 50) AS no_abstract, count(*) FILTER (WHERE coalesce(len(keywords), 0) = 0) AS no_keywords
FROM canonical GROUP BY source""",
)
def incomplete_metadata(spark: SparkSession, sf: str) -> DataFrame:
    short = lambda c, n: F.length(F.trim(F.coalesce(c, F.lit("")))) < n
    return table(spark, sf, "canonical").groupBy("source").agg(
        F.count("*").alias("n"), F.count_if(short("title", 5)).alias("no_title"), F.count_if(short("abstract", 50)).alias("no_abstract"),
        F.count_if(F.coalesce(F.size("keywords"), F.lit(0)) == 0).alias("no_keywords"),
    )


@query(
    "incomplete_by_label",
    """SELECT source || '_' || s AS label, count(*) AS n, count(*) FILTER (WHERE length(trim(coalesce(abstract, ''))) < 50) AS no_abstract
FROM (SELECT source, abstract, unnest(query_streams) AS s FROM canonical) GROUP BY label""",
)
def incomplete_by_label(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "canonical").select("source", "abstract", F.explode("query_streams").alias("s"))
    poor = F.length(F.trim(F.coalesce("abstract", F.lit("")))) < 50
    return rows.groupBy(F.concat_ws("_", "source", "s").alias("label")).agg(F.count("*").alias("n"), F.count_if(poor).alias("no_abstract"))


@query(
    "papers_per_venue",
    """WITH held AS (SELECT venue, count(DISTINCT paper_id) AS n FROM canonical WHERE trim(venue) <> '' GROUP BY venue)
SELECT v.venue_id, v.short_name, coalesce(sum(h.n), 0)::BIGINT AS n FROM venues v LEFT JOIN held h
ON contains(lower(h.venue), lower(v.venue)) OR contains(lower(h.venue), lower(v.short_name)) GROUP BY ALL""",
)
def papers_per_venue(spark: SparkSession, sf: str) -> DataFrame:
    """Papers of each target venue, whose name or short name the record's venue contains.

    Records are counted by their venue first, so the containment join meets distinct names only, of which there are few.
    """
    held = table(spark, sf, "canonical").where(F.trim("venue") != "").groupBy("venue").agg(F.count_distinct("paper_id").alias("n"))
    venues = table(spark, sf, "venues").withColumnRenamed("venue", "name")
    low = F.lower("venue")
    match = F.contains(low, F.lower("name")) | F.contains(low, F.lower("short_name"))
    return venues.join(held, match, "left").groupBy("venue_id", "short_name").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


_REASON = "CASE WHEN title IS NULL OR trim(title) = '' THEN 'no title' WHEN abstract IS NULL OR length(trim(abstract)) < 50 THEN 'no abstract' WHEN year IS NULL OR year NOT BETWEEN 1900 AND 2025 THEN 'no year' WHEN language <> 'en' THEN 'language' ELSE 'kept' END"


@query("exclusion_reasons", f"SELECT {_REASON} AS reason, count(*) AS n FROM canonical GROUP BY reason")
def exclusion_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Why records were screened out: the first reason that holds."""
    reason = (
        F.when(F.col("title").isNull() | (F.trim("title") == ""), "no title")
        .when(F.col("abstract").isNull() | (F.length(F.trim("abstract")) < 50), "no abstract")
        .when(F.col("year").isNull() | ~F.col("year").between(1900, 2025), "no year")
        .when(F.col("language") != "en", "language")
        .otherwise("kept")
    )
    return table(spark, sf, "canonical").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query(
    "priority_blacklist",
    """WITH lists AS (SELECT paper_id, 1 AS priority, 'configured' AS reason FROM canonical WHERE rec_id % 50 = 0
UNION ALL SELECT paper_id, 2, 'rejected' FROM canonical WHERE rec_id % 35 = 0 UNION ALL SELECT paper_id, 3, 'low text' FROM papers WHERE word_count < 500)
SELECT paper_id, arg_max(reason, priority) AS reason FROM lists GROUP BY paper_id""",
)
def priority_blacklist(spark: SparkSession, sf: str) -> DataFrame:
    """Three lists of excluded papers; a later list overrides an earlier one."""
    canonical, papers = table(spark, sf, "canonical"), table(spark, sf, "papers")
    one = canonical.where("rec_id % 50 = 0").select("paper_id", F.lit(1).alias("priority"), F.lit("configured").alias("reason"))
    two = canonical.where("rec_id % 35 = 0").select("paper_id", F.lit(2).alias("priority"), F.lit("rejected").alias("reason"))
    three = papers.where("word_count < 500").select("paper_id", F.lit(3).alias("priority"), F.lit("low text").alias("reason"))
    return one.unionByName(two).unionByName(three).groupBy("paper_id").agg(F.max_by("reason", "priority").alias("reason"))


@query("excluded_anti", "SELECT rec_id, paper_id FROM canonical ANTI JOIN (SELECT DISTINCT paper_id FROM papers WHERE word_count < 500) USING (paper_id)")
def excluded_anti(spark: SparkSession, sf: str) -> DataFrame:
    low = table(spark, sf, "papers").where("word_count < 500").select("paper_id").distinct()
    return table(spark, sf, "canonical").select("rec_id", "paper_id").join(low, "paper_id", "left_anti").select("rec_id", "paper_id")


@query(
    "focus_density",
    f"SELECT concept_id, count(*) AS n, round(avg(CASE WHEN {X.sql_hits('text', FOCUS)} > 0 THEN 1.0 ELSE 0.0 END), 6) AS density FROM evidences WHERE text IS NOT NULL GROUP BY concept_id",
)
def focus_density(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "evidences").where(F.col("text").isNotNull())
    hit = F.when(X.hits(F.col("text"), FOCUS) > 0, 1.0).otherwise(0.0)
    return rows.groupBy("concept_id").agg(F.count("*").alias("n"), F.round(F.avg(hit), 6).alias("density"))


_GOOD = "similarity BETWEEN 0 AND 1"


@query(
    "cluster_statistics",
    f"""SELECT concept_id, lower(section) AS section, count(*) AS size, round(avg(similarity), 12) AS mean_score, round(max(similarity), 4) AS max_score, round(min(similarity), 4) AS min_score,
count(*) FILTER (WHERE {X.sql_hits('text', FOCUS)} > 0) AS focus_rich, count(DISTINCT doc_id) AS papers FROM evidences WHERE {_GOOD} AND section IS NOT NULL GROUP BY concept_id, lower(section)""",
)
def cluster_statistics(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "evidences").where(F.col("similarity").between(0.0, 1.0) & F.col("section").isNotNull())
    return rows.groupBy("concept_id", F.lower("section").alias("section")).agg(
        F.count("*").alias("size"), F.round(F.avg("similarity"), 12).alias("mean_score"), F.round(F.max("similarity"), 4).alias("max_score"),
        F.round(F.min("similarity"), 4).alias("min_score"), F.count_if(X.hits(F.col("text"), FOCUS) > 0).alias("focus_rich"), F.count_distinct("doc_id").alias("papers"),
    )


@query(
    "corpus_totals",
    """WITH c AS (SELECT concept_id, doc_id, count(*) AS n FROM evidences GROUP BY ALL)
SELECT count(*) AS assignments, count(DISTINCT doc_id) AS papers, round(100.0 * count(*) FILTER (WHERE n = 1) / count(*), 4) AS singletons_percent FROM c""",
)
def corpus_totals(spark: SparkSession, sf: str) -> DataFrame:
    groups = table(spark, sf, "evidences").groupBy("concept_id", "doc_id").agg(F.count("*").alias("n"))
    return groups.agg(
        F.count("*").alias("assignments"), F.count_distinct("doc_id").alias("papers"),
        F.round(100.0 * F.count_if(F.col("n") == 1) / F.count("*"), 4).alias("singletons_percent"),
    )


@query(
    "relabel_by_size",
    "SELECT concept_id, count(*) AS size, (row_number() OVER (ORDER BY count(*) DESC, concept_id) - 1)::INT AS label FROM evidences GROUP BY concept_id",
)
def relabel_by_size(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters renumbered by falling size; one row for each cluster is ranked."""
    sizes = table(spark, sf, "evidences").groupBy("concept_id").agg(F.count("*").alias("size"))
    return sizes.withColumn("label", F.row_number().over(Window.orderBy(F.desc("size"), "concept_id")) - 1)


_FIELDS = ["doi", "pmid", "abstract", "venue", "document_type", "language"]


@query(
    "field_coverage",
    "SELECT source, " + ", ".join(f"round(avg(CASE WHEN trim({f}) <> '' THEN 1.0 ELSE 0.0 END), 6) AS {f}" for f in _FIELDS) + " FROM canonical GROUP BY source",
)
def field_coverage(spark: SparkSession, sf: str) -> DataFrame:
    held = lambda f: F.round(F.avg(F.when(F.trim(f) != "", 1.0).otherwise(0.0)), 6).alias(f)
    return table(spark, sf, "canonical").groupBy("source").agg(*[held(f) for f in _FIELDS])


@query(
    "coverage_classes",
    "SELECT CASE WHEN k >= 5 THEN 'rich' WHEN k > 0 THEN 'partial' ELSE 'empty' END AS kind, count(*) AS n FROM (SELECT "
    + " + ".join(f"(CASE WHEN trim({f}) <> '' THEN 1 ELSE 0 END)" for f in _FIELDS)
    + " AS k FROM canonical) GROUP BY kind",
)
def coverage_classes(spark: SparkSession, sf: str) -> DataFrame:
    k = sum(F.when(F.trim(f) != "", 1).otherwise(0) for f in _FIELDS)
    kind = F.when(k >= 5, "rich").when(k > 0, "partial").otherwise("empty")
    return table(spark, sf, "canonical").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("papers_per_concept", "SELECT concept_id, count(DISTINCT doc_id) AS papers, count(*) AS evidences FROM evidences GROUP BY concept_id")
def papers_per_concept(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "evidences").groupBy("concept_id").agg(F.count_distinct("doc_id").alias("papers"), F.count("*").alias("evidences"))


@query(
    "similarity_percentiles",
    f"SELECT concept_id, round(quantile_cont(similarity, 0.3), 6) AS p30, round(quantile_cont(similarity, 0.6), 6) AS p60, round(quantile_cont(similarity, 0.9), 6) AS p90 FROM evidences WHERE {_GOOD} GROUP BY concept_id",
)
def similarity_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "evidences").where(F.col("similarity").between(0.0, 1.0))
    return rows.groupBy("concept_id").agg(*[F.round(F.percentile("similarity", F.lit(p / 100)), 6).alias(f"p{p}") for p in (30, 60, 90)])


@query("source_section_counts", "SELECT source, section, lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY ALL")
def source_section_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy("source", "section", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("text_totals", "SELECT count(*) AS papers, sum(word_count)::BIGINT AS words, count(*) FILTER (WHERE word_count < 500) AS low_quality, count(clean_text) AS cleaned FROM papers")
def text_totals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "papers").agg(
        F.count("*").alias("papers"), F.sum("word_count").alias("words"), F.count_if(F.col("word_count") < 500).alias("low_quality"), F.count("clean_text").alias("cleaned")
    )


@query(
    "keyword_composition",
    """SELECT source, count(*) AS keywords, count(DISTINCT lower(k)) AS different, count(*) FILTER (WHERE regexp_matches(k, '[0-9]')) AS numeric, count(*) FILTER (WHERE contains(lower(k), 'sensor')) AS sensors
FROM (SELECT source, unnest(keywords) AS k FROM canonical) GROUP BY source""",
)
def keyword_composition(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "canonical").select("source", F.explode("keywords").alias("k"))
    return rows.groupBy("source").agg(
        F.count("*").alias("keywords"), F.count_distinct(F.lower("k")).alias("different"), F.count_if(F.col("k").rlike("[0-9]")).alias("numeric"),
        F.count_if(F.contains(F.lower("k"), F.lit("sensor"))).alias("sensors"),
    )


@query(
    "run_overlap",
    """WITH a AS (SELECT DISTINCT paper_id FROM canonical WHERE source IN ('scopus', 'wos', 'ieee')), b AS (SELECT DISTINCT paper_id FROM search_records WHERE source IN ('scopus', 'pubmed'))
SELECT coalesce(a.paper_id, b.paper_id) AS paper_id, CASE WHEN b.paper_id IS NULL THEN 'first' WHEN a.paper_id IS NULL THEN 'second' ELSE 'both' END AS held FROM a FULL JOIN b ON a.paper_id = b.paper_id""",
)
def run_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """What two runs have in common."""
    a = table(spark, sf, "canonical").where(F.col("source").isin("scopus", "wos", "ieee")).select("paper_id").distinct().withColumn("a", F.lit(1))
    b = table(spark, sf, "search_records").where(F.col("source").isin("scopus", "pubmed")).select("paper_id").distinct().withColumn("b", F.lit(1))
    held = F.when(F.col("b").isNull(), "first").when(F.col("a").isNull(), "second").otherwise("both")
    return a.join(b, "paper_id", "full").select("paper_id", held.alias("held"))


@query("ids_except", "SELECT DISTINCT paper_id FROM search_records EXCEPT SELECT paper_id FROM canonical")
def ids_except(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "search_records").select("paper_id").distinct().join(table(spark, sf, "canonical").select("paper_id").distinct(), "paper_id", "left_anti")


@query("ids_intersect", "SELECT paper_id FROM papers INTERSECT SELECT doc_id FROM evidences")
def ids_intersect(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "papers").select("paper_id").intersect(table(spark, sf, "evidences").select(F.col("doc_id").alias("paper_id")))


@query(
    "sources_union",
    """SELECT source, count(*) AS n, count(DISTINCT paper_id) AS papers FROM (SELECT source, paper_id FROM canonical UNION ALL SELECT source, paper_id FROM search_records) GROUP BY source""",
)
def sources_union(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "canonical").select("source", "paper_id").unionByName(table(spark, sf, "search_records").select("source", "paper_id"))
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("paper_id").alias("papers"))


@query("streams_distinct", "SELECT rec_id, list_distinct(query_streams).list_sort() AS streams FROM canonical WHERE query_streams IS NOT NULL")
def streams_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "canonical").where(F.col("query_streams").isNotNull()).select("rec_id", F.array_sort(F.array_distinct("query_streams")).alias("streams"))


@query(
    "text_with_metadata",
    """WITH m AS (SELECT paper_id, arg_min(title, rec_id) FILTER (WHERE trim(title) <> '') AS mtitle, max(citation_count) AS citations FROM canonical GROUP BY paper_id)
SELECT p.text_id, p.paper_id, coalesce(nullif(trim(p.title), ''), m.mtitle, 'Untitled (' || p.paper_id || ')') AS title, coalesce(m.citations, 0) AS citations FROM papers p LEFT JOIN m USING (paper_id)""",
)
def text_with_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with their records' metadata; a title of its own wins, a missing one is made from the id."""
    held = F.when(F.trim("title") != "", F.col("rec_id"))
    meta = table(spark, sf, "canonical").groupBy("paper_id").agg(F.min_by("title", held).alias("mtitle"), F.max("citation_count").alias("citations"))
    title = F.coalesce(F.nullif(F.trim("title"), F.lit("")), "mtitle", F.concat(F.lit("Untitled ("), "paper_id", F.lit(")")))
    return table(spark, sf, "papers").join(meta, "paper_id", "left").select("text_id", "paper_id", title.alias("title"), F.coalesce("citations", F.lit(0)).alias("citations"))


@query(
    "selection_refresh",
    """WITH review AS (SELECT DISTINCT paper_id FROM canonical WHERE year >= 2015), decided AS (SELECT paper_id, max(word_count) >= 600 AS selected FROM papers GROUP BY paper_id)
SELECT d.paper_id, CASE WHEN r.paper_id IS NULL THEN 'stale' WHEN d.selected THEN 'selected' ELSE 'rejected' END AS status FROM decided d LEFT JOIN review r USING (paper_id)""",
)
def selection_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Earlier decisions against the present review; decisions on papers that left it are stale."""
    review = table(spark, sf, "canonical").where("year >= 2015").select("paper_id").distinct().withColumn("there", F.lit(1))
    decided = table(spark, sf, "papers").groupBy("paper_id").agg((F.max("word_count") >= 600).alias("selected"))
    status = F.when(F.col("there").isNull(), "stale").when(F.col("selected"), "selected").otherwise("rejected")
    return decided.join(review, "paper_id", "left").select("paper_id", status.alias("status"))


@query(
    "vault_reconcile",
    """WITH vault AS (SELECT md5(full_text) AS h, min(paper_id) AS vault_id FROM papers WHERE text_id % 3 <> 0 GROUP BY h)
SELECT p.text_id, CASE WHEN v.h IS NULL THEN 'archive' WHEN v.vault_id = p.paper_id THEN 'ok' ELSE 'rekey' END AS action FROM papers p LEFT JOIN vault v ON md5(p.full_text) = v.h""",
)
def vault_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Files against the vault by content: known under the same id, under another, or not at all."""
    files = table(spark, sf, "papers").select("text_id", "paper_id", F.md5("full_text").alias("h"))
    vault = files.where("text_id % 3 <> 0").groupBy("h").agg(F.min("paper_id").alias("vault_id")).where(F.col("h").isNotNull())
    action = F.when(F.col("vault_id").isNull(), "archive").when(F.col("vault_id") == F.col("paper_id"), "ok").otherwise("rekey")
    return files.join(vault, "h", "left").select("text_id", action.alias("action"))


@query(
    "references_matched",
    f"""WITH c AS (SELECT {X.sql_doi('doi')} AS d, {X.sql_title('title')} AS t, rec_id FROM canonical), bd AS (SELECT d, min(rec_id) AS r FROM c WHERE d <> '' GROUP BY d), bt AS (SELECT t, min(rec_id) AS r FROM c WHERE t <> '' GROUP BY t)
SELECT s.hit_id, coalesce(bd.r, bt.r) AS rec_id, CASE WHEN bd.r IS NOT NULL THEN 'doi' WHEN bt.r IS NOT NULL THEN 'title' ELSE 'none' END AS by
FROM search_records s LEFT JOIN bd ON {X.sql_doi('s.doi')} = bd.d LEFT JOIN bt ON {X.sql_title('s.title')} = bt.t""".replace(" AS by\n", " AS matched_by\n"),
)
def references_matched(spark: SparkSession, sf: str) -> DataFrame:
    """Hits matched with the corpus by doi, else by title."""
    doi, title = X.normalize_doi(F.col("doi")), X.normalized_title(F.col("title"))
    canonical = table(spark, sf, "canonical").select(doi.alias("d"), title.alias("t"), "rec_id")
    by_doi = canonical.where("d <> ''").groupBy("d").agg(F.min("rec_id").alias("rd"))
    by_title = canonical.where("t <> ''").groupBy("t").agg(F.min("rec_id").alias("rt"))
    hits = table(spark, sf, "search_records").select("hit_id", doi.alias("d"), title.alias("t"))
    how = F.when(F.col("rd").isNotNull(), "doi").when(F.col("rt").isNotNull(), "title").otherwise("none")
    return hits.join(by_doi, "d", "left").join(by_title, "t", "left").select("hit_id", F.coalesce("rd", "rt").alias("rec_id"), how.alias("matched_by"))


@query(
    "acquisition_status",
    """WITH have AS (SELECT paper_id, max(CASE WHEN trim(full_text) <> '' THEN 1 ELSE 0 END) AS local, max(CASE WHEN clean_text IS NOT NULL THEN 1 ELSE 0 END) AS vault FROM papers GROUP BY paper_id),
wanted AS (SELECT paper_id, bool_or(open_access IS NOT NULL AND trim(open_access) <> '') AS open FROM canonical GROUP BY paper_id)
SELECT w.paper_id, CASE WHEN h.local = 1 THEN 'local' WHEN h.vault = 1 THEN 'vault' WHEN w.open THEN 'download' ELSE 'missing' END AS status FROM wanted w LEFT JOIN have h USING (paper_id)""",
)
def acquisition_status(spark: SparkSession, sf: str) -> DataFrame:
    """Where a paper's file comes from: the first place that has it."""
    have = table(spark, sf, "papers").groupBy("paper_id").agg(
        F.max(F.when(F.trim("full_text") != "", 1).otherwise(0)).alias("local"), F.max(F.when(F.col("clean_text").isNotNull(), 1).otherwise(0)).alias("vault")
    )
    wanted = table(spark, sf, "canonical").groupBy("paper_id").agg(F.bool_or(F.col("open_access").isNotNull() & (F.trim("open_access") != "")).alias("open"))
    status = F.when(F.col("local") == 1, "local").when(F.col("vault") == 1, "vault").when(F.col("open"), "download").otherwise("missing")
    return wanted.join(have, "paper_id", "left").select("paper_id", status.alias("status"))


@query(
    "fill_empty_merge",
    """WITH a AS (SELECT paper_id, max(venue) FILTER (WHERE trim(venue) <> '') AS venue, max(language) FILTER (WHERE trim(language) <> '') AS language FROM canonical GROUP BY paper_id),
b AS (SELECT paper_id, max(venue) FILTER (WHERE trim(venue) <> '') AS venue FROM search_records GROUP BY paper_id)
SELECT coalesce(a.paper_id, b.paper_id) AS paper_id, coalesce(a.venue, b.venue) AS venue, a.language,
CASE WHEN a.paper_id IS NULL THEN 'added' WHEN a.venue IS NULL AND b.venue IS NOT NULL THEN 'updated' ELSE 'unchanged' END AS change FROM a FULL JOIN b ON a.paper_id = b.paper_id""",
)
def fill_empty_merge(spark: SparkSession, sf: str) -> DataFrame:
    """New values fill only empty fields."""
    filled = lambda c: F.max(F.when(F.trim(c) != "", F.col(c)))
    a = table(spark, sf, "canonical").groupBy("paper_id").agg(filled("venue").alias("va"), filled("language").alias("language"), F.lit(1).alias("there"))
    b = table(spark, sf, "search_records").groupBy("paper_id").agg(filled("venue").alias("vb"))
    change = F.when(F.col("there").isNull(), "added").when(F.col("va").isNull() & F.col("vb").isNotNull(), "updated").otherwise("unchanged")
    return a.join(b, "paper_id", "full").select("paper_id", F.coalesce("va", "vb").alias("venue"), "language", change.alias("change"))


@query(
    "citation_numbering",
    """WITH f AS (SELECT doc_id, min(evidence_id) AS first FROM evidences GROUP BY doc_id) SELECT doc_id, row_number() OVER (ORDER BY first) AS number FROM f""",
)
def citation_numbering(spark: SparkSession, sf: str) -> DataFrame:
    """Papers numbered by their first citation."""
    from lexmill.operators.numbering import number_rows

    firsts = table(spark, sf, "evidences").groupBy("doc_id").agg(F.min("evidence_id").alias("first"))
    return number_rows(firsts, ["first"], "number").select("doc_id", "number")


@query(
    "evidence_strength",
    """SELECT concept_id, count(*) AS n, round(avg(similarity), 6) AS score, CASE WHEN count(*) >= 100 AND avg(similarity) >= 0.6 THEN 'strong' WHEN count(*) >= 50 AND avg(similarity) >= 0.5 THEN 'moderate' WHEN count(*) >= 10 THEN 'weak' ELSE 'thin' END AS strength
FROM evidences WHERE similarity BETWEEN 0 AND 1 GROUP BY concept_id""",
)
def evidence_strength(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "evidences").where(F.col("similarity").between(0.0, 1.0)).groupBy("concept_id").agg(F.count("*").alias("n"), F.avg("similarity").alias("m"))
    strength = F.when((F.col("n") >= 100) & (F.col("m") >= 0.6), "strong").when((F.col("n") >= 50) & (F.col("m") >= 0.5), "moderate").when(F.col("n") >= 10, "weak").otherwise("thin")
    return rows.select("concept_id", "n", F.round("m", 6).alias("score"), strength.alias("strength"))


@query("first_occurrence", "SELECT concept_id, doc_id, evidence_id FROM evidences QUALIFY row_number() OVER (PARTITION BY concept_id, doc_id ORDER BY evidence_id) = 1")
def first_occurrence(spark: SparkSession, sf: str) -> DataFrame:
    """A paper's block is shown only where it first occurs."""
    return table(spark, sf, "evidences").groupBy("concept_id", "doc_id").agg(F.min("evidence_id").alias("evidence_id"))


@query(
    "review_order",
    "SELECT rec_id, citation_count, year FROM canonical WHERE year BETWEEN 1900 AND 2025 ORDER BY coalesce(citation_count, 0) DESC, year DESC, rec_id LIMIT 100",
)
def review_order(spark: SparkSession, sf: str) -> DataFrame:
    """The first hundred records to review: a top-k report."""
    rows = table(spark, sf, "canonical").where(F.col("year").between(1900, 2025)).select("rec_id", "citation_count", "year")
    return rows.orderBy(F.desc(F.coalesce("citation_count", F.lit(0))), F.desc("year"), "rec_id").limit(100)


@query(
    "emergent_topics",
    "SELECT concept_id, concept_name FROM concepts ANTI JOIN (SELECT DISTINCT concept_id FROM evidences WHERE similarity BETWEEN 0.9 AND 1) USING (concept_id) ORDER BY concept_id LIMIT 20",
)
def emergent_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Topics that no strong evidence is aligned with, the first twenty."""
    aligned = table(spark, sf, "evidences").where(F.col("similarity").between(0.9, 1.0)).select("concept_id").distinct()
    return table(spark, sf, "concepts").select("concept_id", "concept_name").join(aligned, "concept_id", "left_anti").orderBy("concept_id").limit(20)


@query(
    "evidence_index",
    "SELECT concept_id, doc_id, min(evidence_id) AS first, row_number() OVER (PARTITION BY concept_id ORDER BY min(evidence_id)) AS place FROM evidences GROUP BY concept_id, doc_id",
)
def evidence_index(spark: SparkSession, sf: str) -> DataFrame:
    """Papers of each concept in the order of their evidence."""
    rows = table(spark, sf, "evidences").groupBy("concept_id", "doc_id").agg(F.min("evidence_id").alias("first"))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("concept_id").orderBy("first")))


@query(
    "venue_short_names",
    "SELECT c.rec_id, v.venue_id, v.venue_category FROM canonical c JOIN venues v ON c.venue = v.venue OR c.venue = v.short_name",
)
def venue_short_names(spark: SparkSession, sf: str) -> DataFrame:
    """Records with a known venue, by its full or its short name; an OR of equalities becomes one equi-join."""
    names = table(spark, sf, "venues").select("venue_id", "venue_category", F.explode(F.array_distinct(F.array("venue", "short_name"))).alias("name"))
    return table(spark, sf, "canonical").select("rec_id", "venue").join(names, F.col("venue") == F.col("name")).select("rec_id", "venue_id", "venue_category")


@query(
    "citation_format",
    "SELECT rec_id, '[' || rec_id || '] ' || coalesce(title, '') || '.' || CASE WHEN trim(doi) <> '' THEN ' DOI: ' || trim(doi) ELSE '' END AS citation FROM canonical",
)
def citation_format(spark: SparkSession, sf: str) -> DataFrame:
    doi = F.when(F.trim("doi") != "", F.concat(F.lit(" DOI: "), F.trim("doi"))).otherwise("")
    return table(spark, sf, "canonical").select("rec_id", F.concat(F.lit("["), F.col("rec_id").cast("string"), F.lit("] "), F.coalesce("title", F.lit("")), F.lit("."), doi).alias("citation"))


@query(
    "bibtex_entries",
    r"""SELECT rec_id, CASE WHEN regexp_matches(lower(venue), 'conference|symposium|workshop|conf\.|symp\.|wkshp\.') THEN 'inproceedings' ELSE 'article' END AS kind,
lower(regexp_extract(coalesce(authors[1], ''), '([A-Za-z]+)', 1)) || coalesce(year::VARCHAR, '') || '_' || rec_id AS key FROM canonical""",
)
def bibtex_entries(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.lower("venue").rlike(r"conference|symposium|workshop|conf\.|symp\.|wkshp\."), "inproceedings").otherwise("article")
    first = F.coalesce(F.get("authors", F.lit(0)), F.lit(""))
    key = F.concat(F.lower(F.regexp_extract(first, "([A-Za-z]+)", 1)), F.coalesce(F.col("year").cast("string"), F.lit("")), F.lit("_"), F.col("rec_id").cast("string"))
    return table(spark, sf, "canonical").select("rec_id", kind.alias("kind"), key.alias("key"))


@query(
    "pricing_summary",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n
FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY ALL""",
)
def pricing_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("date"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n")
    )


@query(
    "nation_revenue",
    """SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def nation_revenue(spark: SparkSession, sf: str) -> DataFrame:
    t = lambda n: table(spark, sf, n)
    rows = t("lineitem").select("l_orderkey", "l_extendedprice", "l_discount").join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(F.broadcast(t("nation").select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query(
    "event_windows",
    "SELECT time_bucket(INTERVAL '1 hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL",
)
def event_windows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))


plans.integers({"evidence_index": ["place"]})
