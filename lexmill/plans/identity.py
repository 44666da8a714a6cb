"""Identity, merging and deduplication of bibliographic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators import identity as I
from lexmill.operators.numbering import number_rows
from lexmill.plans.base import Plans
from lexmill.session import cut, table

plans = Plans()
QUERIES, SQL, query = plans.queries, plans.sql, plans.query


_KEYS = f"""
keyed AS (
  SELECT rec_id AS record, unnest([
    CASE WHEN trim(pmid) <> '' THEN 'pmid:' || trim(pmid) END,
    CASE WHEN {X.sql_doi('doi')} <> '' THEN 'doi:' || {X.sql_doi('doi')} END,
    CASE WHEN {X.sql_title('title')} <> '' AND year IS NOT NULL AND year <> 0
           THEN 'ty:' || sha1({X.sql_title('title')}) || ':' || year
         WHEN length({X.sql_title('title')}) >= {I.TITLE_ONLY} THEN 't:' || sha1({X.sql_title('title')}) END]) AS key
  FROM canonical
), keys AS (SELECT record, key FROM keyed WHERE key IS NOT NULL)"""
_GROUPS = f"""{_KEYS}, reach AS (
  SELECT record, record AS other FROM keys
  UNION
  SELECT r.record, b.record FROM reach r JOIN keys a ON r.other = a.record JOIN keys b ON a.key = b.key
), groups AS (
  SELECT c.rec_id AS record, coalesce(min(r.other), c.rec_id) AS component FROM canonical c LEFT JOIN reach r ON c.rec_id = r.record GROUP BY c.rec_id
)"""


@query("identity_keys", f"WITH {_KEYS} SELECT record, key FROM keys")
def identity_keys(spark: SparkSession, sf: str) -> DataFrame:
    return I.identity_keys(table(spark, sf, "canonical"), "rec_id")


def _groups(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "canonical")
    return I.components(I.identity_keys(rows, "rec_id"), rows.select(F.col("rec_id").alias("record")))


@query("identity_groups", f"WITH RECURSIVE {_GROUPS} SELECT record, component FROM groups")
def identity_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _groups(spark, sf)


@query(
    "merged_records",
    f"""WITH RECURSIVE {_GROUPS}, rows AS (
  SELECT g.component, c.*, {X.sql_doi('c.doi')} AS ndoi FROM canonical c JOIN groups g ON c.rec_id = g.record
), scored AS (
  SELECT *, row_number() OVER (PARTITION BY component ORDER BY CASE WHEN ndoi <> '' THEN 1 ELSE 0 END DESC,
    (CASE WHEN title <> '' AND title <> '0' THEN 1 ELSE 0 END) + (CASE WHEN abstract <> '' AND abstract <> '0' THEN 1 ELSE 0 END)
    + (CASE WHEN year <> 0 THEN 1 ELSE 0 END) + (CASE WHEN venue <> '' AND venue <> '0' THEN 1 ELSE 0 END)
    + (CASE WHEN document_type <> '' THEN 1 ELSE 0 END) + (CASE WHEN language <> '' THEN 1 ELSE 0 END) DESC,
    coalesce(len(authors), 0) DESC, coalesce(len(keywords), 0) DESC, rec_id) AS r FROM rows
), years AS (
  SELECT component, year, row_number() OVER (PARTITION BY component ORDER BY count(*) DESC, year) AS r FROM rows WHERE year <> 0 GROUP BY component, year
), dois AS (
  SELECT component, ndoi, row_number() OVER (PARTITION BY component ORDER BY count(*) DESC, ndoi) AS r FROM rows WHERE ndoi <> '' GROUP BY component, ndoi
)
SELECT w.component, max(CASE WHEN s.r = 1 THEN s.paper_id END) AS paper_id, any_value(d.ndoi) AS doi, any_value(y.year)::INT AS year,
  arg_max(w.title, (length(w.title), -w.rec_id)) FILTER (WHERE trim(w.title) <> '') AS title,
  arg_max(w.abstract, (length(w.abstract), -w.rec_id)) FILTER (WHERE trim(w.abstract) <> '') AS abstract,
  arg_max(w.venue, (length(w.venue), -w.rec_id)) FILTER (WHERE trim(w.venue) <> '') AS venue,
  arg_min(w.document_type, w.rec_id) FILTER (WHERE w.document_type <> '') AS document_type,
  max(CASE WHEN w.citation_count <> 0 THEN w.citation_count END)::INT AS citation_count,
  list_sort(list(DISTINCT w.source)) AS sources, count(*) AS merged_from
FROM rows w JOIN scored s ON w.rec_id = s.rec_id
LEFT JOIN (SELECT * FROM years WHERE r = 1) y ON w.component = y.component
LEFT JOIN (SELECT * FROM dois WHERE r = 1) d ON w.component = d.component
GROUP BY w.component""",
)
def merged_records(spark: SparkSession, sf: str) -> DataFrame:
    """One merged record for each identity group, field by field."""
    groups = _groups(spark, sf)
    rows = cut(table(spark, sf, "canonical").join(groups.withColumnRenamed("record", "rec_id"), "rec_id"))
    count = F.when(F.col("citation_count") != 0, F.col("citation_count"))
    base = rows.groupBy("component").agg(
        I.longest(F.col("title")).alias("title"),
        I.longest(F.col("abstract")).alias("abstract"),
        I.longest(F.col("venue")).alias("venue"),
        I.first_non_empty(F.col("document_type")).alias("document_type"),
        F.max(count).alias("citation_count"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.count("*").alias("merged_from"),
    )
    year = I.most_frequent(rows.where(F.col("year") != 0), ["component"], "year")
    doi = I.most_frequent(rows.select("component", F.nullif(X.normalize_doi(F.col("doi")), F.lit("")).alias("doi")), ["component"], "doi")
    first = I.primary(rows, "component").drop("primary")
    return base.join(first, "component").join(year, "component", "left").join(doi, "component", "left").select(
        "component", "paper_id", "doi", "year", "title", "abstract", "venue", "document_type", "citation_count", "sources", "merged_from"
    )


@query(
    "merged_authors",
    f"""WITH RECURSIVE {_GROUPS}, items AS (
  SELECT g.component, c.rec_id, unnest(c.authors) AS item, generate_subscripts(c.authors, 1) AS pos FROM canonical c JOIN groups g ON c.rec_id = g.record
), firsts AS (SELECT component, item, min((rec_id, pos)) AS place FROM items GROUP BY component, item)
SELECT component, list(item ORDER BY place) AS authors FROM firsts GROUP BY component""",
)
def merged_authors(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "canonical").join(_groups(spark, sf).withColumnRenamed("record", "rec_id"), "rec_id")
    return I.ordered_union(rows, ["component"], "authors", "rec_id")


@query(
    "merged_keywords",
    f"""WITH RECURSIVE {_GROUPS}, items AS (SELECT g.component, unnest(c.keywords) AS k FROM canonical c JOIN groups g ON c.rec_id = g.record)
SELECT component, list_sort(list(DISTINCT k)) AS keywords FROM items WHERE k <> '' GROUP BY component""",
)
def merged_keywords(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "canonical").join(_groups(spark, sf).withColumnRenamed("record", "rec_id"), "rec_id")
    items = rows.select("component", F.explode("keywords").alias("k")).where("k <> ''").distinct()
    return items.groupBy("component").agg(F.array_sort(F.collect_list("k")).alias("keywords"))


@query(
    "merge_statistics",
    f"""WITH RECURSIVE {_GROUPS}, sizes AS (SELECT component, count(*) AS n FROM groups GROUP BY component)
SELECT (SELECT count(*) FROM canonical) AS records, count(*) AS groups, (SELECT count(*) FROM canonical) - count(*) AS duplicates_removed,
       count(*) FILTER (WHERE n > 1) AS merged_groups FROM sizes""",
)
def merge_statistics(spark: SparkSession, sf: str) -> DataFrame:
    sizes = _groups(spark, sf).groupBy("component").agg(F.count("*").alias("n"))
    return sizes.agg(
        F.sum("n").alias("records"), F.count("*").alias("groups"), (F.sum("n") - F.count("*")).alias("duplicates_removed"),
        F.count_if(F.col("n") > 1).alias("merged_groups"),
    )


@query(
    "unique_per_source",
    f"""WITH RECURSIVE {_GROUPS}, pairs AS (SELECT DISTINCT g.component, c.source FROM canonical c JOIN groups g ON c.rec_id = g.record)
SELECT source, count(*) AS n_groups, count(*) FILTER (WHERE k = 1) AS only_here
FROM pairs JOIN (SELECT component, count(*) AS k FROM pairs GROUP BY component) USING (component) GROUP BY source""",
)
def unique_per_source(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "canonical").select("rec_id", "source").join(_groups(spark, sf).withColumnRenamed("record", "rec_id"), "rec_id")
    pairs = rows.select("component", "source").distinct()
    alone = pairs.groupBy("component").agg(F.count("*").alias("k"))
    return pairs.join(alone, "component").groupBy("source").agg(F.count("*").alias("n_groups"), F.count_if(F.col("k") == 1).alias("only_here"))


@query(
    "source_dedup",
    """SELECT paper_id, min(hit_id) AS hit_id, coalesce(list_sort(list(DISTINCT query_stream) FILTER (WHERE query_stream IS NOT NULL)), []) AS streams, count(*) AS n
FROM search_records GROUP BY paper_id""",
)
def source_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The first hit of each paper; the streams of its hits accumulate."""
    return table(spark, sf, "search_records").groupBy("paper_id").agg(
        F.min("hit_id").alias("hit_id"), F.array_sort(F.collect_set("query_stream")).alias("streams"), F.count("*").alias("n")
    )


@query(
    "stream_dedup_cap",
    """WITH firsts AS (
  SELECT query_stream, paper_id, min(hit_id) AS hit_id FROM search_records WHERE query_stream IS NOT NULL GROUP BY ALL
), capped AS (
  SELECT *, row_number() OVER (PARTITION BY query_stream ORDER BY hit_id) AS r FROM firsts
), one AS (
  SELECT paper_id, min(hit_id) AS hit_id FROM capped WHERE r <= 200 GROUP BY paper_id
)
SELECT paper_id, hit_id, row_number() OVER (ORDER BY hit_id) AS number FROM one""",
)
def stream_dedup_cap(spark: SparkSession, sf: str) -> DataFrame:
    """Dedup inside each stream, its quota, dedup across streams, then running numbers."""
    hits = table(spark, sf, "search_records").where(F.col("query_stream").isNotNull())
    firsts = hits.groupBy("query_stream", "paper_id").agg(F.min("hit_id").alias("hit_id"))
    rank = F.row_number().over(Window.partitionBy("query_stream").orderBy("hit_id"))
    one = firsts.withColumn("r", rank).where("r <= 200").groupBy("paper_id").agg(F.min("hit_id").alias("hit_id"))
    return number_rows(one, ["hit_id"], "number")


@query(
    "latest_snapshot",
    """SELECT paper_id, source, rec_id, retrieved_at FROM canonical
QUALIFY row_number() OVER (PARTITION BY paper_id, source ORDER BY retrieved_at DESC, rec_id DESC) = 1""",
)
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "canonical").select("paper_id", "source", "rec_id", "retrieved_at")
    return rows.groupBy("paper_id", "source").agg(
        F.max_by("rec_id", F.struct("retrieved_at", "rec_id")).alias("rec_id"), F.max("retrieved_at").alias("retrieved_at")
    )


@query(
    "selection_fingerprint",
    """SELECT source, sum(('0x' || substr(md5(paper_id), 1, 8))::BIGINT)::BIGINT AS fingerprint, count(*) AS n
FROM (SELECT DISTINCT source, paper_id FROM canonical) GROUP BY source""",
)
def selection_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """A hash of the set of ids of each source, by a sum that needs no order: a checkpoint is valid while it stays."""
    ids = table(spark, sf, "canonical").select("source", "paper_id").distinct()
    part = F.conv(F.substring(F.md5("paper_id"), 1, 8), 16, 10).cast("long")
    return ids.groupBy("source").agg(F.sum(part).alias("fingerprint"), F.count("*").alias("n"))


_GID = f"CASE WHEN {X.sql_doi('doi')} <> '' THEN 'doi:' || {X.sql_doi('doi')} ELSE 'title:' || sha1({X.sql_title('title')}) END"


def _global_id() -> Column:
    doi = X.normalize_doi(F.col("doi"))
    return F.when(doi != "", F.concat(F.lit("doi:"), doi)).otherwise(F.concat(F.lit("title:"), F.sha1(X.normalized_title(F.col("title")))))


@query(
    "manual_ingestion",
    f"""WITH known AS (SELECT DISTINCT {_GID} AS g FROM canonical), new AS (
  SELECT g, min(hit_id) AS hit_id FROM (SELECT hit_id, {_GID} AS g FROM search_records) GROUP BY g
)
SELECT g AS global_id, hit_id, (SELECT max(rec_id) FROM canonical) + row_number() OVER (ORDER BY hit_id) AS new_id
FROM new ANTI JOIN known USING (g)""",
)
def manual_ingestion(spark: SparkSession, sf: str) -> DataFrame:
    """Records whose identity is unknown get the next free ids, in order of arrival."""
    canonical, hits = table(spark, sf, "canonical"), table(spark, sf, "search_records")
    known = canonical.select(_global_id().alias("global_id")).distinct()
    new = hits.select("hit_id", _global_id().alias("global_id")).groupBy("global_id").agg(F.min("hit_id").alias("hit_id"))
    top = canonical.agg(F.max("rec_id").alias("top"))
    numbered = number_rows(new.join(known, "global_id", "left_anti"), ["hit_id"], "r")
    return numbered.join(F.broadcast(top)).select("global_id", "hit_id", (F.col("top") + F.col("r")).alias("new_id"))
