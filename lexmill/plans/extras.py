"""Pairs for fine-tuning, candidate keywords, gates of services and resolver cascades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import providers
from lexmill.functions import text as X
from lexmill.functions.vectors import dot
from lexmill.operators.ranking import top_per_group
from lexmill.plans.base import Plans
from lexmill.plans.passages import zone_classify
from lexmill.session import cut, table

plans = Plans()
QUERIES, SQL, query = plans.queries, plans.sql, plans.query


@query(
    "passage_vocabulary",
    """WITH w AS (SELECT DISTINCT evidence_id, unnest(string_split_regex(lower(text), '[^a-z-]+')) AS w FROM evidences WHERE text IS NOT NULL), n AS (SELECT count(*) AS n FROM evidences WHERE text IS NOT NULL),
d AS (SELECT w, count(*) AS df FROM w WHERE length(w) > 3 GROUP BY w) SELECT w AS word, df FROM d, n WHERE df >= least(2, n) AND df <= greatest(0.9 * n, 1)""",
)
def passage_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """Words with their document frequency between bounds, which are relaxed on tiny corpora."""
    rows = table(spark, sf, "evidences").where(F.col("text").isNotNull())
    n = rows.agg(F.count("*").alias("n"))
    words = rows.select(F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z-]+"))).alias("word")).where(F.length("word") > 3)
    df = words.groupBy("word").agg(F.count("*").alias("df")).join(F.broadcast(n))
    return df.where((F.col("df") >= F.least(F.lit(2), F.col("n"))) & (F.col("df") <= F.greatest(0.9 * F.col("n"), F.lit(1.0)))).select("word", "df")


@query(
    "translation_gate",
    "SELECT DISTINCT sha256(text) AS key, length(text) AS n FROM documents WHERE length(trim(text)) >= 10 AND coalesce(lang, 'und') NOT IN ('es')",
)
def translation_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that still have to be translated: long enough, not in the target language, each once."""
    rows = table(spark, sf, "documents").where((F.length(F.trim("text")) >= 10) & ~F.coalesce("lang", F.lit("und")).isin("es"))
    return rows.select(F.sha2("text", 256).alias("key"), F.length("text").alias("n")).distinct()


plans.integers({"translation_gate": ["n"]})


@query(
    "resolver_cascade",
    f"""WITH c AS (SELECT hit_id, {X.sql_doi('doi')} AS d, paper_id FROM search_records), a AS (SELECT {X.sql_doi('doi')} AS d, min(paper_id) AS v FROM canonical WHERE {X.sql_doi('doi')} <> '' GROUP BY d),
b AS (SELECT paper_id, min(pdf_file) AS v FROM papers GROUP BY paper_id)
SELECT c.hit_id, CASE WHEN b.v IS NOT NULL THEN 'vault' WHEN a.v IS NOT NULL THEN 'doi' END AS resolver, coalesce(b.v, a.v) AS value FROM c LEFT JOIN b ON c.paper_id = b.paper_id LEFT JOIN a ON c.d = a.d AND c.d <> ''""",
)
def resolver_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """A file or address for every hit: the first resolver that has one."""
    hits = table(spark, sf, "search_records").select("hit_id", "paper_id", X.normalize_doi(F.col("doi")).alias("d"))
    vault = table(spark, sf, "papers").groupBy("paper_id").agg(F.min("pdf_file").alias("value"))
    doi = X.normalize_doi(F.col("doi"))
    known = table(spark, sf, "canonical").where(doi != "").groupBy(doi.alias("d")).agg(F.min("paper_id").alias("value"))
    one = hits.join(vault, "paper_id").select("hit_id", F.lit(1).alias("priority"), F.lit("vault").alias("resolver"), "value")
    two = hits.where("d <> ''").join(known, "d").select("hit_id", F.lit(2).alias("priority"), F.lit("doi").alias("resolver"), "value")
    return providers.first_of(hits.select("hit_id"), "hit_id", one.unionByName(two))


@query(
    "training_pairs",
    """WITH e AS (SELECT evidence_id, concept_id, doc_id, md5('42:' || evidence_id) AS h FROM evidences WHERE trim(text) <> ''),
p AS (SELECT evidence_id AS a, lead(evidence_id) OVER (PARTITION BY concept_id, doc_id ORDER BY h) AS b, 1 AS label, h FROM e),
k AS (SELECT *, ('0x' || left(h, 8))::BIGINT % 997 AS bucket FROM e),
n AS (SELECT evidence_id AS a, lead(evidence_id) OVER w AS b, 0 AS label, h, concept_id AS c, lead(concept_id) OVER w AS oc FROM k WINDOW w AS (PARTITION BY bucket ORDER BY h))
SELECT a, b, label FROM (SELECT a, b, label FROM p WHERE b IS NOT NULL ORDER BY h LIMIT 1000) UNION ALL SELECT a, b, label FROM (SELECT a, b, label FROM n WHERE oc <> c ORDER BY h LIMIT 1000)""",
)
def training_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs for fine-tuning an encoder: passages of one paper and concept are alike, as many of other concepts are not.

    Each passage is paired with the next of its group in an order given by a seeded hash, so groups of any size give as
    many pairs as rows; a sample of 2,000 pairs, the same in every run, is the operator's result.
    """
    from pyspark.sql import Window

    rows = table(spark, sf, "evidences").where(F.trim("text") != "").select("evidence_id", "concept_id", "doc_id", F.md5(F.concat(F.lit("42:"), F.col("evidence_id").cast("string"))).alias("h"))
    alike = rows.withColumn("other", F.lead("evidence_id").over(Window.partitionBy("concept_id", "doc_id").orderBy("h")))
    positive = alike.where(F.col("other").isNotNull()).select(F.col("evidence_id").alias("a"), F.col("other").alias("b"), F.lit(1).alias("label"), "h")
    bucket = rows.withColumn("bucket", F.conv(F.left("h", F.lit(8)), 16, 10).cast("long") % 997)
    nexts = Window.partitionBy("bucket").orderBy("h")
    unlike = bucket.withColumn("other", F.lead("evidence_id").over(nexts)).withColumn("oc", F.lead("concept_id").over(nexts))
    negative = unlike.where(F.col("oc") != F.col("concept_id")).select(F.col("evidence_id").alias("a"), F.col("other").alias("b"), F.lit(0).alias("label"), "h")
    return positive.orderBy("h").limit(1000).unionByName(negative.orderBy("h").limit(1000)).select("a", "b", "label")


@query("candidate_keywords")
def candidate_keywords(spark: SparkSession, sf: str) -> DataFrame:
    """The five word pairs of each passage that are nearest to it, by the default encoder."""
    rows = table(spark, sf, "evidences").where(F.trim("text") != "").select("evidence_id", "text")
    words = F.filter(F.split(F.lower("text"), "[^a-z-]+"), lambda x: F.length(x) > 3)
    grams = rows.select("evidence_id", "text", words.alias("w")).where(F.size("w") > 1)
    pairs = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.array_join(F.slice(F.col("w"), i, 2), " "))
    flat = grams.select("evidence_id", F.explode(F.array_distinct(pairs)).alias("term"))
    encode = lambda c: providers.apply(providers.hashed_encoder(64), F.col(c), "array<double>")
    terms = cut(flat.select("term").distinct().select("term", encode("term").alias("tv")))
    texts = rows.select("evidence_id", encode("text").alias("v"))
    scored = flat.join(terms, "term").join(texts, "evidence_id").select("evidence_id", "term", F.round(dot(F.col("v"), F.col("tv")), 6).alias("score"))
    return top_per_group(scored, ["evidence_id"], [F.desc("score"), F.col("term")], 5)


@query("related_work")
def related_work(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a report: the claims of each section with their papers, numbered by first citation."""
    from lexmill.operators.numbering import number_rows

    docs = table(spark, sf, "documents").where(F.col("paper_id").isNotNull()).select("doc_id", "paper_id", "section", "text")
    claims = docs.join(zone_classify(spark, sf).where("zone = 'claim' AND confidence > 0.3"), "doc_id")
    cited = number_rows(claims.groupBy("paper_id").agg(F.min("doc_id").alias("first")), ["first"], "number")
    line = F.concat(F.lit("- "), F.regexp_extract("text", r"^([^.!?]+[.!?]?)", 1), F.lit(" ["), F.col("number").cast("string"), F.lit("]"))
    return claims.join(cited, "paper_id").select(F.coalesce("section", F.lit("other")).alias("part"), F.col("doc_id").alias("place"), line.alias("line"))
