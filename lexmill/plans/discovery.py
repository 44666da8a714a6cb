"""Topics, findings, profiles and news-like classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.functions.vectors import dot
from lexmill.operators.ranking import top_per_group
from lexmill.plans.base import Plans
from lexmill.session import cut, table
from lexmill.sources import boolean, payloads, tagged

plans = Plans()
QUERIES, SQL, query = plans.queries, plans.sql, plans.query

FOCUS = ["gait", "pain", "sleep", "walking", "balance", "grip"]
#: Aliases of signals, longest first, and their labels.
ALIASES = [("electromyography", "EMG"), ("accelerometers", "ACC"), ("accelerometry", "ACC"), ("pressure maps", "PRESSURE"), ("radar traces", "RADAR"),
           ("audio diaries", "AUDIO"), ("depth video", "VIDEO"), ("depth imaging", "VIDEO"), ("goniometers", "GONIO"), ("clinical notes", "NOTES"), ("emg", "EMG")]


@query(
    "boolean_query",
    r"""SELECT rec_id FROM canonical WHERE (regexp_matches(lower(coalesce(title, '')), '\bgait\b') OR contains(lower(coalesce(title, '')), 'fall prediction'))
AND (contains(lower(coalesce(title, '')), 'transform') OR regexp_matches(lower(coalesce(title, '')), '\bclassifier\b'))""",
)
def boolean_query(spark: SparkSession, sf: str) -> DataFrame:
    """A boolean query compiled to a predicate."""
    wanted = boolean.matches(F.col("title"), '(gait OR "fall prediction") AND (transform* OR classifier)')
    return table(spark, sf, "canonical").where(wanted).select("rec_id")


@query("inverted_abstract", "SELECT rec_id, md5(array_to_string(string_split(abstract, ' '), ' ')) AS abstract_md5 FROM canonical WHERE abstract IS NOT NULL AND abstract <> ''")
def inverted_abstract(spark: SparkSession, sf: str) -> DataFrame:
    """Abstracts rebuilt from an index of words and their places, row by row."""
    rows = table(spark, sf, "canonical").where("abstract IS NOT NULL AND abstract <> ''").select("rec_id", F.split("abstract", " ").alias("w"))
    words = F.array_distinct("w")
    places = lambda word: F.filter(F.transform(F.col("w"), lambda x, i: F.when(x == word, i)), lambda i: i.isNotNull())
    index = F.map_from_arrays(words, F.transform(words, places))
    return rows.select("rec_id", F.md5(payloads.from_inverted(index)).alias("abstract_md5"))


@query(
    "tagged_round_trip",
    f"""SELECT hit_id::VARCHAR AS accession_number, {X.sql_title('title')} AS title, {X.sql_text('abstract')} AS abstract, {X.sql_doi('doi')} AS doi, year
FROM search_records WHERE length({X.sql_title('title')}) >= 5""",
)
def tagged_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Records written as tagged text and read again."""
    hits = table(spark, sf, "search_records")
    one = lambda c: X.normalize_text(F.col(c))
    record = F.concat(
        F.lit("PT J\nTI "), one("title"), F.lit("\nAB "), one("abstract"), F.lit("\nDI "), X.normalize_doi(F.col("doi")),
        F.lit("\nPY "), F.coalesce(F.col("year").cast("string"), F.lit("")), F.lit("\nUT "), F.col("hit_id").cast("string"),
    )
    return tagged.plain_records(hits.select(record.alias("record"))).select("accession_number", "title", "abstract", "doi", "year")


@query(
    "vocabulary_hits",
    "SELECT doc_id, list_sort(list_distinct(list_filter([" + ", ".join(f"CASE WHEN contains(lower(text), '{a}') THEN '{b}' END" for a, b in ALIASES)
    + "], lambda x: x IS NOT NULL))) AS labels FROM documents WHERE text IS NOT NULL",
)
def vocabulary_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical labels of the vocabulary's words that a document holds."""
    low = F.lower("text")
    found = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(a)), F.lit(b)) for a, b in ALIASES]))
    rows = table(spark, sf, "documents").where(F.col("text").isNotNull())
    return rows.select("doc_id", F.array_sort(F.array_distinct(found)).alias("labels"))


def _canonical_label(value):
    """Label of a value: an exact label or alias, else the longest alias that it contains as a whole word, else itself."""
    low = F.lower(F.trim(value))
    out = F.trim(value)
    for alias, label in reversed(ALIASES):
        out = F.when(low.rlike(rf"\b{alias}\b"), F.lit(label)).otherwise(out)
    return out


@query(
    "values_canonicalised",
    "WITH v AS (SELECT rec_id, unnest(keywords) AS k FROM canonical) SELECT rec_id, list_sort(list(DISTINCT "
    + "CASE " + " ".join(rf"WHEN regexp_matches(lower(trim(k)), '\b{a}\b') THEN '{b}'" for a, b in ALIASES) + " ELSE trim(k) END)) AS labels FROM v GROUP BY rec_id",
)
def values_canonicalised(spark: SparkSession, sf: str) -> DataFrame:
    labels = F.array_sort(F.array_distinct(F.transform("keywords", _canonical_label)))
    return table(spark, sf, "canonical").where(F.size("keywords") > 0).select("rec_id", labels.alias("labels"))


@query(
    "echo_audit",
    """WITH e AS (SELECT keywords AS examples FROM canonical WHERE len(keywords) >= 3 ORDER BY rec_id LIMIT 1),
k AS (SELECT rec_id, list_transform(keywords, lambda x: lower(x)) AS ks, (SELECT list_transform(examples, lambda x: lower(x)) FROM e) AS ex FROM canonical WHERE len(keywords) > 0),
c AS (SELECT rec_id, len(list_filter(ks, lambda x: list_contains(ex, x) AND contains(x, ' '))) AS hits, len(list_filter(ks, lambda x: NOT list_contains(ex, x))) AS own FROM k)
SELECT rec_id, CASE WHEN hits >= 2 AND own = 0 THEN 'full' WHEN hits >= 2 THEN 'partial' ELSE 'none' END AS echo FROM c""",
)
def echo_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Do a record's values merely repeat the examples of a field's description? Only examples of several words can tell."""
    rows = table(spark, sf, "canonical").where(F.size("keywords") > 0).select("rec_id", "keywords")
    example = rows.where(F.size("keywords") >= 3).agg(F.min_by(F.transform("keywords", lambda x: F.lower(x)), "rec_id").alias("ex"))
    ks = F.transform("keywords", lambda x: F.lower(x))
    joined = rows.join(F.broadcast(example))
    hits = F.size(F.filter(ks, lambda x: F.array_contains(F.col("ex"), x) & F.contains(x, F.lit(" "))))
    own = F.size(F.filter(ks, lambda x: ~F.array_contains(F.col("ex"), x)))
    return joined.select("rec_id", F.when((hits >= 2) & (own == 0), "full").when(hits >= 2, "partial").otherwise("none").alias("echo"))


@query(
    "news_classes",
    "SELECT doc_id, CASE WHEN contains(lower(text), 'opinion') OR contains(lower(text), 'perspective') THEN 'opinion' WHEN contains(lower(text), 'editorial') THEN 'editorial' "
    "WHEN contains(lower(text), 'blog') OR contains(lower(text), 'post') THEN 'blog' WHEN contains(lower(text), 'press release') OR contains(lower(text), 'announce') THEN 'press_release' ELSE 'news' END AS category, "
    f"round(least(1.0, ({X.sql_hits('text', FOCUS)}) / greatest(1.0, {len(FOCUS)} * 0.3)), 6) AS relevance FROM documents WHERE length(text) >= 100",
)
def news_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Kind and relevance of an article by words alone, the stand-in for a model."""
    low = F.lower("text")
    has = lambda *ws: F.expr("false") if not ws else [F.contains(low, F.lit(w)) for w in ws]
    o, e, b, p = has("opinion", "perspective"), has("editorial"), has("blog", "post"), has("press release", "announce")
    kind = F.when(o[0] | o[1], "opinion").when(e[0], "editorial").when(b[0] | b[1], "blog").when(p[0] | p[1], "press_release").otherwise("news")
    relevance = F.round(F.least(F.lit(1.0), X.hits(F.col("text"), FOCUS) / F.greatest(F.lit(1.0), F.lit(len(FOCUS) * 0.3))), 6)
    return table(spark, sf, "documents").where(F.length("text") >= 100).select("doc_id", kind.alias("category"), relevance.alias("relevance"))


@query(
    "news_focus_top",
    f"WITH h AS (SELECT doc_id, venue_id, {X.sql_hits('text', FOCUS)} AS hits FROM documents WHERE text IS NOT NULL) "
    "SELECT doc_id, venue_id, hits, row_number() OVER (PARTITION BY venue_id ORDER BY hits DESC, doc_id) AS rank FROM h WHERE hits >= 1 QUALIFY rank <= 3",
)
def news_focus_top(spark: SparkSession, sf: str) -> DataFrame:
    """The three articles of each venue with most focus terms."""
    rows = table(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", "venue_id", X.hits(F.col("text"), FOCUS).alias("hits")).where("hits >= 1")
    return top_per_group(rows, ["venue_id"], [F.desc("hits"), F.col("doc_id")], 3)


@query(
    "soft_filter",
    """WITH q AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 0), s AS (SELECT vec_id, label, round(list_dot_product(embedding::DOUBLE[], (SELECT q FROM q)::DOUBLE[]), 6) AS score FROM embeddings),
n AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS r, count(*) OVER (PARTITION BY label) AS n FROM s)
SELECT vec_id, label, score FROM n WHERE r <= CASE WHEN n >= 10 THEN greatest(10, floor(n * 0.8)) ELSE floor(n * 0.5) END""",
)
def soft_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The better four fifths of each label's vectors, ten at least; where there are fewer than ten, the better half."""
    rows = table(spark, sf, "embeddings")
    asked = rows.where("vec_id = 0").select(F.col("embedding").alias("q"))
    scored = cut(rows.join(F.broadcast(asked)).select("vec_id", "label", F.round(dot(F.col("embedding"), F.col("q")), 6).alias("score")))
    sizes = scored.groupBy("label").agg(F.count("*").alias("n"))
    keep = F.when(F.col("n") >= 10, F.greatest(F.lit(10), F.floor(F.col("n") * 0.8))).otherwise(F.floor(F.col("n") * 0.5))
    r = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("r", r).join(sizes, "label").where(F.col("r") <= keep).select("vec_id", "label", "score")


_TOPICS = """topics AS (SELECT concept_id, count(DISTINCT doc_id) AS papers, round(avg(similarity), 4) AS score FROM evidences WHERE similarity BETWEEN 0 AND 1 GROUP BY concept_id)"""


@query(
    "dynamic_threshold",
    f"""WITH {_TOPICS}, valid AS (SELECT *, row_number() OVER (ORDER BY score DESC, concept_id) AS r, count(*) OVER () AS n FROM topics WHERE papers >= 2),
t AS (SELECT CASE WHEN count(*) FILTER (WHERE score >= 0.9) >= 2 THEN 0.9 ELSE least(0.9, coalesce(min(score) FILTER (WHERE r = least(2, n)), 0.9)) END AS cut FROM valid)
SELECT concept_id, papers, score FROM topics WHERE score >= (SELECT cut FROM t)""",
)
def dynamic_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """A threshold on topics, lowered until at least two topics with two papers stay, never raised."""
    good = table(spark, sf, "evidences").where(F.col("similarity").between(0.0, 1.0))
    topics = cut(good.groupBy("concept_id").agg(F.count_distinct("doc_id").alias("papers"), F.round(F.avg("similarity"), 4).alias("score")))
    second = topics.where("papers >= 2").orderBy(F.desc("score"), "concept_id").limit(2).agg(F.min("score").alias("second"))
    return topics.join(F.broadcast(second)).where(F.col("score") >= F.least(F.lit(0.9), F.coalesce("second", F.lit(0.9)))).select("concept_id", "papers", "score")


@query(
    "finding_filter",
    f"""WITH f AS (SELECT evidence_id, concept_id, similarity + 0.15 * ({X.sql_hits('text', FOCUS)}) AS score FROM evidences WHERE similarity BETWEEN 0.4 AND 1 AND text IS NOT NULL),
c AS (SELECT concept_id, quantile_cont(score, 0.3) AS cut FROM f GROUP BY concept_id) SELECT evidence_id, concept_id, round(score, 6) AS score FROM f JOIN c USING (concept_id) WHERE score >= cut""",
)
def finding_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Findings above the percentile of their concept, after a boost for focus terms."""
    from lexmill.operators.ranking import percentile_cut

    rows = table(spark, sf, "evidences").where(F.col("similarity").between(0.4, 1.0) & F.col("text").isNotNull())
    scored = rows.select("evidence_id", "concept_id", (F.col("similarity") + 0.15 * X.hits(F.col("text"), FOCUS)).alias("score"))
    return percentile_cut(scored, ["concept_id"], "score", 0.3).select("evidence_id", "concept_id", F.round("score", 6).alias("score"))


@query(
    "cluster_eligibility",
    """SELECT concept_id, lower(section) AS section, count(*) AS size, count(*) >= 2 OR max(similarity) >= 0.75 AS eligible FROM evidences WHERE similarity BETWEEN 0 AND 1 AND section IS NOT NULL GROUP BY concept_id, lower(section)""",
)
def cluster_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "evidences").where(F.col("similarity").between(0.0, 1.0) & F.col("section").isNotNull())
    return rows.groupBy("concept_id", F.lower("section").alias("section")).agg(
        F.count("*").alias("size"), ((F.count("*") >= 2) | (F.max("similarity") >= 0.75)).alias("eligible")
    )


@query(
    "tail_cut",
    r"""WITH l AS (SELECT text_id, generate_subscripts(string_split(full_text, chr(10)), 1) AS i, lower(trim(unnest(string_split(full_text, chr(10))))) AS line FROM papers WHERE full_text IS NOT NULL),
b AS (SELECT text_id, coalesce(max(i) FILTER (WHERE line IN ('abstract', 'introduction', 'methods', 'results', 'discussion', 'conclusion')), 0) AS body, max(i) AS n FROM l GROUP BY text_id),
t AS (SELECT l.text_id, min(i) AS tail FROM l JOIN b USING (text_id) WHERE i > body AND line IN ('references', 'bibliography', 'funding', 'acknowledgments', 'acknowledgements') GROUP BY l.text_id)
SELECT b.text_id, body::INT AS last_body, coalesce(t.tail - 1, b.n)::INT AS lines_kept FROM b LEFT JOIN t USING (text_id)""",
)
def tail_cut(spark: SparkSession, sf: str) -> DataFrame:
    """Lines before the first tail heading that follows the last body heading, found inside each row."""
    lines = F.transform(F.split("full_text", "\n"), lambda x: F.lower(F.trim(x)))
    rows = table(spark, sf, "papers").where(F.col("full_text").isNotNull()).select("text_id", lines.alias("ls"))
    at = lambda names: F.filter(F.transform(F.col("ls"), lambda x, i: F.when(x.isin(*names), i + 1)), lambda i: i.isNotNull())
    body = F.coalesce(F.array_max(at(["abstract", "introduction", "methods", "results", "discussion", "conclusion"])), F.lit(0))
    tail = at(["references", "bibliography", "funding", "acknowledgments", "acknowledgements"])
    placed = rows.select("text_id", F.size("ls").alias("n"), body.alias("last_body"), tail.alias("tails"))
    first = F.array_min(F.filter("tails", lambda i: i > F.col("last_body")))
    return placed.select("text_id", "last_body", F.coalesce(first - 1, F.col("n")).alias("lines_kept"))


@query(
    "captions",
    r"""WITH l AS (SELECT text_id, generate_subscripts(string_split(full_text, chr(10)), 1) AS i, trim(unnest(string_split(full_text, chr(10)))) AS line FROM papers WHERE full_text IS NOT NULL)
SELECT text_id, i::INT AS line_no, lower(regexp_extract(line, '^(Table|Figure|Fig\.)\s*[0-9]+', 1)) AS kind, regexp_extract(line, '^(?:Table|Figure|Fig\.)\s*([0-9]+)', 1)::INT AS number FROM l WHERE regexp_matches(line, '^(Table|Figure|Fig\.)\s*[0-9]+')""",
)
def captions(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "papers").where(F.col("full_text").isNotNull()).select("text_id", F.posexplode(F.split("full_text", "\n")).alias("i", "l"))
    line = F.trim("l")
    return lines.where(line.rlike(r"^(Table|Figure|Fig\.)\s*[0-9]+")).select(
        "text_id", (F.col("i") + 1).alias("line_no"), F.lower(F.regexp_extract(line, r"^(Table|Figure|Fig\.)\s*[0-9]+", 1)).alias("kind"),
        F.regexp_extract(line, r"^(?:Table|Figure|Fig\.)\s*([0-9]+)", 1).cast("int").alias("number"),
    )


@query(
    "section_text",
    """WITH s AS (SELECT text_id, unnest(map_keys(clean_sections)) AS section, unnest(map_values(clean_sections)) AS t FROM papers WHERE clean_sections IS NOT NULL),
p AS (SELECT *, CASE section WHEN 'results' THEN 1 WHEN 'methods' THEN 2 WHEN 'discussion' THEN 3 ELSE 4 END AS priority FROM s WHERE length(t) > 100)
SELECT text_id, md5(substr(string_agg(t, chr(10) ORDER BY priority, section), 1, 3000)) AS text_md5 FROM p GROUP BY text_id""",
)
def section_text(spark: SparkSession, sf: str) -> DataFrame:
    """Sections in order of priority, joined and capped, inside each row."""
    rank = lambda s: F.when(s == "results", 1).when(s == "methods", 2).when(s == "discussion", 3).otherwise(4)
    cells = F.transform(F.map_entries("clean_sections"), lambda e: F.struct(rank(e["key"]).alias("p"), e["key"].alias("s"), e["value"].alias("t")))
    kept = F.array_sort(F.filter(cells, lambda x: F.length(x["t"]) > 100))
    rows = table(spark, sf, "papers").where(F.col("clean_sections").isNotNull()).select("text_id", kept.alias("k")).where(F.size("k") > 0)
    return rows.select("text_id", F.md5(F.substring(F.array_join(F.transform("k", lambda x: x["t"]), "\n"), 1, 3000)).alias("text_md5"))


@query(
    "concept_news",
    """WITH q AS (SELECT vec_id AS concept, embedding AS q FROM embeddings WHERE vec_id < 8), s AS (SELECT q.concept, e.vec_id, round(list_dot_product(e.embedding::DOUBLE[], q.q::DOUBLE[]), 6) AS score FROM embeddings e, q WHERE e.vec_id >= 8)
SELECT concept, count(*) AS n, round(avg(score), 6) AS mean_score FROM (SELECT *, row_number() OVER (PARTITION BY concept ORDER BY score DESC, vec_id) AS r FROM s WHERE score >= 0.1) WHERE r <= 10 GROUP BY concept""",
)
def concept_news(spark: SparkSession, sf: str) -> DataFrame:
    """The ten best articles of each concept and their mean score."""
    rows = table(spark, sf, "embeddings")
    asked = rows.where("vec_id < 8").select(F.col("vec_id").alias("concept"), F.col("embedding").alias("q"))
    scored = rows.where("vec_id >= 8").join(F.broadcast(asked)).select("concept", "vec_id", F.round(dot(F.col("embedding"), F.col("q")), 6).alias("score")).where("score >= 0.1")
    top = top_per_group(scored, ["concept"], [F.desc("score"), F.col("vec_id")], 10)
    return top.groupBy("concept").agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean_score"))


@query(
    "sections_parsed",
    r"""SELECT text_id, nullif(trim(regexp_extract(full_text, '(?is)\nmethods\n(.*?)\nresults\n', 1)), '') IS NOT NULL AS has_methods, length(trim(regexp_extract(full_text, '(?is)\nresults\n(.*?)\ndiscussion\n', 1))) AS results_length FROM papers WHERE full_text IS NOT NULL""",
)
def sections_parsed(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of a text between known headers."""
    part = lambda a, b: F.trim(F.regexp_extract("full_text", rf"(?is)\n{a}\n(.*?)\n{b}\n", 1))
    rows = table(spark, sf, "papers").where(F.col("full_text").isNotNull())
    return rows.select("text_id", (part("methods", "results") != "").alias("has_methods"), F.length(part("results", "discussion")).alias("results_length"))


@query("kmeans_topics")
def kmeans_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Topics of the passages by k-means on counts of words, the stand-in where no topic model is installed."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import HashingTF

    rows = table(spark, sf, "evidences").where(F.trim("text") != "").select("evidence_id", F.split(F.lower("text"), r"[^a-z-]+").alias("words"))
    counted = HashingTF(inputCol="words", outputCol="features", numFeatures=256).transform(rows)
    # As many topics as thirds of the texts, two at least and five at most.
    model = KMeans(k=max(2, min(5, rows.count() // 3)), seed=42, maxIter=10).fit(counted)
    return model.transform(counted).select("evidence_id", F.col("prediction").alias("topic"))


def _merged_concepts(spark: SparkSession, sf: str) -> DataFrame:
    """(concept_id, rep): each question and the first kept one whose text is nearly the same."""
    from lexmill import providers
    from lexmill.operators.blocks import pairs_above
    from lexmill.operators.greedy import greedy_dedup

    concepts = table(spark, sf, "concepts").select("concept_id", "concept_type", providers.apply(providers.hashed_encoder(), F.col("concept_query"), "array<double>").alias("v"))
    concepts = cut(concepts)
    kept = cut(greedy_dedup(concepts, "concept_type", "concept_id", "v", 0.9)).select("concept_id", "kept")
    near = pairs_above(concepts, "concept_type", "concept_id", "v", 0.9).join(kept.where("kept").select(F.col("concept_id").alias("a")), "a")
    first = near.groupBy(F.col("b").alias("concept_id")).agg(F.min("a").alias("rep"))
    return kept.join(first, "concept_id", "left").select("concept_id", F.when(F.col("kept"), F.col("concept_id")).otherwise(F.col("rep")).alias("rep"))


@query("concept_dedup")
def concept_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Questions of a type whose texts are nearly the same are merged with the first of them: papers and words are united,
    passages are added up."""
    mapping = cut(_merged_concepts(spark, sf))
    words = F.explode(F.filter(F.split(F.lower("concept_query"), "[^a-z-]+"), lambda w: F.length(w) > 3)).alias("word")
    keywords = table(spark, sf, "concepts").join(mapping, "concept_id").select("rep", words).groupBy("rep").agg(F.array_sort(F.collect_set("word")).alias("keywords"))
    papers = table(spark, sf, "evidences").select("concept_id", "doc_id").join(mapping, "concept_id")
    counts = papers.groupBy("rep").agg(F.count_distinct("concept_id").alias("merged"), F.count_distinct("doc_id").alias("papers"), F.count("*").alias("passages"))
    return counts.join(keywords, "rep", "left")


@query("concept_edges")
def concept_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Edges of papers and questions, pointing to the questions that were kept, without those that became equal."""
    mapping = _merged_concepts(spark, sf)
    edges = table(spark, sf, "evidences").select("doc_id", "concept_id").where("doc_id IS NOT NULL").distinct()
    return edges.join(mapping, "concept_id").select("doc_id", F.col("rep").alias("concept_id")).distinct()


@query("diverse_findings")
def diverse_findings(spark: SparkSession, sf: str) -> DataFrame:
    """In order, a finding is kept if no kept one before it is nearer than the penalty allows (0.3)."""
    from lexmill.operators.greedy import greedy_dedup

    return greedy_dedup(table(spark, sf, "embeddings"), "label", "vec_id", "embedding", 0.7 + 1e-9)


@query(
    "summaries",
    r"""WITH t AS (SELECT DISTINCT text FROM documents WHERE trim(text) <> ''),
p AS (SELECT text, array_to_string(list_filter(list_transform(list_slice(regexp_extract_all(text, '[^.!?]+[.!?]*'), 1, 2), lambda x: regexp_replace(regexp_replace(x, '^[\s\x{00a0}\x{2000}-\x{200a}\x{3000}\x{0085}\x{001c}-\x{001f}]+', ''), '[\s\x{00a0}\x{2000}-\x{200a}\x{3000}\x{0085}\x{001c}-\x{001f}]+$', '')), lambda x: x <> ''), ' ') AS head FROM t)
SELECT sha256(text) AS key, CASE WHEN length(head) >= 40 THEN head ELSE '' END AS answer FROM p""",
)
def summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Each distinct text summarised once by the default provider; answers are keyed by the text's hash."""
    from lexmill import providers

    empty = spark.createDataFrame([], "key string, answer string")
    answers, _ = providers.cached(table(spark, sf, "documents"), "text", empty, providers.first_sentences(), "string")
    return answers


plans.integers({"news_focus_top": ["rank"], "sections_parsed": ["results_length"]})
