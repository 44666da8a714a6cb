"""Passages: zones, windows, lexical scores, sections and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators import greedy
from lexmill.plans.base import Plans
from lexmill.session import cut, spread, table

plans = Plans()
QUERIES, SQL, query = plans.queries, plans.sql, plans.query

#: Rhetorical zones in the order that breaks ties, and the patterns that tell them.
ZONES = ["claim", "evidence", "method", "background", "gap", "future_work", "rest"]
PATTERNS = {
    "claim": [
        r"\bwe (propose|present|introduce|demonstrate|show|prove|establish)\b",
        r"\bour (approach|method|model|framework|system|contribution)\b",
        r"\bthis (paper|work|study) (presents|proposes|introduces|demonstrates)\b",
        r"\bwe (achieve|obtain|reach|improve|outperform)\b",
        r"\bthe (main|key|primary) (contribution|finding|result) is\b",
    ],
    "evidence": [
        r"\b(results?|findings?|experiments?|evaluation)\b",
        r"\b(accuracy|f1|auc|precision|recall|sensitivity|specificity)\b",
        r"\b(table|figure|fig\.)\s*\d+\b",
        r"\b(compared to|outperforms?|surpasses?|exceeds?)\b",
        r"\b(\d+(\.\d+)?%|p\s*[<=>]\s*0\.\d+|r\s*=\s*[-]?\d+\.\d+)\b",
        r"\b(baseline|benchmark|state.of.the.art)\b",
        r"\b(we (evaluate|test|validate|measure|assess))\b",
    ],
    "method": [
        r"\b(method|methodology|approach|algorithm|architecture|model)\b",
        r"\b(we (use|employ|apply|implement|train|fine.tune|optimize))\b",
        r"\b(dataset|corpus|training|validation|testing)\b",
        r"\b(hyperparameter|parameter|configuration|setup|pipeline)\b",
        r"\b(encoder|decoder|transformer|attention|embedding|layer)\b",
        r"\b(preprocessing|tokenization|normalization|augmentation)\b",
    ],
    "background": [
        r"\b(related work|previous work|prior work|existing work)\b",
        r"\b(literature|survey|review|overview|background)\b",
        r"\b(has been (shown|proven|demonstrated|studied|investigated))\b",
        r"\b(according to|as (shown|demonstrated|reported) (in|by))\b",
        r"\b(previous|earlier|existing|traditional|conventional)\s+(work|methods?|approaches?)\b",
    ],
    "gap": [
        r"\b(however|nevertheless|nonetheless|despite|although)\b",
        r"\b(limitation|shortcoming|drawback|weakness|gap)\b",
        r"\b(still (remains|lack|need|require)|remains (an open|a challenge))\b",
        r"\b(little (is known|attention|work)|few (studies|works|attempts))\b",
        r"\b(not (well|sufficiently|adequately|fully) (understood|addressed|studied|explored))\b",
        r"\b(still (an open problem|a challenge|unresolved|unsolved))\b",
    ],
    "future_work": [
        r"\b(future work|future research|future studies|in the future)\b",
        r"\b(we (plan|intend|aim|hope|will) (to|investigate|explore|extend|improve))\b",
        r"\b(further (research|work|study|investigation|analysis) (is needed|required))\b",
        r"\b(limitation of (this|our) (work|study|paper|approach|method))\b",
        r"\b(could be (improved|extended|explored|investigated))\b",
    ],
    "rest": [r"\b(acknowledgment|funding|grant|thank|support)\b", r"\breferences?\b", r"\bappendix\b"],
}
#: The zone that a section's name suggests, the first name that occurs wins.
SECTION_ZONES = [
    ("abstract", "claim"), ("introduction", "background"), ("related work", "background"), ("background", "background"), ("methodology", "method"),
    ("methods", "method"), ("approach", "method"), ("method", "method"), ("results", "evidence"), ("findings", "evidence"), ("evaluation", "evidence"),
    ("experiments", "evidence"), ("discussion", "claim"), ("conclusion", "claim"), ("future work", "future_work"), ("limitations", "future_work"),
    ("acknowledgments", "rest"), ("funding", "rest"), ("references", "rest"), ("bibliography", "rest"),
]


def zone_scores(text: Column, section: Column) -> Column:
    """Points of each zone in tenths, in the order of `ZONES`: 3 a hit, 5 for the section, 8 and 5 by special rules."""
    low = F.lower(F.coalesce(text, F.lit("")))
    suggested = X.ladder(F.lower(F.coalesce(section, F.lit(""))), SECTION_ZONES, "rest")
    out = []
    for zone in ZONES:
        points = sum(F.regexp_count(low, F.lit(p)) for p in PATTERNS[zone]) * 3
        points = points + F.when(suggested == zone, 5).otherwise(0)
        if zone == "claim":
            points = points + F.when((suggested == "background") & low.rlike("|".join(PATTERNS["claim"])), 8).otherwise(0)
        if zone == "method":
            points = points + F.when((suggested == "evidence") & low.rlike("|".join(PATTERNS["method"])), 5).otherwise(0)
        out.append(points)
    return F.array(*out)


def zoned(df: DataFrame, key: str, text: str, section: str) -> DataFrame:
    """(key, zone, confidence): the zone with most points, the first on ties."""
    # A generator of one row keeps the optimizer from writing the long expression into every place that uses it.
    scored = spread(df.select(key, text, section)).select(key, F.explode(F.array(zone_scores(F.col(text), F.col(section)))).alias("points"))
    best = F.array_max("points")
    at = F.array_position(F.col("points"), best)
    zone = F.element_at(F.array(*[F.lit(z) for z in ZONES]), at.cast("int"))
    return scored.select(key, F.when(best > 0, zone).otherwise("rest").alias("zone"), F.least(best / 20.0, F.lit(1.0)).alias("confidence"))


def _sql_points() -> str:
    suggested = "CASE " + " ".join(f"WHEN contains(sec, '{w}') THEN '{z}'" for w, z in SECTION_ZONES) + " ELSE 'rest' END"
    parts = []
    for zone in ZONES:
        hits = " + ".join(f"len(regexp_extract_all(low, '{p}'))" for p in PATTERNS[zone])
        extra = f"CASE WHEN suggested = '{zone}' THEN 5 ELSE 0 END"
        if zone == "claim":
            extra += f" + CASE WHEN suggested = 'background' AND regexp_matches(low, '{'|'.join(PATTERNS['claim'])}') THEN 8 ELSE 0 END"
        if zone == "method":
            extra += f" + CASE WHEN suggested = 'evidence' AND regexp_matches(low, '{'|'.join(PATTERNS['method'])}') THEN 5 ELSE 0 END"
        parts.append(f"3 * ({hits}) + {extra}")
    return f"""base AS (SELECT doc_id, lower(coalesce(text, '')) AS low, lower(coalesce(section, '')) AS sec FROM documents),
sug AS (SELECT *, {suggested} AS suggested FROM base), pts AS (SELECT doc_id, [{', '.join(parts)}] AS p FROM sug),
zones AS (SELECT doc_id, CASE WHEN list_max(p) > 0 THEN {ZONES}[list_position(p, list_max(p))] ELSE 'rest' END AS zone, least(list_max(p) / 20.0, 1.0)::DOUBLE AS confidence FROM pts)"""


@query("zone_classify", f"WITH {_sql_points()} SELECT doc_id, zone, confidence FROM zones")
def zone_classify(spark: SparkSession, sf: str) -> DataFrame:
    return zoned(table(spark, sf, "documents"), "doc_id", "text", "section")


@query("zone_distribution", f"WITH {_sql_points()} SELECT zone, count(*) AS n, round(avg(confidence), 9) AS confidence FROM zones GROUP BY zone")
def zone_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return zone_classify(spark, sf).groupBy("zone").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 9).alias("confidence"))


@query("zone_selection", f"WITH {_sql_points()} SELECT doc_id, zone FROM zones WHERE zone IN ('claim', 'evidence') AND confidence > 0.3")
def zone_selection(spark: SparkSession, sf: str) -> DataFrame:
    return zone_classify(spark, sf).where(F.col("zone").isin("claim", "evidence") & (F.col("confidence") > 0.3)).select("doc_id", "zone")


@query(
    "claim_evidence_nearest",
    f"""WITH {_sql_points()}, placed AS (SELECT d.paper_id, d.doc_id, z.zone FROM documents d JOIN zones z USING (doc_id) WHERE d.paper_id IS NOT NULL AND z.zone IN ('claim', 'evidence')),
near AS (SELECT *, max(doc_id) FILTER (WHERE zone = 'evidence') OVER (PARTITION BY paper_id ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before,
  min(doc_id) FILTER (WHERE zone = 'evidence') OVER (PARTITION BY paper_id ORDER BY doc_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after FROM placed)
SELECT doc_id AS claim, CASE WHEN before IS NULL THEN after WHEN after IS NULL THEN before WHEN after - doc_id < doc_id - before THEN after ELSE before END AS evidence
FROM near WHERE zone = 'claim' AND (before IS NOT NULL OR after IS NOT NULL)""",
)
def claim_evidence_nearest(spark: SparkSession, sf: str) -> DataFrame:
    """Each claim with the nearest evidence of its paper; windows instead of all pairs."""
    docs = table(spark, sf, "documents").where(F.col("paper_id").isNotNull()).select("doc_id", "paper_id")
    rows = docs.join(zone_classify(spark, sf), "doc_id").where(F.col("zone").isin("claim", "evidence"))
    at = F.when(F.col("zone") == "evidence", F.col("doc_id"))
    order = Window.partitionBy("paper_id").orderBy("doc_id")
    near = rows.withColumn("before", F.max(at).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "after", F.min(at).over(order.rowsBetween(0, Window.unboundedFollowing))
    )
    best = (
        F.when(F.col("before").isNull(), F.col("after")).when(F.col("after").isNull(), F.col("before"))
        .when(F.col("after") - F.col("doc_id") < F.col("doc_id") - F.col("before"), F.col("after")).otherwise(F.col("before"))
    )
    return near.where((F.col("zone") == "claim") & F.coalesce("before", "after").isNotNull()).select(F.col("doc_id").alias("claim"), best.alias("evidence"))


@query(
    "paragraphs",
    """WITH p AS (SELECT doc_id, unnest(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: length(x) > 30)) AS t,
  generate_subscripts(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: length(x) > 30), 1) AS i FROM documents)
SELECT doc_id, (i - 1)::INT AS idx, length(t) AS n, coalesce(sum(length(t) + 2) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS char_start FROM p""",
)
def paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs (here lines) of more than 30 characters with running offsets, computed inside each row."""
    kept = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: F.length(x) > 30)
    rows = table(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", kept.alias("ps"))
    starts = F.aggregate(
        "ps", F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("starts")),
        lambda s, p: F.struct((s["at"] + F.length(p) + 2).alias("at"), F.array_append(s["starts"], s["at"]).alias("starts")),
    )["starts"]
    cells = F.arrays_zip(F.transform("ps", lambda p: F.length(p)).alias("n"), starts.alias("char_start"))
    return rows.select("doc_id", F.posexplode(cells).alias("idx", "c")).select("doc_id", "idx", F.col("c.n").alias("n"), F.col("c.char_start").alias("char_start"))


_SENTENCES = "list_filter(list_transform(regexp_extract_all({t}, '[^.!?]+[.!?]*'), lambda x: trim(x)), lambda x: x <> '')"


@query("sentences", f"SELECT doc_id, len({_SENTENCES.format(t='text')}) AS n, md5(array_to_string({_SENTENCES.format(t='text')}, '|')) AS sentences_md5 FROM documents WHERE text IS NOT NULL")
def sentences(spark: SparkSession, sf: str) -> DataFrame:
    parts = _sentences(F.col("text"))
    return table(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", F.size(parts).alias("n"), F.md5(F.array_join(parts, "|")).alias("sentences_md5"))


def _sentences(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(r"([^.!?]+[.!?]*)"), 1)
    return F.filter(F.transform(found, lambda x: F.trim(x)), lambda x: x != "")


@query(
    "passage_windows",
    f"""WITH s AS (SELECT evidence_id, {_SENTENCES.format(t='text')} AS s FROM (SELECT doc_id AS evidence_id, text FROM documents WHERE text IS NOT NULL)),
w AS (SELECT evidence_id, CASE WHEN len(s) = 0 THEN [] WHEN len(s) < 5 THEN [array_to_string(s, ' ')]
  ELSE list_transform(generate_series(1, len(s) - 4, 2), lambda i: array_to_string(list_slice(s, i, i + 4), ' ')) END AS ws, array_to_string(list_slice(s, len(s) - 4, len(s)), ' ') AS last, len(s) AS n FROM s),
f AS (SELECT evidence_id, CASE WHEN n >= 5 AND NOT list_contains(ws, last) THEN list_append(ws, last) ELSE ws END AS ws FROM w)
SELECT evidence_id AS doc_id, (generate_subscripts(ws, 1) - 1)::INT AS idx, md5(unnest(ws)) AS window_md5 FROM f WHERE len(ws) > 0""",
)
def passage_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of five sentences in steps of two, and the last five if no window is equal to them."""
    rows = table(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", _sentences(F.col("text")).alias("s"))
    n = F.size("s")
    windows = F.transform(F.sequence(F.lit(1), F.greatest(n - 4, F.lit(1)), F.lit(2)), lambda i: F.array_join(F.slice(F.col("s"), i, 5), " "))
    last = F.array_join(F.slice("s", F.greatest(n - 4, F.lit(1)), 5), " ")
    some = F.when(n == 0, F.array().cast("array<string>")).when(n < 5, F.array(F.array_join("s", " "))).otherwise(windows)
    every = F.when((n >= 5) & ~F.array_contains(windows, last), F.array_append(some, last)).otherwise(some)
    return rows.select("doc_id", F.posexplode(every).alias("idx", "w")).select("doc_id", "idx", F.md5("w").alias("window_md5"))


_BM25 = """
docs AS (SELECT evidence_id, concept_id, string_split_regex(trim(lower(text)), '\\s+') AS toks FROM evidences WHERE trim(text) <> ''),
stats AS (SELECT concept_id, count(*) AS n, avg(len(toks)) AS avgdl FROM docs GROUP BY concept_id),
tf AS (SELECT concept_id, evidence_id, len(any_value(toks)) AS dl, t, count(*) AS tf FROM (SELECT concept_id, evidence_id, toks, unnest(toks) AS t FROM docs) GROUP BY concept_id, evidence_id, t),
df AS (SELECT concept_id, t, count(*) AS df FROM tf GROUP BY ALL),
raw AS (SELECT d.concept_id, d.t, ln(s.n - d.df + 0.5) - ln(d.df + 0.5) AS idf FROM df d JOIN stats s USING (concept_id)),
mean AS (SELECT concept_id, avg(idf) AS m FROM raw GROUP BY concept_id),
idf AS (SELECT r.concept_id, r.t, CASE WHEN r.idf < 0 THEN 0.25 * m.m ELSE r.idf END AS idf FROM raw r JOIN mean m USING (concept_id)),
q AS (SELECT concept_id, unnest(string_split_regex(trim(lower(concept_query)), '\\s+')) AS t FROM concepts),
sc AS (SELECT tf.concept_id, tf.evidence_id, sum(i.idf * tf.tf * 2.5 / (tf.tf + 1.5 * (0.25 + 0.75 * tf.dl / s.avgdl))) AS score
  FROM q JOIN tf ON q.concept_id = tf.concept_id AND q.t = tf.t JOIN idf i ON i.concept_id = tf.concept_id AND i.t = tf.t JOIN stats s ON s.concept_id = tf.concept_id GROUP BY ALL),
every AS (SELECT d.concept_id, d.evidence_id, coalesce(sc.score, 0.0) AS score FROM docs d LEFT JOIN sc USING (concept_id, evidence_id))"""


def _bm25(spark: SparkSession, sf: str) -> DataFrame:
    """Okapi BM25 of every passage of a concept against the concept's question (k1 1.5, b 0.75, epsilon 0.25)."""
    words = lambda c: F.split(F.trim(F.lower(c)), r"\s+")
    docs = table(spark, sf, "evidences").where(F.trim("text") != "").select("evidence_id", "concept_id", words("text").alias("toks"))
    # Document frequencies of all words are needed for the mean idf; of the passages only the question's words are counted.
    stats = docs.groupBy("concept_id").agg(F.count("*").alias("n"), F.avg(F.size("toks")).alias("avgdl"))
    df = docs.select("concept_id", F.explode(F.array_distinct("toks")).alias("t")).groupBy("concept_id", "t").agg(F.count("*").alias("df"))
    raw = df.join(stats, "concept_id").withColumn("raw", F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    raw = cut(raw)
    mean = raw.groupBy("concept_id").agg(F.avg("raw").alias("m"))
    asked = table(spark, sf, "concepts").select("concept_id", F.explode(words("concept_query")).alias("t"))
    idf = asked.join(raw, ["concept_id", "t"]).join(mean, "concept_id")
    idf = idf.select("concept_id", "t", "avgdl", F.when(F.col("raw") < 0, 0.25 * F.col("m")).otherwise(F.col("raw")).alias("idf"))
    terms = idf.groupBy("concept_id").agg(F.first("avgdl").alias("avgdl"), F.sort_array(F.collect_list(F.struct("t", "idf"))).alias("terms"))

    def part(x: Column) -> Column:
        tf = F.size(F.filter("toks", lambda t: t == x["t"]))
        return x["idf"] * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * F.size("toks") / F.col("avgdl")))

    score = F.aggregate("terms", F.lit(0.0), lambda total, x: total + part(x))
    return docs.join(terms, "concept_id", "left").select("concept_id", "evidence_id", F.coalesce(score, F.lit(0.0)).alias("score"))


@query("bm25_scores", f"WITH {_BM25} SELECT concept_id, evidence_id, round(score, 5) AS score FROM every")
def bm25_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _bm25(spark, sf).select("concept_id", "evidence_id", F.round("score", 5).alias("score"))


@query(
    "hybrid_scores",
    f"""WITH {_BM25}, b AS (SELECT concept_id, min(score) AS lo, max(score) AS hi FROM every GROUP BY concept_id),
h AS (SELECT e.evidence_id, v.text, 0.7 * v.similarity + 0.3 * CASE WHEN b.hi - b.lo > 1e-8 THEN (e.score - b.lo) / (b.hi - b.lo) ELSE 0.0 END AS hybrid
  FROM every e JOIN b USING (concept_id) JOIN evidences v USING (evidence_id) WHERE v.similarity BETWEEN 0 AND 1)
SELECT evidence_id, round(hybrid + least(0.05 * least({X.sql_hits('text', X.CLAIM_STEMS)}, 3), 0.25 * hybrid), 9) AS score FROM h""",
)
def hybrid_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Similarity and normalised BM25, raised a little by words of claims, by a quarter at most."""
    scored = cut(_bm25(spark, sf))
    bounds = scored.groupBy("concept_id").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    texts = table(spark, sf, "evidences").where(F.col("similarity").between(0.0, 1.0)).select("evidence_id", "text", "similarity")
    rows = scored.join(bounds, "concept_id").join(texts, "evidence_id")
    wide = F.col("hi") - F.col("lo")
    hybrid = 0.7 * F.col("similarity") + 0.3 * F.when(wide > 1e-8, (F.col("score") - F.col("lo")) / wide).otherwise(0.0)
    boost = 0.05 * F.least(X.hits(F.col("text"), X.CLAIM_STEMS), F.lit(3))
    return rows.withColumn("h", hybrid).select("evidence_id", F.round(F.col("h") + F.least(boost, 0.25 * F.col("h")), 9).alias("score"))


@query(
    "tfidf_top_terms",
    """WITH docs AS (SELECT concept_id, evidence_id, unnest(list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda x: length(x) > 3)) AS t FROM evidences WHERE text IS NOT NULL),
tf AS (SELECT concept_id, evidence_id, t, count(*) AS tf FROM docs GROUP BY ALL), n AS (SELECT concept_id, count(DISTINCT evidence_id) AS n FROM tf GROUP BY concept_id),
df AS (SELECT concept_id, t, count(*) AS df FROM tf GROUP BY ALL),
w AS (SELECT tf.concept_id, evidence_id, tf.t, tf * (ln((1.0 + n.n) / (1.0 + df.df)) + 1) AS w FROM tf JOIN df USING (concept_id, t) JOIN n USING (concept_id)),
u AS (SELECT concept_id, t, w / sqrt(sum(w * w) OVER (PARTITION BY concept_id, evidence_id)) AS u FROM w),
m AS (SELECT u.concept_id, u.t, round(sum(u.u) / any_value(n.n), 6) AS weight FROM u JOIN n USING (concept_id) GROUP BY u.concept_id, u.t)
SELECT concept_id, t AS term, weight, row_number() OVER (PARTITION BY concept_id ORDER BY weight DESC, t) AS rank FROM m QUALIFY rank <= 5""",
)
def tfidf_top_terms(spark: SparkSession, sf: str) -> DataFrame:
    """The five terms of each concept with the greatest mean of normalised tf-idf weights."""
    from lexmill.operators.ranking import top_per_group

    words = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda x: F.length(x) > 3)
    docs = table(spark, sf, "evidences").where(F.col("text").isNotNull()).select("concept_id", "evidence_id", F.explode(words).alias("t"))
    tf = cut(docs.groupBy("concept_id", "evidence_id", "t").agg(F.count("*").alias("tf")))
    n = tf.groupBy("concept_id").agg(F.count_distinct("evidence_id").alias("n"))
    df = tf.groupBy("concept_id", "t").agg(F.count("*").alias("df"))
    weight = F.col("tf") * (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1)
    rows = tf.join(df, ["concept_id", "t"]).join(n, "concept_id").withColumn("w", weight)
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("concept_id", "evidence_id")))
    means = rows.withColumn("u", F.col("w") / length).groupBy("concept_id", "t").agg(F.round(F.sum("u") / F.first("n"), 6).alias("weight"))
    top = top_per_group(means, ["concept_id"], [F.desc("weight"), F.col("t")], 5)
    return top.select("concept_id", F.col("t").alias("term"), "weight", "rank")


@query(
    "lexical_filter",
    """WITH q AS (SELECT concept_id, list_filter(string_split_regex(lower(concept_query), '[^a-z-]+'), lambda x: length(x) > 3) AS l,
list_slice(list_filter(l, lambda x, i: list_position(l, x) = i), 1, 15) AS terms FROM concepts),
h AS (SELECT p.text_id, q.concept_id, len(list_filter(q.terms, lambda t: contains(lower(coalesce(p.title, '') || ' ' || coalesce(p.full_text, '')), t))) AS hits FROM papers p, q)
SELECT text_id, concept_id, hits FROM h WHERE hits >= 2""",
)
def lexical_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Papers in which at least two of a question's first fifteen terms occur; the fixed table of questions is broadcast."""
    terms = F.slice(F.array_distinct(F.filter(F.split(F.lower("concept_query"), "[^a-z-]+"), lambda x: F.length(x) > 3)), 1, 15)
    asked = table(spark, sf, "concepts").select("concept_id", terms.alias("terms"))
    low = F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("full_text", F.lit(""))))
    papers = table(spark, sf, "papers").select("text_id", low.alias("low"))
    hits = F.size(F.filter("terms", lambda t: F.contains(F.col("low"), t)))
    return papers.join(F.broadcast(asked)).select("text_id", "concept_id", hits.alias("hits")).where("hits >= 2")


_SECTION_WORDS = ["introduction", "methods", "results", "discussion", "conclusion", "references"]


@query(
    "section_split",
    "WITH l AS (SELECT text_id, lower(full_text) AS low, length(full_text) AS n FROM papers WHERE full_text IS NOT NULL), p AS ("
    + " UNION ALL ".join(f"SELECT text_id, '{w}' AS section, strpos(low, '{w}') AS place, n FROM l" for w in _SECTION_WORDS)
    + ") SELECT text_id, section, place::INT AS start, (coalesce(lead(place) OVER (PARTITION BY text_id ORDER BY place), n + 1) - place)::INT AS length FROM p WHERE place > 0",
)
def section_split(spark: SparkSession, sf: str) -> DataFrame:
    """Sections from the first occurrence of each heading word to that of the next one, in order of position."""
    low = F.lower("full_text")
    places = F.array(*[F.struct(F.instr(low, w).alias("at"), F.lit(w).alias("section")) for w in _SECTION_WORDS])
    found = F.array_sort(F.filter(places, lambda x: x["at"] > 0))
    rows = table(spark, sf, "papers").where(F.col("full_text").isNotNull()).select("text_id", F.length("full_text").alias("n"), found.alias("f"))
    after = F.when(F.col("i") + 1 < F.size("f"), F.get(F.col("f"), F.col("i") + 1)["at"]).otherwise(F.col("n") + 1)
    flat = rows.select("text_id", "n", "f", F.posexplode("f").alias("i", "x"))
    return flat.select("text_id", F.col("x.section").alias("section"), F.col("x.at").alias("start"), (after - F.col("x.at")).alias("length"))


_CLEAN = [
    (r"http\S+|www\.\S+", " "), (r"\S+@\S+", " "), (r"(\w+)-[ \t]*\n[ \t]*(\w+)", r"\1\2"), (r"\r", r"\n"), (r"©[^\n]*", " "),
    (r"(?i)all rights reserved[^\n]*", " "), (r"[ \t]+([.,;:!?])", r"\1"),
]


@query(
    "corpus_cleaning",
    "SELECT text_id, length(t) AS n, md5(t) AS text_md5 FROM (SELECT text_id, trim(regexp_replace(array_to_string(list_filter(list_transform(string_split("
    + "".join("regexp_replace(" for _ in _CLEAN) + "full_text" + "".join(f", '{p}', " + ("chr(10)" if r == r"\n" else f"'{r}'") + ", 'g')" for p, r in _CLEAN)
    + ", chr(10)), lambda x: trim(x)), lambda x: length(x) >= 2 AND NOT regexp_matches(x, '^[0-9]+$')), ' '), '\\s+', ' ', 'g')) AS t FROM papers WHERE full_text IS NOT NULL)",
)
def corpus_cleaning(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses, rights, broken words and lone page numbers removed; hyphens join only across line ends."""
    text = F.col("full_text")
    for pattern, with_ in _CLEAN:
        text = F.regexp_replace(text, pattern, with_.replace("\\1", "$1").replace("\\2", "$2").replace("\\n", "\n"))
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: (F.length(x) >= 2) & ~x.rlike("^[0-9]+$"))
    clean = F.trim(F.regexp_replace(F.array_join(lines, " "), r"\s+", " "))
    rows = table(spark, sf, "papers").where(F.col("full_text").isNotNull())
    return rows.select("text_id", F.length(clean).alias("n"), F.md5(clean).alias("text_md5"))


@query(
    "term_ngrams",
    """WITH w AS (SELECT concept_id, list_filter(string_split_regex(lower(concept_query), '[^a-z-]+'), lambda x: x <> '') AS w FROM concepts),
g AS (SELECT concept_id, k, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS term FROM w, (VALUES (1), (2), (3)) v(k) WHERE len(w) >= k)
SELECT concept_id, k::INT AS size, term, count(*) AS n FROM g GROUP BY ALL""",
)
def term_ngrams(spark: SparkSession, sf: str) -> DataFrame:
    """Terms of one to three words of every question."""
    words = F.filter(F.split(F.lower("concept_query"), "[^a-z-]+"), lambda x: x != "")
    rows = table(spark, sf, "concepts").select("concept_id", words.alias("w"), F.explode(F.array(*[F.lit(k) for k in (1, 2, 3)])).alias("size")).where(F.size("w") >= F.col("size"))
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1), lambda i: F.array_join(F.slice(F.col("w"), i, F.col("size")), " "))
    return rows.select("concept_id", "size", F.explode(grams).alias("term")).groupBy("concept_id", "size", "term").agg(F.count("*").alias("n"))


@query(
    "chunk_builder",
    """WITH s AS (SELECT text_id, unnest(map_keys(clean_sections)) AS section, unnest(map_values(clean_sections)) AS t FROM papers WHERE clean_sections IS NOT NULL),
c AS (SELECT 'text' AS kind, text_id::VARCHAR AS owner, full_text AS t FROM papers WHERE length(full_text) > 100 UNION ALL SELECT 'section', text_id || ':' || section, t FROM s WHERE length(t) > 100
UNION ALL SELECT 'evidence', evidence_id::VARCHAR, text FROM evidences WHERE length(text) > 50)
SELECT kind, owner, substr(sha256(substr(t, 1, 1200)), 1, 12) AS chunk_id, least(length(t), 1200) AS n FROM c""",
)
def chunk_builder(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of texts, sections and evidences, capped in length and named by their content."""
    papers = table(spark, sf, "papers")
    texts = papers.where(F.length("full_text") > 100).select(F.lit("text").alias("kind"), F.col("text_id").cast("string").alias("owner"), F.col("full_text").alias("t"))
    sections = papers.select("text_id", F.explode("clean_sections").alias("section", "t")).where(F.length("t") > 100)
    sections = sections.select(F.lit("section").alias("kind"), F.concat_ws(":", F.col("text_id").cast("string"), "section").alias("owner"), "t")
    passages = table(spark, sf, "evidences").where(F.length("text") > 50).select(F.lit("evidence").alias("kind"), F.col("evidence_id").cast("string").alias("owner"), F.col("text").alias("t"))
    head = F.substring("t", 1, 1200)
    return texts.unionByName(sections).unionByName(passages).select("kind", "owner", F.substring(F.sha2(head, 256), 1, 12).alias("chunk_id"), F.least(F.length("t"), F.lit(1200)).alias("n"))


@query(
    "metric_extraction",
    r"""WITH m AS (SELECT doc_id, regexp_extract(lower(text), '(accuracy|kappa|age)[a-z ]*(?:of|=)? ?([0-9]+(?:\.[0-9]+)?)', 1) AS metric, regexp_extract(lower(text), '(accuracy|kappa|age)[a-z ]*(?:of|=)? ?([0-9]+(?:\.[0-9]+)?)', 2) AS value FROM documents)
SELECT doc_id, metric, value FROM m WHERE metric <> ''""",
)
def metric_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """The first figure that a document gives for one of the known metrics."""
    pattern = r"(accuracy|kappa|age)[a-z ]*(?:of|=)? ?([0-9]+(?:\.[0-9]+)?)"
    rows = table(spark, sf, "documents").where(F.col("text").isNotNull())
    return rows.select("doc_id", F.regexp_extract(F.lower("text"), pattern, 1).alias("metric"), F.regexp_extract(F.lower("text"), pattern, 2).alias("value")).where("metric <> ''")


@query(
    "limitation_sentences",
    f"""SELECT doc_id, md5(array_to_string(list_slice(list_filter({_SENTENCES.format(t='text')}, lambda x: regexp_matches(lower(x), 'limitation|however|unclear')), 1, 2), '|')) AS picked_md5
FROM documents WHERE len(list_filter({_SENTENCES.format(t='text')}, lambda x: regexp_matches(lower(x), 'limitation|however|unclear'))) > 0""",
)
def limitation_sentences(spark: SparkSession, sf: str) -> DataFrame:
    picked = F.filter(_sentences(F.col("text")), lambda x: F.lower(x).rlike("limitation|however|unclear"))
    rows = table(spark, sf, "documents").select("doc_id", picked.alias("p")).where(F.size("p") > 0)
    return rows.select("doc_id", F.md5(F.array_join(F.slice("p", 1, 2), "|")).alias("picked_md5"))


@query(
    "greedy_notebooks",
    """WITH RECURSIVE o AS (SELECT text_id, coalesce(word_count, 0) AS w, row_number() OVER (ORDER BY coalesce(word_count, 0) DESC, text_id) AS p FROM papers),
r AS (SELECT p, text_id, 0::BIGINT AS container, 1 AS held, w AS total FROM o WHERE p = 1
  UNION ALL SELECT o.p, o.text_id, r.container + CASE WHEN r.held >= 20 OR r.total + o.w > 12000 THEN 1 ELSE 0 END,
    CASE WHEN r.held >= 20 OR r.total + o.w > 12000 THEN 1 ELSE r.held + 1 END, CASE WHEN r.held >= 20 OR r.total + o.w > 12000 THEN o.w ELSE r.total + o.w END
  FROM r JOIN o ON o.p = r.p + 1)
SELECT text_id, p AS place, container FROM r""",
)
def greedy_notebooks(spark: SparkSession, sf: str) -> DataFrame:
    """Papers in order of score packed into notebooks with limits of count and words; the running total resets."""
    rows = table(spark, sf, "papers").select("text_id", F.coalesce("word_count", F.lit(0)).alias("words"))
    return greedy.pack_in_order(rows, "text_id", "words", [F.desc("words"), F.col("text_id")], 20, 12_000)


@query("semantic_dedup")
def semantic_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of each label kept greedily: one is dropped if an earlier kept one is too similar."""
    return greedy.greedy_dedup(table(spark, sf, "embeddings"), "label", "vec_id", "embedding", 0.5)


@query("agglomerative_clusters")
def agglomerative_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Average-linkage clusters of each label's vectors by a distance threshold that depends on their number."""
    return greedy.average_linkage(table(spark, sf, "embeddings"), "label", "vec_id", "embedding")


plans.integers({"paragraphs": ["n"], "sentences": ["n"], "tfidf_top_terms": ["rank"], "lexical_filter": ["hits"], "corpus_cleaning": ["n"], "chunk_builder": ["n"]})
