"""Vector ranking, quotas, percentiles, alignment and evidence selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions.vectors import dot
from lexmill.operators import ranking as R
from lexmill.plans.base import Plans
from lexmill.session import cut, table

plans = Plans()
QUERIES, SQL, query = plans.queries, plans.sql, plans.query

_DOT = "list_dot_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[])"
_SCORED = f"scored AS (SELECT e.vec_id, e.label, round({_DOT}, 6) AS score FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q WHERE e.vec_id <> 0)"


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector's similarity to the query vector, which is one row and is broadcast."""
    rows = table(spark, sf, "embeddings")
    asked = rows.where("vec_id = 0").select(F.col("embedding").alias("q"))
    others = rows.where("vec_id <> 0")
    return others.join(F.broadcast(asked)).select("vec_id", "label", F.round(dot(F.col("embedding"), F.col("q")), 6).alias("score"))


@query("rank_threshold", f"WITH {_SCORED} SELECT vec_id, score, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM scored WHERE score >= 0.1 ORDER BY score DESC, vec_id LIMIT 50")
def rank_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """The 50 most similar vectors above a threshold: a top-k report, cut before it is ranked."""
    top = _scored(spark, sf).where("score >= 0.1").select("vec_id", "score").orderBy(F.desc("score"), "vec_id").limit(50)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "vec_id")))


_STREAMS = f"""{_SCORED}, tagged AS (SELECT vec_id, score, (label % 5)::INT AS stream FROM scored WHERE score >= -0.1
  UNION ALL SELECT vec_id, score, 5 + (vec_id % 3)::INT FROM scored WHERE score >= -0.1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY score DESC, vec_id) AS place FROM tagged),
selected AS (SELECT vec_id, min(stream) AS stream, arg_min(place, stream) AS place, arg_min(score, stream) AS score FROM ranked WHERE place <= 20 GROUP BY vec_id)"""


def _streams(spark: SparkSession, sf: str) -> DataFrame:
    rows = _scored(spark, sf).where("score >= -0.1")
    streams = F.array((F.col("label") % 5).cast("int"), (5 + F.col("vec_id") % 3).cast("int"))
    return rows.select("vec_id", "score", F.explode(streams).alias("stream"))


@query("rank_stream_quota", f"WITH {_STREAMS} SELECT vec_id, stream, place, score FROM selected")
def rank_stream_quota(spark: SparkSession, sf: str) -> DataFrame:
    return R.stream_quota(_streams(spark, sf), "stream", "vec_id", "score", 20)[0]


@query(
    "rank_overflow",
    f"WITH {_STREAMS} SELECT r.vec_id, r.stream, r.place, r.score FROM ranked r LEFT JOIN selected s ON r.vec_id = s.vec_id "
    "WHERE r.place > 20 AND (s.stream IS NULL OR s.stream > r.stream)",
)
def rank_overflow(spark: SparkSession, sf: str) -> DataFrame:
    return R.stream_quota(_streams(spark, sf), "stream", "vec_id", "score", 20)[1].select("vec_id", "stream", "place", "score")


@query(
    "selection_funnel",
    f"""WITH {_STREAMS} SELECT (SELECT count(*) FROM scored) AS n_ranked, (SELECT count(DISTINCT vec_id) FROM ranked) AS above_threshold,
(SELECT count(*) FROM selected) AS selected, (SELECT count(DISTINCT vec_id) FROM ranked) - (SELECT count(*) FROM selected) AS left_out""",
)
def selection_funnel(spark: SparkSession, sf: str) -> DataFrame:
    scored, streams = _scored(spark, sf), cut(_streams(spark, sf))
    selected = R.stream_quota(streams, "stream", "vec_id", "score", 20)[0]
    n = scored.agg(F.count("*").alias("n_ranked"))
    above = streams.agg(F.count_distinct("vec_id").alias("above_threshold"))
    taken = selected.agg(F.count("*").alias("selected"))
    return n.join(above).join(taken).withColumn("left_out", F.col("above_threshold") - F.col("selected"))


_OBJ = "objectives AS (SELECT vec_id AS objective, embedding FROM embeddings WHERE vec_id < 8), topics AS (SELECT vec_id AS topic, embedding FROM embeddings WHERE vec_id >= 8)"
_ALIGNED = f"{_OBJ}, aligned AS (SELECT t.topic, o.objective, round(list_dot_product(t.embedding::DOUBLE[], o.embedding::DOUBLE[]), 6) AS score FROM topics t, objectives o)"


def _aligned(spark: SparkSession, sf: str) -> DataFrame:
    """Every topic against the objectives, of which there are eight; they are broadcast."""
    rows = table(spark, sf, "embeddings")
    objectives = rows.where("vec_id < 8").select(F.col("vec_id").alias("objective"), F.col("embedding").alias("o"))
    topics = rows.where("vec_id >= 8").select(F.col("vec_id").alias("topic"), F.col("embedding").alias("t"))
    return topics.join(F.broadcast(objectives)).select("topic", "objective", F.round(dot(F.col("t"), F.col("o")), 6).alias("score"))


@query(
    "top_objectives",
    f"WITH {_ALIGNED} SELECT topic, objective, score, row_number() OVER (PARTITION BY topic ORDER BY score DESC, objective DESC) AS rank FROM aligned QUALIFY rank <= 3",
)
def top_objectives(spark: SparkSession, sf: str) -> DataFrame:
    return R.top_per_group(_aligned(spark, sf), ["topic"], [F.desc("score"), F.desc("objective")], 3)


@query("best_objective", f"WITH {_ALIGNED} SELECT topic, arg_max(objective, (score, -objective)) AS objective, max(score) AS score FROM aligned GROUP BY topic HAVING max(score) >= 0.1")
def best_objective(spark: SparkSession, sf: str) -> DataFrame:
    best = _aligned(spark, sf).groupBy("topic").agg(
        F.max_by("objective", F.struct("score", -F.col("objective"))).alias("objective"), F.max("score").alias("score")
    )
    return best.where("score >= 0.1")


@query(
    "rerank_combined",
    f"""WITH {_ALIGNED}, cuts AS (SELECT objective, quantile_cont(score, 0.6) AS cut FROM aligned GROUP BY objective),
kept AS (SELECT a.*, row_number() OVER (PARTITION BY a.objective ORDER BY a.score DESC, topic) AS place, cut FROM aligned a JOIN cuts USING (objective))
SELECT objective, topic, round(0.3 * score + 0.7 * score * score, 6) AS combined FROM kept WHERE score >= cut OR place <= 5""",
)
def rerank_combined(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of each objective above a percentile, but at least five, by a combined score."""
    rows = cut(_aligned(spark, sf))
    cuts = rows.groupBy("objective").agg(F.percentile("score", F.lit(0.6)).alias("cut"))
    above = rows.join(cuts, "objective").where(F.col("score") >= F.col("cut")).select("objective", "topic", "score")
    least = R.top_per_group(rows, ["objective"], [F.desc("score"), F.col("topic")], 5).select("objective", "topic", "score")
    combined = F.round(0.3 * F.col("score") + 0.7 * F.col("score") * F.col("score"), 6)
    return above.unionByName(least).distinct().select("objective", "topic", combined.alias("combined"))


@query(
    "dynamic_selection",
    f"""WITH {_ALIGNED}, placed AS (SELECT *, row_number() OVER (PARTITION BY objective ORDER BY score DESC, topic) AS place,
  count(*) FILTER (WHERE score >= 0.2) OVER (PARTITION BY objective) AS good FROM aligned)
SELECT objective, topic, score FROM placed WHERE place <= 60 AND (score >= 0.2 OR (good < 5 AND place <= 5))""",
)
def dynamic_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of sufficient score, or the first five where there are fewer; at most sixty."""
    rows = cut(_aligned(spark, sf))
    good = rows.groupBy("objective").agg(F.count_if(F.col("score") >= 0.2).alias("good"))
    top = R.top_per_group(rows, ["objective"], [F.desc("score"), F.col("topic")], 60, "place").join(good, "objective")
    return top.where((F.col("score") >= 0.2) | ((F.col("good") < 5) & (F.col("place") <= 5))).select("objective", "topic", "score")


_SIM = "clean AS (SELECT evidence_id, concept_id, doc_id, text, similarity FROM evidences WHERE similarity BETWEEN 0 AND 1 AND trim(text) <> '')"


def _evidence(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "evidences").where(F.col("similarity").between(0.0, 1.0) & (F.trim("text") != ""))


@query(
    "evidence_selection",
    f"""WITH {_SIM}, cuts AS (SELECT concept_id, quantile_cont(similarity, 0.3) AS cut FROM clean WHERE similarity >= 0.3 GROUP BY concept_id),
kept AS (SELECT c.* FROM clean c JOIN cuts USING (concept_id) WHERE similarity >= 0.3 AND similarity >= cut),
best AS (SELECT concept_id, doc_id, arg_max(evidence_id, (similarity, -evidence_id)) AS evidence_id, max(similarity) AS similarity FROM clean GROUP BY ALL HAVING max(similarity) >= 0.5),
lost AS (SELECT b.* FROM best b ANTI JOIN kept k ON b.concept_id = k.concept_id AND b.doc_id = k.doc_id),
rows AS (SELECT concept_id, doc_id, evidence_id, similarity, false AS rescued FROM kept UNION ALL SELECT concept_id, doc_id, evidence_id, similarity, true FROM lost)
SELECT concept_id, doc_id, evidence_id, similarity, rescued, row_number() OVER (PARTITION BY concept_id ORDER BY similarity DESC, evidence_id) AS rank FROM rows QUALIFY rank <= 80""",
)
def evidence_selection(spark: SparkSession, sf: str) -> DataFrame:
    rows = _evidence(spark, sf).select("concept_id", "doc_id", "evidence_id", "similarity")
    return R.evidence_chain(rows, "concept_id", "doc_id", "evidence_id", "similarity", 0.3, 0.3, 0.5, 80)


@query(
    "best_evidence_per_paper",
    f"WITH {_SIM} SELECT concept_id, doc_id, arg_max(evidence_id, (similarity, -evidence_id)) AS evidence_id, max(similarity) AS similarity FROM clean GROUP BY ALL",
)
def best_evidence_per_paper(spark: SparkSession, sf: str) -> DataFrame:
    return _evidence(spark, sf).groupBy("concept_id", "doc_id").agg(
        F.max_by("evidence_id", F.struct("similarity", -F.col("evidence_id"))).alias("evidence_id"), F.max("similarity").alias("similarity")
    )


@query(
    "evidence_text_dedup",
    f"WITH {_SIM} SELECT doc_id, md5(text) AS text_md5, max(similarity) AS similarity, arg_max(evidence_id, (similarity, -evidence_id)) AS evidence_id FROM clean GROUP BY doc_id, text",
)
def evidence_text_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Each text of a document once, with its greatest similarity; only digests of the texts are shuffled."""
    return _evidence(spark, sf).select("doc_id", F.md5("text").alias("text_md5"), "similarity", "evidence_id").groupBy("doc_id", "text_md5").agg(
        F.max("similarity").alias("similarity"), F.max_by("evidence_id", F.struct("similarity", -F.col("evidence_id"))).alias("evidence_id")
    )


@query("exact_text_dedup", "SELECT min(doc_id) AS doc_id, md5(text) AS text_md5, count(*) AS copies FROM documents WHERE trim(text) <> '' GROUP BY text")
def exact_text_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").where(F.trim("text") != "").select("doc_id", F.md5("text").alias("text_md5"))
    return rows.groupBy("text_md5").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query(
    "genericity",
    """WITH pairs AS (SELECT a.vec_id, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s, b.vec_id AS other
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id % 7 <> b.vec_id % 7),
ranked AS (SELECT vec_id, s, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, other) AS r FROM pairs)
SELECT e.vec_id, e.label, round(coalesce(avg(s) FILTER (WHERE r <= 5), 0.0), 5) AS genericity FROM embeddings e LEFT JOIN ranked USING (vec_id) GROUP BY ALL""",
)
def genericity(spark: SparkSession, sf: str) -> DataFrame:
    """Mean similarity of each vector to its five nearest of the same concept (label) from other papers (here vec_id mod 7)."""
    from lexmill.operators.blocks import nearest_in_group

    rows = table(spark, sf, "embeddings").withColumn("paper", F.col("vec_id") % 7)
    near = nearest_in_group(rows, "label", "vec_id", "paper", "embedding", 5)
    means = near.groupBy("vec_id").agg(F.avg("similarity").alias("m"))
    return rows.join(means, "vec_id", "left").select("vec_id", "label", F.round(F.coalesce("m", F.lit(0.0)), 5).alias("genericity"))


@query(
    "consensus_split",
    """WITH pairs AS (SELECT a.vec_id, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s, b.vec_id AS other
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id % 7 <> b.vec_id % 7),
ranked AS (SELECT vec_id, s, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, other) AS r FROM pairs),
g AS (SELECT e.vec_id, e.label, round(coalesce(avg(s) FILTER (WHERE r <= 5), 0.0), 5) AS genericity FROM embeddings e LEFT JOIN ranked USING (vec_id) GROUP BY ALL),
d AS (SELECT label, count(*) FILTER (WHERE genericity < 0.2) AS differential FROM g GROUP BY label)
SELECT vec_id, label, genericity >= 0.2 AND differential > 0 AS generic FROM g JOIN d USING (label)""",
)
def consensus_split(spark: SparkSession, sf: str) -> DataFrame:
    """Generic vectors go to the consensus, unless nothing else would remain of their concept."""
    rows = cut(genericity(spark, sf))
    left = rows.groupBy("label").agg(F.count_if(F.col("genericity") < 0.2).alias("differential"))
    return rows.join(left, "label").select("vec_id", "label", ((F.col("genericity") >= 0.2) & (F.col("differential") > 0)).alias("generic"))


@query(
    "centroids",
    """WITH d AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT label, i, avg(v) AS v FROM d GROUP BY ALL), n AS (SELECT label, sqrt(sum(v * v)) AS n FROM m GROUP BY label)
SELECT label, (i - 1)::INT AS dim, round(v / n, 5) AS value FROM m JOIN n USING (label)""",
)
def centroids(spark: SparkSession, sf: str) -> DataFrame:
    """The normalised mean of each label's vectors, by sums of each dimension that are combined before the shuffle."""
    means = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("dim", "v")).groupBy("label", "dim").agg(F.avg(F.col("v").cast("double")).alias("v"))
    length = F.sqrt(F.sum(F.col("v") * F.col("v")).over(Window.partitionBy("label")))
    return means.select("label", "dim", F.round(F.col("v") / length, 5).alias("value"))


@query(
    "nearest_centroid",
    """WITH d AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE vec_id % 10 <> 0),
m AS (SELECT label, i, avg(v) AS v FROM d GROUP BY ALL), n AS (SELECT label, sqrt(sum(v * v)) AS n FROM m GROUP BY label),
c AS (SELECT label, list(v / n ORDER BY i) AS centroid FROM m JOIN n USING (label) GROUP BY label),
s AS (SELECT e.vec_id, c.label, round(list_dot_product(e.embedding::DOUBLE[], c.centroid), 5) AS score FROM embeddings e, c WHERE e.vec_id % 10 = 0)
SELECT vec_id, arg_max(label, (score, -label)) AS label, max(score) AS score, 1 - max(score) <= 0.5 AS merged FROM s GROUP BY vec_id""",
)
def nearest_centroid(spark: SparkSession, sf: str) -> DataFrame:
    """Singletons (here every tenth vector) against the centroids of the larger clusters; merged if near enough.

    There is one centroid for each label; they are broadcast while there are few of them.
    """
    rows = table(spark, sf, "embeddings")
    means = (
        rows.where("vec_id % 10 <> 0").select("label", F.posexplode("embedding").alias("dim", "v")).groupBy("label", "dim").agg(F.avg(F.col("v").cast("double")).alias("v"))
    )
    vectors = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "v"))), lambda x: x["v"]).alias("c"))
    unit = vectors.select("label", F.transform("c", lambda x: x / F.sqrt(F.aggregate("c", F.lit(0.0), lambda s, y: s + y * y))).alias("c"))
    singles = rows.where("vec_id % 10 = 0").select("vec_id", "embedding")
    scored = singles.join(unit).select("vec_id", "label", F.round(dot(F.col("embedding"), F.col("c")), 5).alias("score"))
    best = scored.groupBy("vec_id").agg(F.max_by("label", F.struct("score", -F.col("label"))).alias("label"), F.max("score").alias("score"))
    return best.withColumn("merged", 1 - F.col("score") <= 0.5)


@query(
    "section_weighted_vector",
    """WITH w AS (SELECT label, vec_id, embedding, CASE vec_id % 3 WHEN 0 THEN 0.4 WHEN 1 THEN 0.9 ELSE 1.0 END AS w FROM embeddings),
d AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v, w FROM w)
SELECT label, (i - 1)::INT AS dim, round(sum(v * w) / sum(w), 5) AS value FROM d GROUP BY ALL""",
)
def section_weighted_vector(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of a paper's sections averaged with the sections' weights."""
    weight = F.when(F.col("vec_id") % 3 == 0, 0.4).when(F.col("vec_id") % 3 == 1, 0.9).otherwise(1.0)
    flat = table(spark, sf, "embeddings").select("label", weight.alias("w"), F.posexplode("embedding").alias("dim", "v"))
    return flat.groupBy("label", "dim").agg(F.round(F.sum(F.col("v").cast("double") * F.col("w")) / F.sum("w"), 5).alias("value"))


@query(
    "section_filter",
    f"""WITH {_OBJ}, s AS (SELECT t.topic, list_dot_product(t.embedding::DOUBLE[], a.embedding::DOUBLE[]) AS study, list_dot_product(t.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS focus
  FROM topics t, (SELECT embedding FROM objectives WHERE objective = 0) a, (SELECT embedding FROM objectives WHERE objective = 1) b)
SELECT topic, round(0.6 * study + 0.4 * focus, 5) AS score FROM s WHERE round(0.6 * study + 0.4 * focus, 5) >= 0.05""",
)
def section_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    asked = rows.where("vec_id < 2").agg(
        F.max_by("embedding", F.when(F.col("vec_id") == 0, 1)).alias("study"), F.max_by("embedding", F.when(F.col("vec_id") == 1, 1)).alias("focus")
    )
    score = F.round(0.6 * dot(F.col("embedding"), F.col("study")) + 0.4 * dot(F.col("embedding"), F.col("focus")), 5)
    return rows.where("vec_id >= 8").join(F.broadcast(asked)).select(F.col("vec_id").alias("topic"), score.alias("score")).where("score >= 0.05")


plans.integers({"rank_threshold": ["rank"], "rank_stream_quota": ["place"], "rank_overflow": ["place"], "top_objectives": ["rank"], "evidence_selection": ["rank"]})
