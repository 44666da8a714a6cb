"""Passages that state the same finding, clustered by Markov clustering.

Texts become bags of canonical words (see `bags`): misspellings, implied words and synonyms are resolved, function words
and words of reporting, figures and citations are left out. The figure that some texts report is the evidence by which
synonyms are learned: texts that differ in two words alone and report the same figure show that these say the same.

Distinct bags are the nodes of a graph; equal bags are one node, so a finding repeated any number of times costs one node.
Two nodes are linked if one bag is a part of the other: a text may leave a circumstance out, but where each of two texts
has a word that the other lacks (another drug, another direction of the effect) they state different findings.
Markov clustering then alternates, on the distributed sparse matrix of flows: squaring (a join and a sum), inflation,
pruning of small entries and normalisation of columns. The rows that keep the flow are attractors and define the
clusters. An entry is small against the largest of its column, so no column is ever emptied and no node is lost, however
many texts are alike. The members that send them the strongest flow, weighted by their similarity to the concept, represent them.

Defined results: null, empty and blank texts are in no cluster; a text of reporting words alone is known by its plain
words; repeated rows share a cluster; similarities outside 0..1 and nulls count as the least; ties go to the smallest
id; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import warnings

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm import bags
from lexmill.llm.names import fold
from lexmill.session import cut, grown, release

#: Function words and words of reporting, which say nothing of a finding.
STOP = frozenset(
    """a an the of in on at to for from by with and or than as is are was were be been has have had it its this
    that these those which who we our us they their could can may might also when where while although though however
    whereas during after before between among across against per using used use compared compare relative rather
    according measurements measurement report reports authors author study studies conclude concludes concluded found find
    observed observe show shows showed shown notably table figure result results about percent""".split()
)
#: A reported figure and what belongs to it ("a change of 18.1%", "(about 52 percent)"), and references.
FIGURE = re.compile(r"(?:,? \ban? \w+ of )?\(?(about |approximately |nearly |around )?(\d+(?:[.,]\d+)?)\s*(?:%|percent\b|per cent\b)\)?")
REFERENCE = re.compile(r"\[[\d,;\s-]+\]|\b(?:table|figure|fig\.) \d+")
#: Two bags are linked if one is part of the other and has this share and so many of its words, or almost all of them.
LEAST_SHARE, SHARED, SURE_SHARE = 0.4, 7, 0.8
INFLATION, PRUNE, SETTLED = 2.0, 0.01, 1e-5
#: Rounds until the flows settle; flows that still move after so many are reported by a warning.
ROUNDS = 60


def read_finding(text: str) -> tuple[list[str], float | None, float | None]:
    """(words, bounds of the first figure that is reported) of a text."""
    plain = re.sub(r"\s+", " ", fold(text))
    lo = hi = None
    if figure := FIGURE.search(plain):
        value = float(figure.group(2).replace(",", "."))
        # A rounded figure can stand for all that round to it.
        off = 0.51 if figure.group(1) or not re.search("[.,]", figure.group(2)) else 1e-6
        lo, hi = value - off, value + off
    words = bags.WORD.findall(re.sub(r"\S*(?:\.\.\.|…)\s*$", "", REFERENCE.sub(" ", FIGURE.sub(" ", plain))))
    return words or bags.WORD.findall(plain), lo, hi


def markov(edges: DataFrame) -> DataFrame:
    """(node, cluster, flow) of every node of the symmetric weighted `edges` (i, j, w), which hold each node's loop.

    Each round checkpoints the matrix; the rounds end when every column is settled, that is when its flows are all equal.
    """
    matrix = cut(_columns(edges.select("i", "j", F.col("w").alias("v"))))
    for _ in range(ROUNDS):
        release(edges.sparkSession)
        left = matrix.select("i", F.col("j").alias("k"), F.col("v").alias("u"))
        right = matrix.select(F.col("i").alias("k"), "j", "v")
        squared = left.join(grown(right), "k").groupBy("i", "j").agg(F.sum(F.col("u") * F.col("v")).alias("v"))
        matrix = cut(_columns(squared.select("i", "j", F.pow("v", F.lit(INFLATION)).alias("v"))))
        unsettled = matrix.agg(F.max("unsettled")).first()[0]
        if not unsettled or unsettled < SETTLED:
            break
    else:
        warnings.warn(f"the flows have not settled after {ROUNDS} rounds", stacklevel=2)
    # Flows rounded against the column's largest, so that equal attractors tie and the smallest id takes all.
    ranked = F.struct(F.round(F.col("v") / F.col("top"), 4).alias("v"), (-F.col("i")).alias("least"))
    best = cut(matrix.groupBy(F.col("j").alias("node")).agg(F.max(ranked).alias("best"), F.max("top").alias("top")))
    best = best.select("node", (-F.col("best.least")).alias("to"), F.round("top", 4).alias("flow"))
    onward = best.select(F.col("node").alias("to"), F.col("to").alias("cluster"))
    return best.join(grown(onward), "to").select("node", "cluster", "flow")


def _columns(matrix: DataFrame) -> DataFrame:
    """The matrix without the entries that are small against the largest of their column, which always stays, and with every
    column summing to 1; `top` is the column's largest entry, `unsettled` how far the
    entries are from being equal.

    All of it takes one exchange by column; a long column spills.
    """
    column = Window.partitionBy("j")
    kept = matrix.withColumn("top", F.max("v").over(column)).where(F.col("v") >= PRUNE * F.col("top"))
    kept = kept.withColumn("total", F.sum("v").over(column))
    share = kept.select("i", "j", (F.col("v") / F.col("total")).alias("v"), (F.col("top") / F.col("total")).alias("top"))
    return share.withColumn("unsettled", 1 - F.sum(F.col("v") * F.col("v")).over(column) / F.col("top"))


def cluster_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, cluster, flow) of every row with a text."""
    rows = df.where(F.col(text).isNotNull() & (F.trim(F.col(text)) != ""))
    bagged = bags.learn(rows, key, text, read_finding, STOP).where(F.size("bag") > 0)
    release(df.sparkSession)
    named = bagged.withColumn("node", F.xxhash64(F.concat_ws(" ", "bag")))
    nodes = cut(named.groupBy("node").agg(F.first("bag").alias("bag")))
    release(df.sparkSession)
    links = cut(bags.within(nodes, "node", LEAST_SHARE, SHARED, SURE_SHARE).select("a", "b", F.col("share").alias("w")))
    both = links.select(F.col("a").alias("i"), F.col("b").alias("j"), "w").unionByName(links.select(F.col("b").alias("i"), F.col("a").alias("j"), "w"))
    linked = both.select("i").distinct()
    edges = both.unionByName(linked.select("i", F.col("i").alias("j"), F.lit(1.0).alias("w")))
    # A node without links is a cluster by itself, and all flow stays in it.
    lone = nodes.select("node").join(grown(linked.select(F.col("i").alias("node"))), "node", "left_anti")
    clusters = markov(edges).unionByName(lone.select("node", F.col("node").alias("cluster"), F.lit(1.0).alias("flow")))
    return named.select(key, "node").join(grown(clusters), "node").select(key, "cluster", "flow")


def finding_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """(a, b): pairs of rows that state the same finding, the smaller id first."""
    members = cut(cluster_texts(df, key, text).select(key, "cluster"))
    a = members.select(F.col(key).alias(f"{key}_a"), "cluster")
    b = members.select(F.col(key).alias(f"{key}_b"), "cluster")
    return a.join(grown(b), "cluster").where(F.col(f"{key}_a") < F.col(f"{key}_b")).drop("cluster")


def finding_clusters(df: DataFrame, key: str, text: str, similarity: str, top: int = 3) -> DataFrame:
    """(cluster, size, typical): each cluster's size and the ids of its `top` most typical members."""
    held = F.coalesce(F.when(F.col(similarity).between(0.0, 1.0), F.col(similarity)), F.lit(0.0))
    scored = (
        cluster_texts(df, key, text)
        .join(grown(df.select(key, held.alias("__s"))), key)
        .select("cluster", key, (F.col("flow") * (1 + F.col("__s"))).alias("weight"))
    )
    sizes = scored.groupBy("cluster").agg(F.count("*").alias("size"))
    # The best members through repeated maxima of combined aggregates would cost as much as a rank; ranks spill.
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("weight"), key))
    typical = scored.withColumn("rank", rank).where(F.col("rank") <= top).groupBy("cluster").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", key))), lambda x: x[key]).alias("typical")
    )
    return sizes.join(grown(typical), "cluster")
