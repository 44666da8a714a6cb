"""Ranking: thresholds, quotas, percentiles, rescue and greedy selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, groups: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group. Spark prunes inside each task before the shuffle (WindowGroupLimit)."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col(rank) <= k)


def stream_quota(scored: DataFrame, stream: str, key: str, score: str, k: int) -> tuple[DataFrame, DataFrame]:
    """(selected, overflow) of a ranking by streams in the order of their names.

    A row's place counts against its stream's quota even if an earlier stream has taken the key; the overflow holds rows
    beyond the quota whose key no earlier stream, and not the row's own, has taken.
    """
    place = F.row_number().over(Window.partitionBy(stream).orderBy(F.desc(score), key))
    ranked = scored.withColumn("place", place)
    inside = ranked.where(F.col("place") <= k)
    selected = inside.groupBy(key).agg(
        F.min(stream).alias(stream), F.min_by("place", stream).alias("place"), F.min_by(score, stream).alias(score)
    )
    taken = selected.select(F.col(key), F.col(stream).alias("__first"))
    overflow = ranked.where(F.col("place") > k).join(taken, key, "left")
    return selected, overflow.where(F.col("__first").isNull() | (F.col("__first") > F.col(stream))).drop("__first")


def percentile_cut(df: DataFrame, groups: list[str], score: str, share: float) -> DataFrame:
    """Rows whose score reaches the exact, linearly interpolated percentile of their group."""
    cuts = df.groupBy(*groups).agg(F.percentile(F.col(score), F.lit(share)).alias("__cut"))
    return df.join(cuts, groups).where(F.col(score) >= F.col("__cut")).drop("__cut")


def evidence_chain(df: DataFrame, group: str, doc: str, key: str, score: str, floor: float, share: float, rescue: float, cap: int) -> DataFrame:
    """Floor, percentile, rescue of the best row of documents left without one, and a cap on each group."""
    above = df.where(F.col(score) >= floor)
    kept = percentile_cut(above, [group], score, share).select(group, doc, key, score)
    best = df.groupBy(group, doc).agg(F.max_by(key, F.struct(score, -F.col(key))).alias(key), F.max(score).alias(score))
    lost = best.where(F.col(score) >= rescue).join(kept.select(group, doc).distinct(), [group, doc], "left_anti")
    rows = kept.withColumn("rescued", F.lit(False)).unionByName(lost.select(group, doc, key, score).withColumn("rescued", F.lit(True)))
    return top_per_group(rows, [group], [F.desc(score), F.col(key)], cap)
