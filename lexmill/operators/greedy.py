"""Order-dependent operators: greedy deduplication, packing in order, and average-linkage clustering.

Pairs above a threshold are found in blocks. Deduplication then decides rows in distributed rounds, packing carries its state
from span to span, and average linkage works inside the connected components of the near pairs, one task each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.operators.blocks import pairs_above
from lexmill.operators.identity import components
from lexmill.operators.numbering import number_rows
from lexmill.session import cut

#: Distance thresholds by the number of vectors, the first that the number reaches.
THRESHOLDS = [(40, 0.38), (30, 0.36), (20, 0.34), (15, 0.32), (10, 0.35), (6, 0.38), (3, 0.42), (0, 0.48)]


def greedy_dedup(df: DataFrame, group: str, key: str, vector: str, least: float) -> DataFrame:
    """(group, key, kept): in order of `key`, a row is dropped if a kept earlier one is at least so similar.

    All groups are decided at once, in rounds: a row without an undecided earlier neighbour is kept, and what is near a kept
    row and later is dropped. A round costs two joins of the pairs that are still open, and no task holds a group.
    """
    rows = df.select(group, key)
    open_ = cut(pairs_above(df, group, key, vector, least).select("a", "b"))
    dropped = None
    while not open_.isEmpty():
        later = open_.select(F.col("b").alias("a")).distinct()
        first = open_.select("a").distinct().join(later, "a", "left_anti")
        gone = cut(open_.join(first, "a").select("b").distinct())
        dropped = gone if dropped is None else cut(dropped.unionByName(gone))
        # Pairs of the kept and of the dropped are settled; what is left has both ends undecided.
        rest = open_.join(first, "a", "left_anti").join(gone, "b", "left_anti")
        open_ = cut(rest.join(gone.withColumnRenamed("b", "a"), "a", "left_anti").select("a", "b"))
    if dropped is None:
        return rows.withColumn("kept", F.lit(True))
    marked = dropped.select(F.col("b").alias(key), F.lit(False).alias("kept"))
    return rows.join(marked, key, "left").select(group, key, F.coalesce("kept", F.lit(True)).alias("kept"))


def pack_in_order(df: DataFrame, key: str, size: str, order: list[Column], most: int, capacity: int, span: int = 100_000) -> DataFrame:
    """(key, place, container): rows in order fill containers that close at `most` rows or before exceeding `capacity`.

    Rows are numbered without a global sort in one task, and each span of rows is packed by one task. What is open at the end
    of a span is carried into the next: spans are packed again from the state before them until no state changes. Containers
    close often, so a span's last state hardly ever depends on its first, and a second round changes nothing further on.
    """
    names = [f"__o{i}" for i in range(len(order))]
    keyed = df.select(key, size, *[c.alias(n) for c, n in zip([_bare(c) for c in order], names)])
    placed = number_rows(keyed.select(key, size, *[F.col(n) for n in names]), names, "place").select(key, size, "place")
    spans = cut(placed.withColumn("span", F.floor((F.col("place") - 1) / span)))
    kind = dict(df.dtypes)[key]
    states: dict[int, tuple[int, int]] = {}

    def packed_from(states: dict[int, tuple[int, int]]) -> DataFrame:
        def pack(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("place")
            held, total = states.get(int(pdf["span"].iloc[0]), (0, 0))
            out, n = [], 0
            for s in pdf[size]:
                if held and (held >= most or total + s > capacity):
                    n, held, total = n + 1, 0, 0
                held, total = held + 1, total + s
                out.append((n, held, total))
            inside, helds, totals = zip(*out)
            return pd.DataFrame({key: pdf[key], "place": pdf["place"], "span": pdf["span"], "inside": inside, "held": helds, "total": totals})

        return cut(spans.groupBy("span").applyInPandas(pack, f"{key} {kind}, place long, span long, inside long, held long, total long"))

    while True:
        packed = packed_from(states)
        # One row a span: what it closes, and what it leaves open.
        ends = packed.groupBy("span").agg(F.max_by(F.struct("inside", "held", "total"), "place").alias("end")).orderBy("span").collect()
        after = {r["span"] + 1: (r["end"]["held"], r["end"]["total"]) for r in ends[:-1]}
        if after == states:
            break
        states = after
    before, closed = [], 0
    for r in ends:
        before.append((r["span"], closed))
        closed += r["end"]["inside"]
    offsets = df.sparkSession.createDataFrame(before, "span long, before long")
    return packed.join(F.broadcast(offsets), "span").select(key, "place", (F.col("before") + F.col("inside")).alias("container"))


def _bare(c: Column) -> Column:
    """A descending order of numbers as an ascending column."""
    text = c._jc.toString()
    return -F.col(text.split(" DESC")[0]) if " DESC" in text else c


def threshold(n: Column) -> Column:
    out = F.lit(THRESHOLDS[-1][1])
    for least, value in reversed(THRESHOLDS):
        out = F.when(n >= least, value).otherwise(out)
    return out


def average_linkage(df: DataFrame, group: str, key: str, vector: str) -> DataFrame:
    """(group, key, cluster): clusters merged while the mean distance between two is below the group's threshold.

    Two clusters merge only if some pair of theirs is nearer than the threshold, so every cluster lies inside one
    component of the graph of such pairs; components are clustered independently.
    """
    sizes = df.groupBy(group).agg(F.count("*").alias("n")).select(group, threshold(F.col("n")).alias("limit"))
    widest = max(v for _, v in THRESHOLDS)
    pairs = pairs_above(df, group, key, vector, 1 - widest).join(sizes, group).where(1 - F.col("similarity") <= F.col("limit"))
    pairs = cut(pairs)
    name = F.concat_ws(":", F.col("a").cast("string"), F.col("b").cast("string"))
    edges = pairs.select(F.col("a").alias("record"), name.alias("key")).unionByName(pairs.select(F.col("b").alias("record"), name.alias("key")))
    parts = components(edges, df.select(F.col(key).alias("record")))
    rows = df.select(group, F.col(key).alias("record"), F.col(vector).alias("v")).join(parts, "record").join(sizes, group)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("record")
        v = np.array(pdf["v"].tolist(), dtype=float)
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        d, limit = 1 - v @ v.T, float(pdf["limit"].iloc[0])
        members = {i: [i] for i in range(len(v))}
        np.fill_diagonal(d, np.inf)
        while len(members) > 1:
            i, j = np.unravel_index(np.argmin(d), d.shape)
            if d[i, j] > limit:
                break
            i, j = min(i, j), max(i, j)
            a, b = len(members[i]), len(members[j])
            joined = (a * d[i] + b * d[j]) / (a + b)
            d[i], d[:, i] = joined, joined
            d[i, i] = np.inf
            d[j], d[:, j] = np.inf, np.inf
            members[i] += members.pop(j)
        ids = pdf["record"].to_numpy()
        cluster = {k: min(ids[m] for m in ms) for ms in members.values() for k in ms}
        return pd.DataFrame({group: pdf[group].to_numpy(), key: ids, "cluster": [cluster[k] for k in range(len(ids))]})

    types = dict(df.dtypes)
    return rows.groupBy("component").applyInPandas(merge, f"{group} {types[group]}, {key} {types[key]}, cluster {types[key]}")


def split_large(df: DataFrame, cluster: str, key: str, vector: str, most: int) -> DataFrame:
    """(cluster, key, part): clusters of more than `most` vectors cut into ceil(n / most) parts by average linkage; parts are
    numbered by their smallest key. A cluster is the unit of work, as in `average_linkage`."""

    def divide(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key)
        v = np.array(pdf[vector].tolist(), dtype=float)
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        parts = [[i] for i in range(len(v))]
        wanted = -(-len(v) // most)
        d = 1 - v @ v.T
        np.fill_diagonal(d, np.inf)
        alive = list(range(len(v)))
        while len(alive) > wanted:
            at = np.array(alive)
            i, j = np.unravel_index(np.argmin(d[np.ix_(at, at)]), (len(at), len(at)))
            i, j = sorted((alive[i], alive[j]))
            a, b = len(parts[i]), len(parts[j])
            d[i] = d[:, i] = (a * d[i] + b * d[j]) / (a + b)
            d[i, i] = np.inf
            parts[i] += parts[j]
            alive.remove(j)
        number = {m: n for n, i in enumerate(sorted(alive, key=lambda i: min(parts[i]))) for m in parts[i]}
        return pd.DataFrame({cluster: pdf[cluster], key: pdf[key], "part": [number[i] for i in range(len(v))]})

    kinds = dict(df.dtypes)
    return df.select(cluster, key, vector).groupBy(cluster).applyInPandas(divide, f"{cluster} {kinds[cluster]}, {key} {kinds[key]}, part long")
