"""Vectors of a group against each other, in blocks.

A group is cut into blocks of bounded size; each task multiplies one pair of blocks as matrices and emits only what is
asked for: neighbours above a threshold, or the best few of each row, which are combined afterwards. The work is that of
all pairs, but no task holds more than two blocks and no pair that is not asked for is written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 2000


def _paired(df: DataFrame, group: str, block: int) -> DataFrame:
    """Rows with (unit, side): unit is an ordered pair of blocks of a group; a row goes to every pair that holds its block."""
    sizes = df.groupBy(group).agg(F.ceil(F.count("*") / block).cast("int").alias("__blocks"))
    rows = df.join(sizes, group).withColumn("__block", F.pmod(F.xxhash64("__key"), F.col("__blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("__blocks") - 1)
    left = rows.withColumn("__other", F.explode(every)).withColumn("__side", F.lit(0))
    right = rows.withColumnRenamed("__block", "__b").withColumn("__block", F.explode(every)).withColumn("__other", F.col("__b")).drop("__b")
    return left.unionByName(right.withColumn("__side", F.lit(1)))


def nearest_in_group(df: DataFrame, group: str, key: str, apart: str, vector: str, k: int, block: int = BLOCK) -> DataFrame:
    """(key, other, similarity): of each row the k most similar rows of its group that differ in `apart`."""
    rows = df.select(group, F.col(key).alias("__key"), F.col(apart).alias("__apart"), F.col(vector).alias("__vector"))

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["__side"] == 0], pdf[pdf["__side"] == 1].sort_values("__key")
        if left.empty or right.empty:
            return pd.DataFrame({"key": [], "other": [], "similarity": []})
        a, b = np.array(left["__vector"].tolist(), dtype=float), np.array(right["__vector"].tolist(), dtype=float)
        s = a @ b.T
        s[left["__apart"].to_numpy()[:, None] == right["__apart"].to_numpy()[None, :]] = -np.inf
        order = np.argsort(-s, axis=1, kind="stable")[:, :k]
        i = np.repeat(np.arange(len(a)), order.shape[1])
        j = order.ravel()
        values = s[i, j]
        good = np.isfinite(values)
        return pd.DataFrame({"key": left["__key"].to_numpy()[i][good], "other": right["__key"].to_numpy()[j][good], "similarity": values[good]})

    kind = dict(rows.dtypes)["__key"]
    parts = _paired(rows, group, block).groupBy(group, "__block", "__other").applyInPandas(best, f"key {kind}, other {kind}, similarity double")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("similarity"), "other"))
    return parts.withColumn("r", rank).where(F.col("r") <= k).select(F.col("key").alias(key), "other", "similarity")


def pairs_above(df: DataFrame, group: str, key: str, vector: str, least: float, block: int = BLOCK) -> DataFrame:
    """(group, a, b, similarity): pairs a < b of a group's rows whose similarity is at least `least`."""
    rows = df.select(group, F.col(key).alias("__key"), F.col(vector).alias("__vector"))

    def above(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["__side"] == 0], pdf[pdf["__side"] == 1]
        ids_a, ids_b = left["__key"].to_numpy(), right["__key"].to_numpy()
        if left.empty or right.empty:
            return pd.DataFrame({group: [], "a": [], "b": [], "similarity": []})
        s = np.array(left["__vector"].tolist(), dtype=float) @ np.array(right["__vector"].tolist(), dtype=float).T
        i, j = np.nonzero((s >= least) & (ids_a[:, None] < ids_b[None, :]))
        return pd.DataFrame({group: pdf[group].iloc[0], "a": ids_a[i], "b": ids_b[j], "similarity": s[i, j]})

    types = dict(rows.dtypes)
    schema = f"{group} {types[group]}, a {types['__key']}, b {types['__key']}, similarity double"
    return _paired(rows, group, block).groupBy(group, "__block", "__other").applyInPandas(above, schema)
