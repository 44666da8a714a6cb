"""Models and services behind replaceable functions, with deterministic defaults.

A provider is a function from a batch of texts to a batch of answers; it runs in Arrow batches on the executors. Answers
are kept in a table keyed by the hash of their input, and only inputs that it lacks reach the provider.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Provider = Callable[[pd.Series], pd.Series]


def hashed_encoder(dims: int = 64) -> Provider:
    """Unit vectors of hashed words; the stable stand-in for an embedding model."""

    def encode(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            v = np.zeros(dims)
            for w in re.findall(r"\w+", (t or "").lower()):
                v[zlib.crc32(w.encode()) % dims] += 1
            n = np.linalg.norm(v)
            out.append((v / n if n else v).tolist())
        return pd.Series(out)

    return encode


def first_sentences(n: int = 2, least: int = 40) -> Provider:
    """The stand-in for a summarising model: the first sentences, if they are long enough."""

    def answer(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> str:
            parts = re.findall(r"[^.!?]+[.!?]*", t or "")
            head = " ".join(p.strip() for p in parts[:n] if p.strip())
            return head if len(head) >= least else ""

        return texts.map(one)

    return answer


def identity() -> Provider:
    """The stand-in for a translator."""
    return lambda texts: texts.fillna("")


def apply(provider: Provider, column: Column, kind: str) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return provider(texts)

    return F.pandas_udf(run, kind)(column)


def cached(inputs: DataFrame, text: str, cache: DataFrame, provider: Provider, kind: str) -> tuple[DataFrame, DataFrame]:
    """(answers of all distinct inputs, the new ones among them); `cache` has the columns key and answer.

    Each distinct input is asked once. Blank inputs are not asked. The caller appends the new answers to its cache.
    """
    keyed = inputs.where(F.trim(text) != "").select(F.sha2(F.col(text), 256).alias("key"), F.col(text).alias("__t")).dropDuplicates(["key"])
    new = keyed.join(cache.select("key"), "key", "left_anti").select("key", apply(provider, F.col("__t"), kind).alias("answer"))
    held = cache.join(keyed.select("key"), "key", "left_semi").select("key", "answer")
    return held.unionByName(new), new


def first_of(df: DataFrame, key: str, candidates: DataFrame) -> DataFrame:
    """Resolver cascade: the value of the first resolver, by priority, that has one; keys without any stay, with null."""
    best = candidates.where(F.col("value").isNotNull()).groupBy(key).agg(F.min_by(F.struct("resolver", "value"), "priority").alias("best"))
    return df.join(best, key, "left").select(*df.columns, F.col("best.resolver").alias("resolver"), F.col("best.value").alias("value"))
