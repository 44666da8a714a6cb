"""Identity of records: keys, transitive groups and survivorship."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.session import cut

#: A title alone names a record only if it is at least so long.
TITLE_ONLY = 25


def identity_keys(df: DataFrame, record: str, pmid: str = "pmid", doi: str = "doi", title: str = "title", year: str = "year") -> DataFrame:
    """(record, key): by pmid, doi, title with year, or a long title alone where the year is missing."""
    name = X.normalized_title(F.col(title))
    doi_key = X.normalize_doi(F.col(doi))
    keys = F.array(
        F.when(F.trim(pmid) != "", F.concat(F.lit("pmid:"), F.trim(pmid))),
        F.when(doi_key != "", F.concat(F.lit("doi:"), doi_key)),
        F.when(
            (name != "") & F.col(year).isNotNull() & (F.col(year) != 0),
            F.concat(F.lit("ty:"), F.sha1(name), F.lit(":"), F.col(year).cast("string")),
        ).when(F.length(name) >= TITLE_ONLY, F.concat(F.lit("t:"), F.sha1(name))),
    )
    return df.select(F.col(record).alias("record"), F.explode(F.array_compact(keys)).alias("key"))


def components(edges: DataFrame, records: DataFrame, rounds: int = 50) -> DataFrame:
    """(record, component): transitive groups of records that share keys; the component is the smallest record.

    Every round moves each node to the smallest node that any of its keys has, and contracts the graph to these, so
    the graph shrinks and the rounds grow with the logarithm of a group's length. The minima are combined before the
    shuffle, so a key that a third of all records share costs one row a task. Each round is checkpointed.
    """
    found = records.select("record", F.col("record").alias("component"))
    nodes = cut(edges.select(F.col("record").alias("node"), "key").distinct())
    for _ in range(rounds):
        lowest = nodes.groupBy("key").agg(F.min("node").alias("low"))
        moves = cut(nodes.join(lowest, "key").groupBy("node").agg(F.min("low").alias("to")))
        if moves.where(F.col("to") != F.col("node")).isEmpty():
            break
        found = cut(
            found.join(moves, found["component"] == moves["node"], "left").select("record", F.coalesce("to", "component").alias("component"))
        )
        nodes = cut(nodes.join(moves, "node").select(F.col("to").alias("node"), "key").distinct())
    return found


def first_non_empty(value: Column, order: str = "rec_id") -> Column:
    """Aggregate: the first value in order that is not null or ''."""
    held = F.when(value.cast("string") != "", value)
    return F.min_by(held, F.when(held.isNotNull(), F.col(order)))


def longest(value: Column, order: str = "rec_id") -> Column:
    """Aggregate: the longest string, the first in order on ties."""
    held = F.when(F.trim(value) != "", value)
    return F.max_by(held, F.when(held.isNotNull(), F.struct(F.length(held), -F.col(order))))


def most_frequent(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """(group, value): the most frequent value of each group, the smallest on ties."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("__n"))
    return counts.groupBy(*group).agg(F.min_by(value, F.struct(-F.col("__n"), F.col(value))).alias(value))


def ordered_union(df: DataFrame, group: list[str], items: str, order: str) -> DataFrame:
    """(group, items): distinct elements of the groups' arrays in order of first occurrence.

    Only distinct elements with their first places are collected, not the rows.
    """
    placed = df.select(*group, F.col(order).alias("__row"), F.posexplode(items).alias("__pos", "__item"))
    first = placed.groupBy(*group, "__item").agg(F.min(F.struct("__row", "__pos")).alias("__at"))
    return first.groupBy(*group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__at", "__item"))), lambda x: x["__item"]).alias(items)
    )


def primary(df: DataFrame, group: str, order: str = "rec_id") -> DataFrame:
    """(group, record): the most complete record, one with a doi before one without, the first on ties."""
    filled = sum(
        F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != "") & (F.col(c).cast("string") != "0"), 1).otherwise(0)
        for c in ("title", "abstract", "year", "venue", "document_type", "language")
    )
    score = F.struct(
        F.when(X.normalize_doi(F.col("doi")) != "", 1).otherwise(0).alias("d"), filled.alias("f"),
        F.coalesce(F.size("authors"), F.lit(0)).alias("a"), F.coalesce(F.size("keywords"), F.lit(0)).alias("k"), (-F.col(order)).alias("o"),
    )
    return df.groupBy(group).agg(F.max_by("paper_id", score).alias("paper_id"), F.max_by(order, score).alias("primary"))


def latest(df: DataFrame, keys: list[str], at: str, tie: str) -> DataFrame:
    """The latest row of each key; ties go to the larger `tie`."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(at), F.desc(tie)))
    return df.withColumn("__r", rank).where("__r = 1").drop("__r")
