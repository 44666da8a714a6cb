"""Streaming ingestion: late events, windows, deduplication and upserts by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, path: str, like: DataFrame, files: int = 4) -> DataFrame:
    """A stream of the parquet files of a folder, a few files a trigger."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).parquet(path)


def windowed_counts(events: DataFrame, at: str, group: str, value: str, late: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """Counts and sums of event-time windows; events later than the watermark are dropped, its delay is the parameter."""
    timed = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return timed.groupBy(F.window(at, width), group).agg(F.count("*").alias("n"), F.sum(value).alias("value")).select(
        F.col("window.start").alias("start"), group, "n", "value"
    )


def first_hits(hits: DataFrame, key: str, at: str, late: str = "30 days") -> DataFrame:
    """The first arrival of each key; state older than the watermark is forgotten."""
    return hits.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def sessions(events: DataFrame, at: str, user: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    timed = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return timed.groupBy(F.session_window(at, gap), user).agg(F.count("*").alias("n")).select(
        F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), user, "n"
    )


def upsert(spark: SparkSession, path: str, keys: list[str], order: str) -> Callable[[DataFrame, int], None]:
    """A sink for foreachBatch: the newest row of each key, in a table that is replaced as a whole version.

    Each batch writes version n+1 from version n and the batch; a batch that is tried again writes the same version.
    """

    def run(batch: DataFrame, number: int) -> None:
        target = f"{path}/version={number}"
        before = f"{path}/version={number - 1}"
        rows = batch
        if number:
            rows = spark.read.parquet(before).unionByName(batch)
        fields = F.struct(*[F.col(c) for c in batch.columns])
        newest = rows.groupBy(*keys).agg(F.max_by(fields, F.struct(F.col(order), F.xxhash64(*batch.columns))).alias("r")).select("r.*")
        newest.write.mode("overwrite").parquet(target)

    return run


def pending(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What an earlier run has not processed yet."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")
