"""Session helpers: table access, checkpointing and task sizing."""

from __future__ import annotations

import gc
import math
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table `name` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a temporary one only where none is configured (tests)."""
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not at:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            at = tempfile.mkdtemp(prefix="lexmill-checkpoint-")
        context.setCheckpointDir(at)
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def grown(df: DataFrame) -> DataFrame:
    """`df` as a side of a join that is never broadcast, for tables that grow with the corpus.

    The planner takes an exploded table for as small as the compressed file that it comes from, and would collect all of it
    in the driver; a sorted side spills.
    """
    return df.hint("merge")


def release(spark: SparkSession) -> None:
    """Let go of the shuffles, checkpoints and buffers of tables that nothing refers to any more.

    They are cleaned when the driver collects garbage, which a long run of small jobs may put off until disks are full; call
    it between the phases of such a run.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame, *keys, factor: int = 2) -> DataFrame:
    """Repartition a scan that has fewer partitions than the cluster has cores, for CPU-heavy Arrow functions.

    A table with enough splits is left as it is, so at scale this adds no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(math.ceil(cores * factor), *keys)
