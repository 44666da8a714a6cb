"""Running numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import cut


def number_rows(df: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """`df` with running numbers by `order`, which must be total.

    Rows are range-partitioned and numbered inside each partition; the partitions' sizes, one row each, give the offsets.
    """
    ranged = cut(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    inside = ranged.withColumn("__place", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    numbered = inside.join(F.broadcast(before), "__part")
    return numbered.withColumn(name, F.col("__before") + F.col("__place") + F.lit(start - 1)).drop("__part", "__place", "__before")
