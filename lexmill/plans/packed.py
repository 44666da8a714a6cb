"""Queries over packed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.operators.packed_values import split_values
from lexmill.session import table


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each value of search_records.authors and search_records.keywords, in its position."""
    return split_values(table(spark, sf_dir, "search_records"), ["hit_id"], {"authors": True, "keywords": False})


QUERIES = {"p7_found": p7_found}
SQL: dict[str, str] = {}
