"""All registered queries of the core library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexmill.plans import aggregates, corpus, discovery, enrichment, exports, extras, identity, packed, passages, ranking, reports, scalars

MODULES = [exports, corpus, packed, identity, scalars, ranking, aggregates, passages, discovery, enrichment, extras, reports]

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def sql() -> dict[str, str]:
    return {name: text for module in MODULES for name, text in module.SQL.items()}
