"""All query modules of the core."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnloom.plans import answers, documents, exchange, history, lists, lookup, markup, metering, relational, repos, skewed, web

MODULES = (skewed, web, history, metering, documents, relational, markup, lists, lookup, repos, answers, exchange)
FLAGSHIP = "p7_owner_stats"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
