"""All core queries and their check SQL, gathered from the plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.plans import books, corpus, volumes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
for _module in (corpus, books, volumes):
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
