"""The engine from SQL: tables as views, text functions by name, every query as a view."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from quire.runtime import table

#: Functions in SQL itself, so they are planned like built-in expressions: name, arguments, type, body.
FUNCTIONS = (
    ("quire_clean_line", "line STRING", "STRING", r"lower(trim(regexp_replace(line, '(?U)[\\W\\d_]+', ' ')))"),
    ("quire_similarity", "a STRING, b STRING", "DOUBLE", "CASE WHEN greatest(length(a), length(b)) = 0 THEN 1.0 ELSE 1 - levenshtein(a, b) / greatest(length(a), length(b)) END"),
    ("quire_capital_share", "t STRING", "DOUBLE", r"length(regexp_replace(t, '[^\\p{Lu}]', '')) / nullif(length(regexp_replace(t, '[^\\p{L}]', '')), 0)"),
    ("quire_xml_safe", "t STRING", "STRING", r"regexp_replace(t, '[^\\x09\\x0A\\x0D\\x20-\\x{D7FF}\\x{E000}-\\x{FFFD}\\x{10000}-\\x{10FFFF}]', '')"),
    ("quire_plain_quotes", "t STRING", "STRING", r"""replace(replace(t, "''", '"'), '``', '"')"""),
)


def register_functions(spark: SparkSession) -> list[str]:
    """Temporary SQL functions of the text expressions; returns their names."""
    for name, arguments, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")
    return [f[0] for f in FUNCTIONS]


def register_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> None:
    """Temporary views over the parquet tables of a folder."""
    for name in names:
        table(spark, folder, name).createOrReplaceTempView(name)


def register_queries(spark: SparkSession, folder: str, queries: dict[str, Callable[[SparkSession, str], DataFrame]]) -> None:
    """Temporary views of queries by name, planned when they are read."""
    for name, query in queries.items():
        query(spark, folder).createOrReplaceTempView(name)
