"""Counts over annotated tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(tokens: DataFrame, column: str) -> DataFrame:
    """Occurrences ``n`` of every non-null value of a token attribute."""
    return tokens.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def counts_outside(tokens: DataFrame, column: str, spans: DataFrame) -> DataFrame:
    """Occurrences of an attribute's values on tokens outside all spans
    (book_id, start_tok, end_tok): entities, or only those of characters."""
    inside = (
        spans.where("start_tok is not null and end_tok >= start_tok")
        .select("book_id", F.explode(F.sequence("start_tok", "end_tok")).alias("tok_num_in_doc"))
        .distinct()
    )
    return value_counts(tokens.join(inside, ["book_id", "tok_num_in_doc"], "left_anti"), column)
