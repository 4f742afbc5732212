"""Order-based building blocks shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], order: list[str], breaks: Column, name: str = "island") -> DataFrame:
    """Number the runs of rows of each key, a new one beginning wherever ``breaks`` holds
    (null counts as no break). ``breaks`` may use lag and lead over the same order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    flagged = df.withColumn("_break", F.coalesce(breaks, F.lit(False)).cast("int"))
    return flagged.withColumn(name, F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_break")


def edge_length(lines: Column, keep: Column) -> Column:
    """Number of leading elements for which ``keep`` (array of booleans) is false."""
    at = F.array_position(keep, F.lit(True))
    return F.when(at == 0, F.size(lines)).otherwise(at - 1).cast("int")


def first_most_common(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Per key the most frequent value; of equally frequent ones that seen first by ``order``."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("_n", (-F.col("_first")).alias("_f"))).alias(value))
