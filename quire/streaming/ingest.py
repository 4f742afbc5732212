"""Incremental processing: new files run through the batch operators, counts are kept up to date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream_texts(spark: SparkSession, path: str) -> DataFrame:
    """New text files of a folder as (book_id, text)."""
    raw = spark.readStream.format("text").option("wholetext", True).load(path)
    return raw.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.[^./]*)?$", 1).alias("book_id"), F.col("value").alias("text"))


def process_new(stream: DataFrame, stage: Callable[[DataFrame], DataFrame], output: str, checkpoint: str) -> StreamingQuery:
    """Run a batch stage on what has arrived and append its rows; the stream's checkpoint
    replaces looking for existing outputs. A batch that is repeated after a failure writes
    to the same folder again."""

    def write(batch: DataFrame, number: int) -> None:
        stage(batch).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_counts(stream: DataFrame, column: str) -> DataFrame:
    """Occurrences of a column's values so far."""
    return stream.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(stream: DataFrame, time: str, column: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Occurrences per window of event time; rows later than ``late`` behind the newest are dropped."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), column).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), column, "n")


def read_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    return spark.readStream.schema(schema).parquet(path)
