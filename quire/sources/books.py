"""Readers: plain-text books, zipped page volumes, XML artefacts, vocabularies; and what is new."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_FILE = r"([^/]+?)(?:\.[^./]*)?$"


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(book_id, text): one book per file, named by the file's stem."""
    return spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_path"), _FILE, 1).alias("book_id"), F.col("value").alias("text")
    )


def unzip_pages(binary: DataFrame) -> DataFrame:
    """(lib_id, book_id, file, text, error) of volumes (path, content) packed as zip archives of
    text files; the library is the folder of the archive. What is no archive, or a file in
    it that cannot be read, gives a row without text that says so in ``error``."""

    def open_(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                parts = path.split("/")
                lib, book = (parts[-2] if len(parts) > 1 else None), parts[-1].removesuffix(".zip")
                rows: list[tuple] = []
                try:
                    archive = zipfile.ZipFile(io.BytesIO(content or b""))
                    names = sorted(n for n in archive.namelist() if n.endswith(".txt"))
                except zipfile.BadZipFile as e:
                    names, rows = [], [(lib, book, None, None, str(e))]
                for name in names:
                    file = name.rsplit("/", 1)[-1]
                    try:
                        rows.append((lib, book, file, archive.read(name).decode("utf-8", "replace"), None))
                    except (zipfile.BadZipFile, OSError, RuntimeError, NotImplementedError, zlib.error) as e:
                        rows.append((lib, book, file, None, str(e)))
                yield pd.DataFrame(rows, columns=["lib_id", "book_id", "file", "text", "error"])

    return binary.select("path", "content").mapInPandas(open_, "lib_id string, book_id string, file string, text string, error string")


def read_volumes(spark: SparkSession, path: str) -> DataFrame:
    return unzip_pages(spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path))


def page_numbers(pages: DataFrame) -> DataFrame:
    """Add page_no from the file name: the part behind the last underscore, else the last eight
    signs of the stem; ``notes`` and ``pagedata`` files and names without number are left out."""
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    number = F.when(F.contains("file", F.lit("_")), F.regexp_extract(stem, r"_([^_]*)$", 1)).otherwise(F.substring(stem, -8, 8))
    return pages.where(~stem.rlike("(?i)^(notes|pagedata)")).withColumn("page_no", number.try_cast("int")).where("page_no is not null")


def feature_page_numbers(pages: DataFrame) -> DataFrame:
    """The number used by page features: the last four digits of the stem."""
    return pages.withColumn("page_no", F.substring(F.regexp_replace("file", r"\.[^.]*$", ""), -4, 4).try_cast("int"))


def read_artefact(spark: SparkSession, path: str, row: str, schema: StructType | None = None) -> DataFrame:
    """Elements ``row`` of well-formed XML artefacts as rows."""
    reader = spark.read.format("xml").option("rowTag", row)
    return (reader.schema(schema) if schema else reader).load(path)


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(term, id) from lines ``term : id``."""
    at = F.regexp_extract("value", r"^(.*\S)\s*:\s*(\d+)\s*$", 1), F.regexp_extract("value", r":\s*(\d+)\s*$", 1)
    return spark.read.text(path).select(at[0].alias("term"), at[1].try_cast("int").alias("id")).where("id is not null")


def read_means(spark: SparkSession, path: str) -> DataFrame:
    """(id, mean, sd) from lines of three numbers parted by white space."""
    part = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.size(part) >= 3).select(part[0].try_cast("int").alias("id"), part[1].try_cast("double").alias("mean"), part[2].try_cast("double").alias("sd"))


def only_new(inputs: DataFrame, done: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Inputs whose keys no earlier output has: a stage skips what is there, unless forced."""
    return inputs if force else inputs.join(done.select(*keys).distinct(), keys, "left_anti")


def read_first(read: Callable[[str], DataFrame], paths: Sequence[str]) -> DataFrame:
    """The first of several versions of an artefact that exists, latest version first."""
    missing: Exception | None = None
    for path in paths:
        try:
            return read(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            missing = e
    raise missing or ValueError("no paths")


def cached(inputs: DataFrame, stage: Callable[[DataFrame], DataFrame], path: str, keys: list[str], force: bool = False) -> DataFrame:
    """Output of a costly stage (an annotator), kept as parquet: only inputs whose keys are not
    there yet run through it. ``force`` runs them all again. Inputs that give no rows run each time."""
    spark = inputs.sparkSession
    if force:
        stage(inputs).write.mode("overwrite").parquet(path)
    else:
        try:
            done = spark.read.parquet(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            stage(inputs).write.mode("append").parquet(path)
        else:
            stage(only_new(inputs, done, keys)).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def read_marks(spark: SparkSession, path: str, most: int = 10_000) -> tuple[str, ...]:
    """Marks of notices, one per line as it stands, from a list of at most ``most`` lines."""
    lines = [r.value for r in spark.read.text(path).limit(most + 1).collect()]
    if len(lines) > most:
        raise ValueError(f"{path} has more than {most} marks")
    return tuple(dict.fromkeys(x for x in lines if x.strip()))
