"""Session helpers shared by every operator: table access, durable cuts, balancing."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that it
    need not be installed on the executors."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quire-"), "quire.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(here):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(here)))
    context.addPyFile(archive)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    A folder already given to the context stands; else the cluster names it in
    ``spark.checkpoint.dir``. Only a session on one machine (``local``) may do without
    and gets a folder of that machine; on a cluster that is an error, since such a
    folder is lost with its executor.
    """
    context = spark.sparkContext
    if folder := context.getCheckpointDir():
        return folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), "quire-checkpoints")
    context.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint, which outlives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def task_count(spark: SparkSession) -> int:
    """Tasks of a stage of Python work: those of a shuffle, and at least one per core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def balanced(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt evenly to the tasks of a Python-heavy stage, whatever files they come in.

    Always shuffles, at every size, so it is used only where the Python work on a row
    costs far more than moving it.
    """
    return df.repartition(task_count(df.sparkSession), *keys)
