"""Connected components of an edge list, without gathering it anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.runtime import durable, task_count


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


#: Edges of one key that are contracted together.
PORTION = 50_000


def _contract(edges: DataFrame, near: str) -> DataFrame:
    """Replace the edges (u, v) of each portion by stars (u, v, whole) of the same components.

    Edges of one ``near`` meet in one task, one key after the other; a key of many edges is
    split into portions, whose stars are not ``whole``. A task holds the nodes of one portion.
    """
    sizes = edges.groupBy(near).agg(F.ceil(F.count(F.lit(1)) / PORTION).alias("_cells"))
    placed = edges.join(sizes, near).withColumn("_salt", F.pmod(F.xxhash64("u"), F.col("_cells")))
    kind = edges.schema["u"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict = {}
        now, whole = None, True

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def stars() -> list[tuple]:
            rows = [(x, root(x), whole) for x in parent if root(x) != x]
            parent.clear()
            return rows

        out: list[tuple] = []
        for pdf in batches:
            for key, salt, cells, u, v in zip(pdf["near"], pdf["_salt"], pdf["_cells"], pdf["u"], pdf["v"]):
                if now != (key, salt):
                    out += stars()
                    now, whole = (key, salt), cells == 1
                    if len(out) > PORTION:
                        yield pd.DataFrame(out, columns=["u", "v", "whole"])
                        out = []
                parent.setdefault(u, u)
                parent.setdefault(v, v)
                a, b = root(u), root(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        yield pd.DataFrame(out + stars(), columns=["u", "v", "whole"])

    dealt = placed.repartition(task_count(edges.sparkSession), near, "_salt").sortWithinPartitions(near, "_salt")
    return dealt.select(F.col(near).alias("near"), "_salt", "_cells", "u", "v").mapInPandas(run, f"u {kind}, v {kind}, whole boolean")


def connected_components(edges: DataFrame, a: str, b: str, within: str | None = None) -> DataFrame:
    """(node, component) of every node on an edge; a component is named by its least node.

    Alternates large-star and small-star steps, which turn every component into a
    star around its least node in about log(n) rounds; each round is a handful of
    shuffles with map-side minima, and its result is checkpointed. ``within`` names a
    column that all edges of a component share (as records of one book): components are
    then found key by key, and only the keys of more than ``PORTION`` edges need rounds.
    Null ends and loops are ignored, repeated edges count once, no edges give no rows.
    """
    clean = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    ends = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    if not within:
        return _spread_names(_rounds(clean.select(*ends)))
    keyed = durable(clean.select(*ends, F.coalesce(F.col(within).cast("string"), F.lit("")).alias("_near")))  # counted, then contracted
    stars = durable(_contract(keyed, "_near"))
    split = stars.where("not whole").select("u", "v")
    done = stars.where("whole").select("u", "v")
    return _spread_names(done if split.isEmpty() else done.unionByName(_rounds(split)))


def _spread_names(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _rounds(edges: DataFrame) -> DataFrame:
    """Stars (u, v) around the least node v of every component."""
    now = durable(edges.distinct())
    state = _state(now)
    while True:
        around = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (
            around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        now = durable(small)
        before, state = state, _state(now)
        if state == before:
            return now
