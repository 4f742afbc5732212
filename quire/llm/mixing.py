"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from math import fsum

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BUCKETS = 4096


def source_sizes(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """Per listed source: share, cap, size S and number of records.

    Size of a text is its number of UTF-8 bytes (ByT5 tokens); null text is 0.
    A source listed twice counts once (largest share, largest cap); a listed
    source without documents has size 0; a null source matches nothing; a share
    or cap that is nowhere given stays null.
    """
    listed = (
        targets.where(F.col("source").isNotNull())
        .groupBy("source")
        .agg(
            F.max("target_share").alias("target_share"),
            F.max("max_repeats").cast("int").alias("max_repeats"),
        )
    )
    sizes = (
        docs.where(F.col("source").isNotNull())
        .groupBy("source")
        .agg(
            F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).alias("size"),
            F.count(F.lit(1)).alias("records"),
        )
    )
    return (
        listed.join(sizes, "source", "left")
        .withColumn("size", F.coalesce("size", F.lit(0)).cast("long"))
        .withColumn("records", F.coalesce("records", F.lit(0)).cast("long"))
    )


def _fill(frame: pd.DataFrame, budget: float | None) -> pd.DataFrame:
    """Water-filling over one row per source.

    Round 1 gives every source its share of the budget; whoever would exceed
    ``max_repeats`` times its size is clamped there. What is left of the budget
    (by clamps, or because the shares sum to less than 1) goes to the rest in
    proportion to their shares, until nobody exceeds its cap: the level, that is
    size per share, only rises. ``clamped_round`` is the round in which a source
    was clamped (null: never). A source without share gets null; one without cap
    is never clamped and, as in the SQL, gets its share of the level on top of
    the budget.
    """
    out = frame.sort_values("source").reset_index(drop=True)
    out["max_repeats"] = out["max_repeats"].astype("Int32")
    cap = out["max_repeats"].to_numpy("float64", na_value=float("nan")) * out["size"].to_numpy("float64")
    share = out["target_share"].to_numpy("float64")
    total = float(out["size"].sum()) if budget is None else float(budget)
    given = pd.Series(0.0, index=out.index)
    round_of = pd.Series(pd.NA, index=out.index, dtype="Int32")
    open_ = [i for i in out.index if not pd.isna(share[i]) and not pd.isna(cap[i])]
    level, left, number = total, total, 0
    while open_:
        number += 1
        over = [i for i in open_ if share[i] * level > cap[i]]
        for i in over:
            given[i], round_of[i] = cap[i], number
            left -= cap[i]
        open_ = [i for i in open_ if i not in set(over)]
        weight = fsum(share[i] for i in open_)
        raised = left / weight if weight > 0 else level
        if not over and raised <= level:
            break
        level = max(level, raised)
    for i in out.index[round_of.isna()]:
        given[i] = share[i] * level
    size = out["size"].to_numpy("float64")
    out["granted"] = given.astype("float64")
    out["epochs"] = [g / s if s > 0 else 0.0 for g, s in zip(given, size)]
    out["clamped_round"] = round_of
    return out


_PLAN = (
    "source string, target_share double, max_repeats int, size long, records long, "
    "granted double, epochs double, clamped_round int"
)


def water_fill(sizes: DataFrame, budget: float | None = None) -> DataFrame:
    """Capped water-filling of ``source_sizes`` (a row per listed source, so one
    small group whatever the size of the corpus). ``budget`` is the size of the
    mix, by default the size T of all documents of the listed sources."""
    return sizes.groupBy().applyInPandas(lambda pdf: _fill(pdf, budget), _PLAN)


def unreachable(plan: DataFrame) -> DataFrame:
    """Sources that the first round clamps: share x T > max_repeats x S."""
    return plan.where(F.col("clamped_round") == 1).select("source")


def sample_mix(docs: DataFrame, plan: DataFrame, seed: int = 17, key: str = "doc_id") -> DataFrame:
    """How often each record of a listed source is used (``copies`` >= 1 rows only).

    A source with 2.3 epochs uses each record twice and a seeded 0.3 of its size
    a third time. The fraction is a prefix of the records in the order of a seeded
    hash, found in two levels (sizes by hash bucket, then rows of the one bucket
    that holds the cut), so that no source is ever sorted whole. The cut falls at
    the record that comes nearest below the wanted size. Equal keys are used
    alike; null texts have size 0 and follow their hash.
    """
    sized = docs.where(F.col("source").isNotNull()).select(
        F.col(key).alias("_key"),
        "source",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("_size"),
        F.xxhash64(F.lit(seed), F.col(key), F.col("source")).alias("_hash"),
    )
    sized = sized.withColumn("_bucket", F.pmod("_hash", F.lit(_BUCKETS)).cast("int"))
    quota = plan.where("epochs > 0").select(
        "source",
        F.floor("epochs").cast("int").alias("_whole"),
        ((F.col("epochs") - F.floor("epochs")) * F.col("size")).alias("_part"),
    )
    filled = (
        sized.groupBy("source", "_bucket")
        .agg(F.sum("_size").alias("_bsize"))
        .withColumn(
            "_before",
            F.sum("_bsize").over(Window.partitionBy("source").orderBy("_bucket")) - F.col("_bsize"),
        )
    )
    cut = filled.join(quota, "source").select(
        "source",
        "_bucket",
        "_whole",
        "_part",
        "_before",
        F.when(F.col("_before") >= F.col("_part"), 0)
        .when(F.col("_before") + F.col("_bsize") <= F.col("_part"), 1)
        .alias("_all"),
    )
    rows = sized.join(cut, ["source", "_bucket"])
    inside = Window.partitionBy("source", "_bucket").orderBy("_hash", "_key")
    # only rows of the bucket with the cut need an order
    edge = rows.where(F.col("_all").isNull()).withColumn(
        "_extra",
        (F.col("_before") + F.sum("_size").over(inside) <= F.col("_part")).cast("int"),
    )
    plain = rows.where(F.col("_all").isNotNull()).withColumn("_extra", F.col("_all"))
    return (
        plain.unionByName(edge)
        .withColumn("copies", (F.col("_whole") + F.col("_extra")).cast("int"))
        .where("copies > 0")
        .select(F.col("_key").alias(key), "source", F.col("_size").alias("size"), "copies")
    )


def mix_report(plan: DataFrame, mix: DataFrame) -> DataFrame:
    """Share wanted, granted and actually reached by the sampled records."""
    used = mix.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("used_size"),
        F.sum("copies").cast("long").alias("used_records"),
    )
    whole = used.agg(F.sum("used_size").alias("_all"))
    return (
        plan.join(used, "source", "left")
        .join(F.broadcast(whole))  # one row
        .select(
            "source",
            "target_share",
            "max_repeats",
            "size",
            "granted",
            "epochs",
            F.coalesce("used_size", F.lit(0)).alias("used_size"),
            F.coalesce("used_records", F.lit(0)).alias("used_records"),
            F.when(F.col("_all") > 0, F.coalesce("used_size", F.lit(0)) / F.col("_all"))
            .otherwise(0.0)
            .alias("actual_share"),
            F.col("clamped_round"),
        )
    )
