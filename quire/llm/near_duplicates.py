"""Near-duplicate records: an exact set-similarity join on word shingles.

Tokens (shingles) are ordered from rare to frequent. A record is found by the
prefix of its tokens that its admissible errors cannot exhaust: rare tokens are
indexed singly, frequent ones as combinations of two or three tokens of the same
class, which pays for itself by a prefix extended by one or two tokens per class.
Every pair at or above the threshold shares at least one such signature. Candidates
meet first with parity sketches, which bound the difference of two sets from below,
and only those that pass are verified on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.graph import connected_components
from quire.runtime import durable

#: Document frequency up to which a token is indexed alone, and in pairs; beyond, in triples.
SINGLE_DF, PAIR_DF = 64, 4096
#: Tokens of a combination class that a record of the bucket's size has on average.
CLASS_TOKENS = 10
#: Records of one signature that meet in one cell of the join.
CELL = 2000


#: Words of 64 bits of a parity sketch.
SKETCH = 16
_WORD = regex.compile(r"[\p{L}\p{M}\p{Nd}]+")


def sketch(tokens: np.ndarray) -> list[int]:
    """Bit b says whether an odd number of tokens falls on b: the bits in which two
    sketches differ are never more than the tokens in which the sets differ."""
    odd = np.bincount((tokens & (SKETCH * 64 - 1)).astype(np.int64), minlength=SKETCH * 64) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def shingle_sets(rows: DataFrame, key: str, text: str, words: int = 5, short: bool = False) -> DataFrame:
    """(key, class, tokens, n, sketch): hashes of the distinct runs of ``words`` consecutive words.

    A word is a maximal run of letters, marks or digits of the lower-cased text. ``class``
    is a 128-bit hash of the set. Texts of fewer words have no run and so no row; with
    ``short`` those that have a word count as one run, so that equal ones are found.
    Null texts, texts without words and rows without a key are left out.
    """
    kind = rows.schema[key].dataType.simpleString()
    schema = f"key {kind}, class binary, tokens array<long>, n int, sketch array<long>"

    def shingle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, t in zip(pdf["key"], pdf["text"]):
                w = _WORD.findall(t.lower())
                if len(w) < words:
                    if not short or not w:
                        continue
                    runs = {" ".join(["", *w])}  # equal to no run of more words
                else:
                    runs = {" ".join(w[i : i + words]) for i in range(len(w) - words + 1)}
                tokens = np.sort(np.fromiter(map(xxhash.xxh3_64_intdigest, runs), dtype=np.uint64, count=len(runs)))
                tokens = np.unique(tokens)
                out.append((k, xxhash.xxh3_128_digest(tokens.tobytes()), tokens.view(np.int64).tolist(), len(tokens), sketch(tokens)))
            yield pd.DataFrame(out, columns=["key", "class", "tokens", "n", "sketch"])

    source = rows.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null and text is not null")
    return source.mapInPandas(shingle, schema)


def _at_least(threshold: float, n: int) -> int:
    return math.ceil(threshold * n - 1e-9)


def size_buckets(threshold: float, largest: int) -> list[int]:
    """Lower ends of size buckets; partners of a set lie in its own bucket or the next."""
    ends = [1]
    while ends[-1] <= largest:
        ends.append(max(ends[-1] + 1, math.floor(ends[-1] / threshold + 1e-9) + 1))
    return ends


def class_counts(threshold: float, ends: list[int], bucket: int) -> int:
    """Number of pair classes and, as many, of triple classes in a bucket: bounded so
    that even the smallest set keeps enough tokens for its prefix (0: all single)."""
    room = _at_least(threshold, ends[max(0, bucket - 1)]) - 1
    return min(math.ceil(ends[bucket] / CLASS_TOKENS), room // 3)


def signatures(frequencies: list[int], tokens: list[int], n: int, threshold: float, classes: int, bucket: int) -> set[int]:
    """Signatures of one set in one bucket. ``tokens`` (rare first, with their document
    frequencies) lack those of frequency 1, which can match nothing but use up errors."""
    budget = n - _at_least(threshold, n) + 1 - (n - len(tokens))
    prefix: dict[tuple[int, int], list[int]] = {}
    rare: dict[int, bool] = {}
    for df, token in zip(frequencies, tokens):
        if budget <= 0:
            break
        k = 1 if df <= SINGLE_DF or not classes else 2 if df <= PAIR_DF else 3
        own = prefix.setdefault((k, token % classes if k > 1 else 0), [])
        own.append(token)
        rare[token] = df <= SINGLE_DF
        budget -= len(own) >= k
    out: set[int] = set()
    for (k, _), own in prefix.items():
        for some in combinations(own, k):
            # a rare token stands in the prefix of its record whatever the bucket
            where = -1 if k == 1 and rare[some[0]] else bucket
            out.add(xxhash.xxh3_64_intdigest(",".join(map(str, (where, *some)))) - 2**63)
    return out


def similar_sets(sets: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(a, b, similarity) of all different sets ``(key, tokens, n, sketch)`` with a Jaccard
    similarity of at least ``threshold`` (0 < threshold <= 1), a < b. Keys are unique."""
    long = sets.select("key", "n", F.explode("tokens").alias("token"))
    df = long.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = (
        long.join(df, "token")
        .groupBy("key", "n")
        .agg(F.collect_list(F.struct("df", "token")).alias("t"))
        .select("key", "n", "t.df", "t.token")
    )

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ends = [1]
        for pdf in batches:
            keys, sigs, sizes, own = [], [], [], []
            for key, n, dfs, tokens in zip(pdf["key"], pdf["n"], pdf["df"], pdf["token"]):
                if ends[-1] <= n:
                    ends = size_buckets(threshold, int(n))
                order = np.lexsort((tokens, dfs))
                dfs, tokens = dfs[order].tolist(), tokens[order].tolist()
                b = next(i for i, e in enumerate(ends) if e > n) - 1
                reach = [*ends, max(ends[-1] + 1, math.floor(ends[-1] / threshold + 1e-9) + 1)]
                mine, further = (signatures(dfs, tokens, int(n), threshold, class_counts(threshold, reach, x), x) for x in (b, b + 1))
                found = [*mine, *(further - mine)]
                keys += [key] * len(found)
                sigs += found
                sizes += [n] * len(found)
                own += [True] * len(mine) + [False] * (len(found) - len(mine))
            yield pd.DataFrame({"key": pd.Series(keys, dtype=object), "sig": pd.Series(sigs, dtype="int64"), "n": pd.Series(sizes, dtype="int32"), "own": pd.Series(own, dtype=bool)})

    kind = sets.schema["key"].dataType.simpleString()
    postings = durable(shared.mapInPandas(index, f"key {kind}, sig long, n int, own boolean"))
    # only a signature of more than CELL records is split; there are few of them
    hot = postings.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where(f"c > {CELL}").select("sig", F.ceil(F.col("c") / CELL).cast("int").alias("cells"))
    placed = (
        postings.join(hot, "sig", "left")
        .withColumn("cells", F.coalesce("cells", F.lit(1)))
        .withColumn("p", F.when(F.col("cells") > 1, F.pmod(F.xxhash64("key"), F.col("cells"))).otherwise(0).cast("int"))
    )
    left = placed.select("sig", F.col("p").alias("i"), F.explode(F.sequence("p", F.col("cells") - 1)).alias("j"), F.col("key").alias("ka"), F.col("n").alias("na"), F.col("own").alias("oa"))
    right = placed.select("sig", F.explode(F.sequence(F.lit(0), F.col("p"))).alias("i"), F.col("p").alias("j"), F.col("key").alias("kb"), F.col("n").alias("nb"), F.col("own").alias("ob"))
    candidates = (
        left.join(right, ["sig", "i", "j"])
        .where("(i < j and ka <> kb or ka < kb) and (oa or ob)")
        .where(F.least("na", "nb") >= F.greatest("na", "nb") * threshold - 1e-9)
        .select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b"))
        .distinct()
    )
    # sets of n and m tokens at the threshold differ in at most (1 - t) / (1 + t) * (n + m) tokens
    differ = sum((F.bit_count(F.get("sa", F.lit(i)).bitwiseXOR(F.get("sb", F.lit(i)))) for i in range(SKETCH)), F.lit(0))
    near = (
        candidates.join(sets.select(F.col("key").alias("a"), F.col("sketch").alias("sa"), F.col("n").alias("na")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("sketch").alias("sb"), F.col("n").alias("nb")), "b")
        .where(differ <= (1 - threshold) / (1 + threshold) * (F.col("na") + F.col("nb")) + 1e-9)
        .select("a", "b")
    )
    first = sets.select(F.col("key").alias("a"), F.col("tokens").alias("ta"))
    second = sets.select(F.col("key").alias("b"), F.col("tokens").alias("tb"))
    both = near.join(first, "a").join(second, "b")
    common = both.select("a", "b", (F.size("ta") + F.size("tb")).alias("sum"), F.size(F.array_intersect("ta", "tb")).alias("common"))
    return (
        common.withColumn("similarity", F.col("common") / (F.col("sum") - F.col("common")))
        .where(F.col("similarity") >= threshold)
        .select("a", "b", "similarity")
    )


def near_duplicates(rows: DataFrame, key: str, text: str, words: int = 5, threshold: float = 0.8, short: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members, links): every row's class of equal shingle sets, and the links between
    different classes. Copies meet in their class and are joined once, however many.

    ``members`` is (key, class), ``links`` is (a, b, similarity) of classes. ``short`` as in
    ``shingle_sets``.
    """
    sets = durable(shingle_sets(rows, key, text, words, short))
    members = sets.select("key", "class").distinct()
    classes = sets.groupBy(F.col("class").alias("key")).agg(F.first("tokens").alias("tokens"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    return members, durable(similar_sets(durable(classes), threshold))


def all_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """Links and copies as pairs of rows, the smaller key first."""
    mine = members.select(F.col("class").alias("a"), F.col("key").alias("ka"))
    theirs = members.select(F.col("class").alias("b"), F.col("key").alias("kb"))
    across = links.select("a", "b").join(mine, "a").join(theirs, "b")
    within = mine.join(theirs, F.col("a") == F.col("b"))
    pairs = across.select("ka", "kb").unionByName(within.where("ka < kb").select("ka", "kb"))
    return pairs.where("ka <> kb").select(F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b")).distinct()


def groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """One row per row that has a shingle: (key, group, copies, links).

    ``group`` is the least key of the connected component, ``copies`` the rows with
    the same set, ``links`` the number of rows with which the row has a link.
    """
    sizes = members.groupBy("class").agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("least"))
    ends = links.select(F.col("a").alias("class"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("class"), F.col("a").alias("other"))
    )
    degree = (
        ends.join(sizes.select(F.col("class").alias("other"), F.col("copies").alias("k")), "other")
        .groupBy("class")
        .agg(F.sum("k").alias("k"))
    )
    whole = connected_components(links, "a", "b").select(F.col("node").alias("class"), "component")
    named = sizes.join(whole, "class", "left").withColumn("component", F.coalesce("component", "class"))
    names = named.groupBy("component").agg(F.min("least").alias("group"))
    per_class = (
        named.join(names, "component")
        .join(degree, "class", "left")
        .select("class", "group", "copies", (F.coalesce("k", F.lit(0)) + F.col("copies") - 1).alias("links"))
    )
    return members.join(per_class, "class").select("key", "group", "copies", "links")
