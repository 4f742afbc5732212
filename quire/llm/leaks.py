"""Evaluation texts leaking into training text: spaced-seed hashing.

A seed is a fixed mask over ``SPAN`` consecutive words that ignores some of them.
Any run of ``SPAN`` equal words agrees under every mask; a run with substituted
words still agrees wherever the substitutions fall on ignored places. Hits give
diagonals (document, item, offset), and each diagonal is verified over its whole
length, exactly and with substitutions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.words import hash_words, plain_words
from quire.runtime import durable

#: 1 = compared, 0 = ignored. All have span 12, so none misses a run of 12 equal words.
MASKS: tuple[str, ...] = ("110110110111", "111011011011", "101101111011")
SPAN = 12
#: Up to so many seeds (16 bytes each), and a third as many words, the test side is broadcast;
#: beyond, seeds are joined by shuffle.
MAX_BROADCAST_SEEDS = 4_000_000
#: Bits (as a power of two) of the sieve that keeps other seeds of documents from that shuffle.
SIEVE = 27

_MULTIPLIERS = np.random.default_rng(20_240_607).integers(1, 2**63, size=(len(MASKS), SPAN), dtype=np.uint64) * 2 + 1


def seed_hashes(hashes: np.ndarray) -> np.ndarray:
    """Array (mask, position) of the seeds that begin at each word."""
    n = len(hashes) - SPAN + 1
    if n <= 0:
        return np.zeros((len(MASKS), 0), dtype=np.uint64)
    out = np.zeros((len(MASKS), n), dtype=np.uint64)
    for m, mask in enumerate(MASKS):
        for i, sign in enumerate(mask):
            if sign == "1":
                out[m] += hashes[i : i + n] * _MULTIPLIERS[m, i]
        out[m] ^= out[m] >> np.uint64(29)
    return out


def compare(doc: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int, int, int]:
    """Along one diagonal (doc position minus item position): longest exact run, and
    of the best substitution-tolerant stretch (a match counts 1, a substitution -3)
    its matches, substitutions and first word in document and item."""
    a, b = max(0, diagonal), max(0, -diagonal)
    n = min(len(doc) - a, len(item) - b)
    if n <= 0:
        return 0, 0, 0, 0, 0
    same = doc[a : a + n] == item[b : b + n]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    runs = edges[1::2] - edges[::2]
    if not len(runs):
        return 0, 0, 0, a, b
    total = np.concatenate(([0], np.cumsum(np.where(same, 1, -3))))
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    begin = int(np.flatnonzero(total[: end + 1] == low[end])[0])
    hits = int(same[begin:end].sum())
    return int(runs.max()), hits, end - begin - hits, a + begin, b + begin


_FOUND = "doc_id long, item_id long, run int, matched int, substituted int, doc_word int, item_word int, item_words int"


def _best(rows: list[tuple]) -> list[tuple]:
    """One row per document and item: longest run and best stretch over its diagonals."""
    best: dict[tuple, list] = {}
    for doc, item, run, hits, subs, dw, iw, n in rows:
        now = best.get((doc, item))
        if now is None:
            best[doc, item] = [doc, item, run, hits, subs, dw, iw, n]
            continue
        now[2] = max(now[2], run)
        if (hits - 3 * subs, -dw) > (now[3] - 3 * now[4], -now[5]):
            now[3:7] = hits, subs, dw, iw
    return [tuple(x) for x in best.values()]


def item_words(items: DataFrame) -> DataFrame:
    """item_id with the hashes of its words (as signed longs). Rows without an id and items
    of fewer words than a seed spans, which can match nothing, are left out; an id that
    occurs twice keeps both texts."""

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame(
                {"item_id": pdf["item_id"], "words": [hash_words(plain_words(t)).view(np.int64) for t in pdf["text"]]}
            )

    source = items.select("item_id", "text").where("item_id is not null and text is not null")
    return source.mapInPandas(tokenise, "item_id long, words array<long>").where(F.size("words") >= SPAN)


def _broadcast_search(docs: DataFrame, pairs: list[tuple[int, np.ndarray]]) -> DataFrame:
    texts = [w for _, w in pairs]
    ids = np.array([i for i, _ in pairs], dtype=np.int64)
    seeds = [seed_hashes(w) for w in texts]
    keys, owner, place = [], [], []
    for k, s in enumerate(seeds):
        for m in range(len(MASKS)):
            keys.append(s[m])
            owner.append(np.full(s.shape[1], k, dtype=np.int32))
            place.append(np.arange(s.shape[1], dtype=np.int32))
    flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
    order = np.argsort(flat, kind="stable")
    sent = docs.sparkSession.sparkContext.broadcast(
        (flat[order], np.concatenate(owner)[order] if keys else None, np.concatenate(place)[order] if keys else None, texts, ids)
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, owner, place, texts, ids = sent.value
        # a 24-bit filter keeps the binary search to the few positions that may hit
        sieve = np.zeros(1 << 24, dtype=bool)
        sieve[(keys >> np.uint64(40)).astype(np.int64)] = True
        for pdf in batches:
            lists = [plain_words(t) for t in pdf["text"]]
            hashes = hash_words([w for words in lists for w in words])
            ends = np.cumsum([len(words) for words in lists])
            starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            found = seed_hashes(hashes)
            diagonals: set[tuple[int, int, int]] = set()
            for m in range(len(MASKS)):
                maybe = np.flatnonzero(sieve[(found[m] >> np.uint64(40)).astype(np.int64)])
                if not len(maybe):
                    continue
                at = np.searchsorted(keys, found[m][maybe])
                last = np.searchsorted(keys, found[m][maybe], side="right")
                for p, a, b in zip(maybe[last > at], at[last > at], last[last > at]):
                    d = int(np.searchsorted(ends, p, side="right"))
                    if p + SPAN <= ends[d]:
                        for x in range(a, b):
                            diagonals.add((d, int(owner[x]), int(p - starts[d] - place[x])))
            rows = []
            for d, k, diagonal in diagonals:
                own = hashes[starts[d] : ends[d]]
                rows.append((int(pdf["doc_id"].iloc[d]), int(ids[k]), *compare(own, texts[k], diagonal), len(texts[k])))
            yield pd.DataFrame(_best(rows), columns=[c.split()[0] for c in _FOUND.split(", ")])

    return docs.mapInPandas(search, _FOUND)


def _seed_rows(table: DataFrame, key: str, sieve=None) -> DataFrame:
    """Exploded seeds (key, seed, at) of a table of word hashes, those that pass the sieve."""

    def seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        passing = np.unpackbits(sieve.value).astype(bool) if sieve is not None else None
        for pdf in batches:
            for k, words in zip(pdf[key], pdf["words"]):
                found = seed_hashes(np.asarray(words, dtype=np.int64).view(np.uint64))
                n = found.shape[1]
                flat, at = found.reshape(-1), np.tile(np.arange(n, dtype=np.int32), len(MASKS))
                if passing is not None:
                    keep = passing[(flat >> np.uint64(64 - SIEVE)).astype(np.int64)]
                    flat, at = flat[keep], at[keep]
                yield pd.DataFrame({key: np.full(len(flat), k), "seed": flat.view(np.int64), "at": at})

    return table.mapInPandas(seeds, f"{key} long, seed long, at int")


def _sieve(seeds: DataFrame) -> np.ndarray:
    """Bits set at the leading bits of all seeds; the same size whatever their number."""
    place = F.shiftrightunsigned("seed", 64 - SIEVE)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    rows = seeds.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toPandas()
    out = np.zeros(1 << (SIEVE - 6), dtype=np.int64)
    out[rows["at"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64)
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def _shuffle_search(docs: DataFrame, words: DataFrame) -> DataFrame:
    """The same search for test collections too large to broadcast.

    A sieve of all item seeds drops nearly every other seed of a document before the
    shuffle; diagonals are made distinct before either text is fetched. AQE splits seeds
    that many rows share.
    """

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame(
                {"doc_id": pdf["doc_id"], "words": [hash_words(plain_words(t)).view(np.int64) for t in pdf["text"]]}
            )

    texts = docs.mapInPandas(tokenise, "doc_id long, words array<long>").withColumn("_row", F.xxhash64("doc_id", "words"))
    theirs = words.withColumn("_item", F.xxhash64("item_id", "words"))
    right = durable(_seed_rows(theirs.select("_item", "words"), "_item").withColumnRenamed("at", "item_at"))
    sieve = docs.sparkSession.sparkContext.broadcast(np.packbits(_sieve(right)))
    left = _seed_rows(texts.select("_row", "words"), "_row", sieve).withColumnRenamed("at", "doc_at")
    lines = left.join(right, "seed").select("_row", "_item", (F.col("doc_at") - F.col("item_at")).alias("line")).distinct()
    both = lines.join(texts.dropDuplicates(["_row"]), "_row").join(
        theirs.dropDuplicates(["_item"]).select("_item", "item_id", F.col("words").alias("item_text")), "_item"
    )

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (d, i, *compare(np.asarray(a), np.asarray(b), line), len(b))
                for d, i, a, b, line in zip(pdf["doc_id"], pdf["item_id"], pdf["words"], pdf["item_text"], pdf["line"])
            ]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _FOUND.split(", ")])

    return both.drop("_row", "_item").mapInPandas(verify, _FOUND)


def find_leaks(docs: DataFrame, items: DataFrame, max_broadcast_seeds: int = MAX_BROADCAST_SEEDS) -> DataFrame:
    """Every (document, item) with a seed hit, verified: one row per pair.

    ``run`` is the longest run of equal consecutive words; ``matched`` and
    ``substituted`` describe the best stretch that tolerates substitutions;
    ``doc_word`` and ``item_word`` (from 1) say where it begins. Null and empty
    texts have no words; repeated documents are each reported under their id.
    """
    docs = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    words = item_words(items)
    n_words = words.agg(F.sum(F.size("words").cast("long"))).first()[0] or 0
    if n_words * len(MASKS) <= max_broadcast_seeds:  # no more seeds than that either
        pairs = [(r["item_id"], np.array(r["words"], dtype=np.int64).view(np.uint64)) for r in words.collect()]
        found = _broadcast_search(docs, pairs)
    else:
        found = _shuffle_search(docs, words)
    # ids that occur on several rows, or diagonals verified apart, meet here
    best = F.struct(
        (F.col("matched") - 3 * F.col("substituted")).alias("score"),
        (-F.col("doc_word")).alias("first"),
        "matched",
        "substituted",
        "doc_word",
        "item_word",
        "item_words",
    )
    return (
        found.groupBy("doc_id", "item_id")
        .agg(F.max("run").alias("run"), F.max(best).alias("best"))
        .select(
            "doc_id",
            "item_id",
            "run",
            F.col("best.matched").alias("matched"),
            F.col("best.substituted").alias("substituted"),
            (F.col("best.doc_word") + 1).alias("doc_word"),
            (F.col("best.item_word") + 1).alias("item_word"),
            F.col("best.item_words").alias("item_words"),
        )
    )


def exact_leaks(found: DataFrame, words: int = SPAN) -> DataFrame:
    """Pairs with at least ``words`` equal consecutive words."""
    return found.where(F.col("run") >= words).select("doc_id", "item_id")


def tolerant_leaks(found: DataFrame, matched: int = SPAN) -> DataFrame:
    """Pairs whose best stretch holds at least ``matched`` equal words, substitutions allowed,
    with the part of the item that leaked."""
    return found.where(F.col("matched") >= matched).withColumn("leaked", F.col("matched") / F.col("item_words"))
