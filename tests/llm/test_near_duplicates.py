import random
import re

import numpy as np
import pytest

from quire.llm import near_duplicates as nd


def brute(rows, words, threshold):
    sets = {}
    for k, t in rows:
        w = re.findall(r"\w+", (t or "").lower())
        s = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}
        if s:
            sets[k] = s
    keys = sorted(sets)
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}


def corpus(seed, n, vocabulary, length):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, max(1, len(w) // 6))):
                k = rng.randrange(len(w) + 1)
                w[k : k + rng.randint(0, 1)] = rng.choices([[], [rng.choice(vocabulary)]], k=1)[0]
            rows.append((f"k{i:03}", " ".join(w)))
        else:
            rows.append((f"k{i:03}", " ".join(rng.choices(vocabulary, k=rng.randint(0, length)))))
    return rows


@pytest.mark.parametrize("seed,vocabulary,length,words,threshold", [(1, 8, 40, 3, 0.5), (2, 300, 60, 3, 0.5), (3, 30, 80, 5, 0.8), (4, 3, 12, 1, 0.7)])
def test_equals_brute_force(spark, monkeypatch, seed, vocabulary, length, words, threshold):
    monkeypatch.setattr(nd, "SINGLE_DF", 3)
    monkeypatch.setattr(nd, "PAIR_DF", 12)
    monkeypatch.setattr(nd, "CELL", 5)
    rows = corpus(seed, 90, [f"w{i}" for i in range(vocabulary)], length) + [("n", None), ("e", ""), ("s", "one")]
    df = spark.createDataFrame(rows, "id string, t string").selectExpr("*", "1 as n", "2 as key")
    members, links = nd.near_duplicates(df, "id", "t", words, threshold)
    assert {tuple(r) for r in nd.all_pairs(members, links).collect()} == brute(rows, words, threshold)


def test_groups(spark):
    rows = [("a", "one two three four five six seven"), ("b", "one two three four five six seven"), ("c", "One, two. Three four five six seven eight"), ("d", "x y z u v w"), ("e", None)]
    df = spark.createDataFrame(rows, "id string, t string")
    got = {tuple(r) for r in nd.groups(*nd.near_duplicates(df, "id", "t", 3, 0.5)).collect()}
    assert got == {("a", "a", 2, 2), ("b", "a", 2, 2), ("c", "a", 1, 2), ("d", "d", 1, 0)}
    assert nd.groups(*nd.near_duplicates(df.limit(0), "id", "t", 3, 0.5)).count() == 0


def test_size_buckets_hold_all_partners():
    for t in (0.5, 0.8, 0.95):
        ends = nd.size_buckets(t, 500)
        bucket = lambda n: next(i for i, e in enumerate(ends) if e > n) - 1
        for n in range(1, 300):
            for m in range(n, min(499, int(n / t + 1e-9)) + 1):
                assert bucket(m) - bucket(n) in (0, 1)


def test_short_records_are_grouped_with_their_copies(spark):
    rows = [("a", "Ann Lee"), ("b", "ann  lee!"), ("c", "Ann Lee said ann lee now"), ("d", "..."), ("e", None), ("f", "Ann")]
    df = spark.createDataFrame(rows, "id string, t string")
    got = {tuple(r) for r in nd.groups(*nd.near_duplicates(df, "id", "t", short=True)).collect()}
    assert got == {("a", "a", 2, 1), ("b", "a", 2, 1), ("c", "c", 1, 0), ("f", "f", 1, 0)}


def test_sketches_never_say_more_than_the_sets():
    rng = random.Random(3)
    for _ in range(200):
        a = {rng.getrandbits(64) for _ in range(rng.randint(1, 400))}
        b = {x for x in a if rng.random() < 0.8} | {rng.getrandbits(64) for _ in range(rng.randint(1, 50))}
        sa, sb = (nd.sketch(np.fromiter(x, dtype=np.uint64)) for x in (a, b))
        assert sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(sa, sb)) <= len(a ^ b)
