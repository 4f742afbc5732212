import random

from quire.llm import leaks
from quire.llm.words import plain_words


def brute(docs, items):
    grams = {}
    for i, t in items:
        w = plain_words(t)
        for k in range(len(w) - 11):
            grams.setdefault(tuple(w[k : k + 12]), set()).add(i)
    out = set()
    for d, t in docs:
        w = plain_words(t)
        for k in range(len(w) - 11):
            out |= {(d, i) for i in grams.get(tuple(w[k : k + 12]), ())}
    return out


def fixture():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["Été", "naïve", "माली", "ÉCOLE"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(5, 40)))) for i in range(30)]
    docs = []
    for d in range(400):
        words = rng.choices(vocabulary, k=rng.randint(0, 80))
        if d % 3 == 0:
            source = rng.choice(items)[1].split()
            k = rng.randint(8, 16)
            words[5:5] = [w.upper() for w in source[:k]]
        docs.append((d, rng.choice([" ", ",\n", " - "]).join(words)))
    return docs + [(500, None), (501, ""), (502, docs[0][1])], items + [(600, None), (601, "")]


def test_words():
    assert plain_words("L’Été, NAÏVE—x2_y") == ["l", "ete", "naive", "x2", "y"]
    assert plain_words("माली ने") == ["मल", "न"]
    assert plain_words(None) == []


def test_equals_brute_force_on_both_paths(spark):
    docs, items = fixture()
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as run", "2 as words")
    i = spark.createDataFrame(items, "item_id long, text string")
    want = brute([x for x in docs if x[1]], [x for x in items if x[1]])
    assert len(want) > 10
    a = leaks.find_leaks(d, i)
    b = leaks.find_leaks(d, i, max_broadcast_seeds=0)
    assert {tuple(r) for r in leaks.exact_leaks(a).collect()} == want
    assert {tuple(r) for r in leaks.exact_leaks(b).collect()} == want
    assert {(r.doc_id, r.item_id, r.run) for r in a.collect()} == {(r.doc_id, r.item_id, r.run) for r in b.collect()}


def test_substitutions_are_tolerated(spark):
    words = [f"t{i}" for i in range(40)]
    changed = [("zz" if i % 9 == 8 else w) for i, w in enumerate(words)]
    d = spark.createDataFrame([(1, " ".join(changed))], "doc_id long, text string")
    i = spark.createDataFrame([(9, " ".join(words))], "item_id long, text string")
    row = leaks.tolerant_leaks(leaks.find_leaks(d, i)).collect()[0]
    assert row.run == 8 and row.matched == 36 and row.substituted == 4
    assert leaks.exact_leaks(leaks.find_leaks(d, i)).count() == 0


def test_empty(spark):
    docs, items = fixture()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    assert leaks.find_leaks(d.limit(0), i).count() == 0
    assert leaks.find_leaks(d, i.limit(0)).count() == 0


def test_short_items_are_never_gathered(spark):
    items = spark.createDataFrame([(i, "a b c d e f g h") for i in range(50)] + [(99, " ".join(f"t{k}" for k in range(12)))], "item_id long, text string")
    assert [r.item_id for r in leaks.item_words(items).collect()] == [99]
