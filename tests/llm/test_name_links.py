import random

from quire.llm import name_links as nl
from quire.llm import names as nm


def osa(a, b):
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_trie_equals_pairwise_distances():
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(150)})
    trie = nl.Trie(words)
    for w in words[:60]:
        for most in (0, 1, 2):
            assert sorted(trie.within(w, most)) == sorted((v, osa(w, v)) for v in words if osa(w, v) <= most)


def test_neighbours_in_shards(spark):
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abcd", k=rng.randint(3, 10))) for _ in range(80)})
    df = spark.createDataFrame([(b, w) for b in ("x", "y") for w in words], "book string, word string")
    want = {(b, u, v, osa(u, v)) for b in "xy" for u in words for v in words if osa(u, v) <= min(nl.bound(len(u)), nl.bound(len(v)))}
    assert {tuple(r) for r in nl.neighbours(df, cell=7).collect()} == want


def test_readings():
    assert nm.read_name("Mrs. Harriet L. Zelfelstone")[0] == nm.Form("full", "zelfelstone", "harriet", "l", "mrs", "female")
    assert nm.read_name("Yarsocombe, Robert")[0][:3] == ("full", "yarsocombe", "robert")
    assert nm.read_name("Mr. A. Fairwenmere")[0][:3] == ("initial", "fairwenmere", "a")
    assert nm.read_name("Bank of Thurverham")[0][:3] == nm.read_name("The Thurverham Bank, Ltd.")[0][:3]
    assert nm.read_name("the iron nurse")[0].kind == "figure"
    assert nm.read_name(None) == nm.read_name(" . ") == []


ROWS = [
    (1, "b", "Harriet", "Zelfelstone", None, "female", ["Harriet Zelfelstone"]),
    (2, "b", "Zelfelstone", "Harriet", None, "female", None),
    (3, "b", "H.", "Zelfelstone", None, "female", []),
    (4, "b", "Hattie", "Zelfelstnoe", None, None, None),
    (5, "b", None, None, "Miss Harriet Zelfelstone", "female", None),
    (6, "b", "Henry", "Zelfelstone", None, "male", None),
    (7, "b", "Harriet", "Morkenby", None, "female", None),
    (8, "c", "Harriet", "Zelfelstone", None, "female", None),
    (9, "b", None, None, "Corwenwell & Sons", None, None),
    (10, "b", None, None, "Messrs. Corenwell & Sons", None, None),
    (11, "b", None, None, "Corwenwell Company", None, None),
    (12, "b", None, None, "the Colonel", "female", ["the Colonel", "Colonel Harriet Morkenby"]),
    (13, "b", None, None, None, None, None),
    (14, None, "Harriet", "Zelfelstone", None, None, None),
    (15, "b", "", "  ", None, None, None),
]
SCHEMA = "char_uid long, book_id string, first_name string, last_name string, generic_name string, gender string, keys array<string>"


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "map_from_arrays(keys, transform(keys, x -> 1)) as names", "1 as s", "2 as book")


def test_links(spark):
    linked = nl.link_names(frame(spark, ROWS))
    pairs = {tuple(r) for r in nl.entity_pairs(linked).collect()}
    who = [{1, 2, 3, 4, 5}, {7, 12}, {9, 10}]
    assert pairs == {(a, b) for g in who for a in g for b in g if a < b}
    rows = {r.uid: r.links for r in nl.entity_groups(linked).collect()}
    assert rows[1] == 4 and rows[6] == 0 and 13 not in rows and 14 not in rows


def test_ambiguous_initials_join_nobody(spark):
    rows = [(1, "b", "Harriet", "Quillon", None, None, None), (2, "b", "Henry", "Quillon", None, None, None), (3, "b", "H.", "Quillon", None, None, None)]
    assert nl.entity_pairs(nl.link_names(frame(spark, rows))).count() == 0
    assert nl.link_names(frame(spark, rows).limit(0)).count() == 0


def test_names_of_three_letters_and_single_names_are_linked(spark):
    rows = [
        (1, "b", "Ann", "Lee", None, None, None), (2, "b", "Ann", "Lea", None, None, None),
        (3, "b", None, None, "Elizabeth", None, None), (4, "b", "Elizabeth", None, None, None, None), (5, "b", None, "Elizabteh", None, None, None),
        (6, "c", "Jay", "Gatsby", None, None, None), (7, "c", None, "Gatsby", None, None, None), (8, "c", "Jay", None, None, None, None),
        (9, "d", "Emma", "Bennet", None, None, None), (10, "d", "Jane", "Bennet", None, None, None), (11, "d", None, "Bennet", None, None, None), (12, "d", None, "Benet", None, None, None),
    ]
    pairs = {tuple(r) for r in nl.entity_pairs(nl.link_names(frame(spark, rows))).collect()}
    assert pairs == {(1, 2), (3, 4), (3, 5), (4, 5), (6, 7), (6, 8), (7, 8), (11, 12)}


def test_nicknames_are_the_callers(spark):
    rows = [(1, "b", "Aleksandr", "Quillon", None, None, None), (2, "b", "Sasha", "Quillon", None, None, None)]
    assert nl.entity_pairs(nl.link_names(frame(spark, rows))).count() == 0
    assert nl.entity_pairs(nl.link_names(frame(spark, rows), {"sasha": ("aleksandr", "aleksandra")})).count() == 1


def test_large_books_are_linked_like_small_ones(spark):
    rng = random.Random(6)
    first, last = ["Harriet", "Henry", "Hattie", "Ann", "Aleksandr", "Jay"], ["Quillon", "Quilon", "Lee", "Lea", "Morkenby", "Gatsby"]
    rows = list(ROWS)
    for i in range(100, 400):
        f, g = rng.choice(first), rng.choice(last)
        own = rng.choice([(f, g, None), (g, f, None), (f[0] + ".", g, None), (None, None, f"Mrs. {g}"), (f, None, None), (None, g, None), (None, None, f"{g} & Sons"), (None, None, "the old nurse"), (f, f"L. {g}", None)])
        rows.append((i, rng.choice("defgh"), *own, rng.choice([None, "male", "female"]), None))
    df = frame(spark, rows)

    def groups(most):
        out = {}
        for r in nl.link_names(df, most=most).collect():
            out.setdefault((r.book, r.entity), set()).add(r.uid)
        return sorted(map(sorted, out.values()))

    assert groups(5000) == groups(0)
