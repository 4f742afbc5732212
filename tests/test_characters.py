"""Names and genders of characters, against plain searches."""

import random

from quire.operators import annotation as an
from quire.operators import characters as ch

SCHEMA = "book_id string, tok_num int, honorific string, generic_name string, first_name string, last_name string, gender_honorific string, gender_coref string, gender_name string"


def nearest(at, refs, holds):
    """The last reference before, else the first one after, for which a condition holds."""
    fit = [r for r in refs if holds(r)]
    return max((r for r in fit if r[0] < at), default=None) or min((r for r in fit if r[0] > at), default=None)


def best(at, own, refs):
    """Plain search for the reference (tok, honorific, coref, name) that suits a mention."""
    conditions = []
    for g in own:
        if g:
            conditions += [lambda r, g=g: r[1] == g, lambda r, g=g: r[2] == g and r[1] in (None, g), lambda r, g=g: r[3] == g and r[1] in (None, g) and r[2] in (None, g)]
    top = next((g for g in own if g), None)
    if top:
        conditions += [lambda r: r[1] == top, lambda r: r[2] == top, lambda r: r[3] == top, lambda r: all(x in (None, top) for x in r[1:])]
    else:
        conditions.append(lambda r: True)
    return next((hit for c in conditions if (hit := nearest(at, refs, c))), None)


def test_tiers_equal_a_plain_search(spark):
    rng = random.Random(9)
    sex = lambda: rng.choice([None, "male", "female"])
    rows, want = [], {}
    for b in range(30):
        book, refs, asks = f"b{b}", [], []
        for at in rng.sample(range(100), 14):
            if rng.random() < 0.5:
                h, c, n = sex(), sex(), sex()
                if h and n and h != n:
                    n = None
                first = rng.choice(["John", "Ann"])
                rows.append((book, at, None, None, first, "Reed", h, c, n))
                refs.append((at, h, c, n, first))
            else:
                own = sex(), sex(), sex()
                rows.append((book, at, None, "Reed", None, None, *own))
                asks.append((at, own))
        names = [r[4] for r in refs]
        refs = [r[:4] for r in refs if names.count(r[4]) > 1]
        want |= {(book, at): (hit[0] if (hit := best(at, own, refs)) else None) for at, own in asks}
    df = spark.createDataFrame(rows, SCHEMA)
    assert {(r.book_id, r.tok_num): r.hit_tok for r in ch.resolve_generic(df).collect()} == want


def test_mrs_goes_to_the_wife_and_genders_go_back(spark):
    rows = [
        ("b", 1, "Mr.", None, "John", "Wilson", "male", None, "male"), ("b", 3, None, None, "John", "Wilson", None, None, "male"),
        ("b", 5, "Mrs", None, "John", "Wilson", "female", None, "male"), ("b", 9, "mrs", "Wilson", None, None, "female", None, None),
        ("c", 1, None, None, "Kim", "Tull", None, None, None), ("c", 4, None, None, "Kim", "Tull", None, None, None), ("c", 5, "Miss", "Tull", None, None, "female", None, None),
    ]
    named = spark.createDataFrame(rows, SCHEMA)
    resolved = ch.resolve_generic(named)
    assert {(r.book_id, r.tok_num): (r.hit_tok, r.first_name) for r in resolved.collect()} == {("b", 9): (5, "John"), ("c", 5): (4, "Kim")}
    back = {(r.book_id, r.tok_num): r.gender_honorific for r in ch.pass_genders_back(named, resolved).collect()}
    assert back["c", 4] == "female" and back["c", 1] is None and back["b", 3] is None


def test_references_follow_chains(spark):
    words = "Ann Reed met John Poe and he saw her while he his and she".split()
    tokens = spark.createDataFrame([("b", i, w) for i, w in enumerate(words)], "book_id string, tok_num int, word string")
    people = spark.createDataFrame([("b", 0, 1, "Ann Reed"), ("b", 3, 4, "John Poe")], "book_id string, start_tok int, end_tok int, phrase string")
    chains = [("b", "1", 0, 1), ("b", "1", 8, 8), ("b", "1", 13, 13), ("b", "2", 3, 4), ("b", "2", 6, 6), ("b", "2", 10, 10), ("b", "2", 11, 11)]
    coref = an.antecedents(spark.createDataFrame(chains, "book_id string, chain string, start_tok int, end_tok int"))
    got = {(r.tok_num, r.kind, r.phrase) for r in ch.chain_references(coref, people, tokens).collect()}
    # two pronouns in a row are one phrase and none
    assert got == {(8, "female", "Ann Reed"), (13, "female", "Ann Reed"), (6, "male", "John Poe")}
    # a phrase that holds another person hands what follows over
    chains = [("b", "1", 0, 1), ("b", "1", 3, 3), ("b", "1", 13, 13)]
    coref = an.antecedents(spark.createDataFrame(chains, "book_id string, chain string, start_tok int, end_tok int"))
    assert [(r.tok_num, r.phrase) for r in ch.chain_references(coref, people, tokens).collect()] == [(13, "John Poe")]


def test_empty_tables(spark):
    assert ch.resolve_generic(spark.createDataFrame([], SCHEMA)).count() == 0
    entities = spark.createDataFrame([], "book_id string, start_tok_num int, end_tok_num int, phrase string, ner string")
    tokens = spark.createDataFrame([], "book_id string, tok_num_in_doc int, word string")
    assert ch.characters(entities, tokens).count() == 0
