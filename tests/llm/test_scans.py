import random

from quire.llm import scans

WORDS = "lantern harbour widow crossed bridge quiet watched brother keeper meadow market candle stairway garden window orchard behind beyond under slowly".split()


def volume():
    """Pages of a book with known furniture, broken words and misreadings."""
    rng = random.Random(8)
    pages, truth = [], set()
    for no in range(1, 41):
        lines = []
        if no % 2:
            lines.append(f"{no}    THE OLD LANTERN OF HOLM")
            truth.add((no, len(lines), "furniture"))
        for i in range(20):
            words = [rng.choice(WORDS) for _ in range(7)]
            if i % 6 == 0:
                lines.append("")
                words[0] = words[0].capitalize()
            if i == 9 and no % 4 == 0:
                k = rng.randrange(1, 7)
                words[k] = words[k].replace("d", "cl", 1) if "d" in words[k] else words[k][:2] + "•" + words[k][2:]
                truth.add((no, len(lines) + 1, "glyph"))
            if i == 12 and no % 3 == 0:
                w = words[-1]
                words[-1] = w[:3] + "-"
                lines.append("    " + " ".join(words) if i % 6 == 0 else " ".join(words))
                truth.add((no, len(lines), "hyphen"))
                lines.append(w[3:] + " " + " ".join(rng.choice(WORDS) for _ in range(6)) + ".")
                continue
            lines.append(" ".join(words) + ("." if i % 6 == 5 else ""))
        header = footer = None
        if no % 2 == 0:
            header = "THE OLD LANTERN OF HOLM"
            if no % 10 == 0:
                header += "\n" + " ".join(rng.choice(WORDS) for _ in range(8))  # unlike any other page's
                truth.add((no, 2, "stray_header"))
        if no % 5:
            lines.append(f"[{no}]")
            truth.add((no, len(lines), "furniture"))
        else:
            footer = str(no)
        pages.append((no, "b.1", no, header, "\n".join(lines), footer))
    return pages, truth


SCHEMA = "page_id long, book_id string, page_no int, page_header string, page_body string, page_footer string"


def test_planted_cases_are_found(spark):
    pages, truth = volume()
    pages += [(900, "b.1", 50, None, None, None), (901, "b.1", 51, None, "", ""), (902, None, None, None, "A line of text.", None), pages[3]]
    df = spark.createDataFrame(pages, SCHEMA).selectExpr("*", "1 as seq", "2 as label")
    found = {tuple(r) for r in scans.findings(df).collect()}
    found = {x for x in found if x[0] < 900}
    assert len(found & truth) / len(truth) > 0.95
    assert len(found & truth) / len(found) > 0.95


def test_compounds_keep_their_hyphen(spark):
    body = "the well-known widow and the well-known keeper saw a lantern there\nagain the well-\nknown bridge and a lan-\ntern of the well-known garden here"
    df = spark.createDataFrame([(1, "b", 1, None, body, None)], SCHEMA)
    _, broken, _ = scans.repair(df)
    got = {(r.half, r.rest): r.broken for r in broken.collect()}
    assert got == {("well", "known"): False, ("lan", "tern"): True}


def test_words_broken_at_a_page_end_without_a_next_page(spark):
    pages = [
        (1, "b", 1, None, "a widow crossed the quiet meadow and saw the lan-", None),
        (2, "b", 2, None, "", None),  # a blank page, then a missing number
        (3, "b", 4, None, "tern of the keeper beyond the orchard and the har-", None),
        (4, "c", 1, None, "the keeper went well beyond the meadow and it was well-", None),
        (5, "d", None, None, "the brother watched behind the window and the or¬", None),
        (6, "d", 2, None, "chard was quiet and a brother came to the mar-\n  [8]\nket of the keeper and nobody watched it or the har-", None),
        (7, "d", 4, None, "bour was not here, as the keeper said to a widow.", None),
    ]
    df = spark.createDataFrame(pages, SCHEMA)
    _, broken, _ = scans.repair(df)
    got = {(r.page_id, r.half, r.rest): r.broken for r in broken.collect()}
    assert got == {(1, "lan", "tern"): True, (3, "har", None): True, (4, "well", None): False, (5, "or", None): True, (6, "mar", "ket"): True, (6, "har", "bour"): True}
    assert {(r.page_id, r.line_no) for r in scans.findings(df).where("kind = 'hyphen'").collect()} == {(1, 1), (3, 1), (5, 1), (6, 1), (6, 3)}
    texts = " | ".join(r.text for r in scans.paragraphs(df).collect())
    assert "the lantern of" in texts and "the har-" not in texts and "was well-" in texts and "the harbour was" in texts


def test_paragraphs_join_lines_and_pages(spark):
    pages = [
        (1, "b", 1, "HEAD", "    The first paragraph of this book ends on the next pa-", "1"),
        (2, "b", 2, "HEAD", "ge and not here, as one might have thought at first.\n    A second one begins in the middle of the page here.", "2"),
    ]
    df = spark.createDataFrame(pages, SCHEMA)
    out = scans.paragraphs(df).orderBy("page_id", "first_line").collect()
    assert [r.text for r in out] == [
        "The first paragraph of this book ends on the next page and not here, as one might have thought at first.",
        "A second one begins in the middle of the page here.",
    ]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert scans.findings(df).count() == 0 and scans.paragraphs(df).count() == 0


def test_misreadings_spare_plurals_and_common_neighbours(spark):
    words = ["ladder"] * 60 + ["ladders"] * 3 + ["ladcler"] + ["garden"] * 40 + ["garclen"] + ["shadow"] * 30 + ["shaclow"] + ["this"] * 5 + ["the"] * 90
    df = spark.createDataFrame([(w,) for w in words], "word string").groupBy("word").count().withColumnRenamed("count", "n")
    assert {(r.word, r.meant) for r in scans.misreadings(df).collect()} == {("ladcler", "ladder"), ("garclen", "garden"), ("shaclow", "shadow")}


def test_signs_inside_words_need_no_frequent_spelling_and_signs_at_ends_may_belong(spark):
    counts = {"spaniels": 2, "spanie1s": 1, "of": 40, "0f": 2, "no": 900, "n°": 60}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {(r.word, r.meant) for r in scans.misreadings(df).collect()} == {("spanie1s", "spaniels"), ("0f", "of")}


def test_a_third_furniture_line_at_the_top_is_found(spark):
    rng = random.Random(5)
    pages = []
    for no in range(1, 31):
        lines = [str(no), "THE OLD LANTERN OF HOLM", "HARBOUR LIBRARY, EAST WING"]
        lines += ["    " * (i % 6 == 0) + " ".join(rng.choice(WORDS) for _ in range(7)) for i in range(18)]
        pages.append((no, "b", no, None, "\n".join(lines), None))
    found = {tuple(r) for r in scans.findings(spark.createDataFrame(pages, SCHEMA)).where("kind = 'furniture'").collect()}
    assert len(found & {(no, i, "furniture") for no in range(1, 31) for i in (1, 2, 3)}) > 85 and len(found) <= 90


def test_a_page_delivered_twice_gives_its_text_once(spark):
    first = "    The first paragraph of this book ends on the next pa-"
    second = "ge and not here, as one might have thought at first.\n    A second one begins in the middle of the page here."
    pages = [(1, "b", 1, None, first, None), (2, "b", 2, None, second, None), (3, "b", 1, None, first, None), (4, "b", 2, None, second, None), (5, None, 1, None, first, None)]
    out = scans.paragraphs(spark.createDataFrame(pages, SCHEMA)).collect()
    texts = {(r.page_id, r.first_line): r.text for r in out if r.text}
    assert texts == {
        (1, 1): "The first paragraph of this book ends on the next page and not here, as one might have thought at first.",
        (2, 2): "A second one begins in the middle of the page here.",
        (5, 1): "The first paragraph of this book ends on the next pa",
    }
    assert {(r.page_id, r.copy_of) for r in out if r.copy_of} == {(3, 1), (4, 2)}
    assert all(r.copy_of is None for r in out if r.page_id == 5)


def test_a_broken_word_and_a_paragraph_go_on_over_blocks_of_numbers(spark):
    edge = scans.BLOCK
    pages = [(1, "b", edge - 1, None, "    The keeper of the harbour saw a lan-", None), (2, "b", edge, None, "tern beyond the orchard and the mea-", None), (3, "b", 3 * edge, None, "dow was quiet.", None)]
    out = scans.paragraphs(spark.createDataFrame(pages, SCHEMA)).collect()
    assert [r.text for r in out] == ["The keeper of the harbour saw a lantern beyond the orchard and the meadow was quiet."]


def test_joins_give_the_same_as_sending_what_is_learnt(spark):
    pages, _ = volume()
    df = spark.createDataFrame(pages, SCHEMA)
    assert sorted(map(tuple, scans.findings(df).collect())) == sorted(map(tuple, scans.findings(df, max_learnt=0).collect()))
    assert sorted(map(str, scans.paragraphs(df).collect())) == sorted(map(str, scans.paragraphs(df, max_learnt=0).collect()))
