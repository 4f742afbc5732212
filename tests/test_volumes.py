import math

from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators import page_features as pf
from quire.operators import segmentation as sg
from quire.operators import volumes as vo

PAGE = "book_id string, page_no int, lines array<string>"


def test_clean_line_and_similarity(spark):
    df = spark.createDataFrame([("  Глава 1. Привет, мир! ",), ("Ştefan cel Mare, 1457",), ("kitten",), ("",)], "t string")
    assert [r[0] for r in df.select(tx.clean_line("t")).collect()] == ["глава привет мир", "ştefan cel mare", "kitten", ""]
    pair = spark.createDataFrame([("kitten", "sitting"), ("raisethysword", "rosettacode"), ("", ""), ("", "abc")], "a string, b string")
    got = [r[0] for r in pair.select(tx.similarity(F.col("a"), F.col("b"))).collect()]
    assert [round(x, 3) for x in got] == [round(1 - 3 / 7, 3), round(1 - 8 / 13, 3), 1.0, 0.0]


def test_lines_end_as_in_a_file(spark):
    df = spark.createDataFrame([("a \nb\n",), ("a\n\n",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(tx.lines_of("t")).collect()] == [["a", "b"], ["a", ""], [], None]


def book(pages):
    return [("b", i + 1, lines) for i, lines in enumerate(pages)]


def test_running_headers_and_footers(spark):
    text = [["The keeper walked along the shore at night", "and nobody saw him but the widow"], ["A lantern burned behind the mill", "until the morning came at last"],
            ["Her brother counted the sacks", "in the yard of the old farm"], ["Nobody answered the door", "so they went away again in silence"]]
    pages = [["THE OLD MILL", *t, f"Page {i}"] for i, t in enumerate(text)]
    got = vo.page_structure(spark.createDataFrame(book(pages), PAGE)).orderBy("page_no").collect()
    assert [r.n_header for r in got] == [1] * 4 and [r.n_footer for r in got] == [1] * 4
    for r, page in zip(got, pages):
        assert r.header + r.body + r.footer == page


def test_page_numbers_when_no_footer_recurs(spark):
    pages = [["x" * (5 + 7 * i), "word " * (i + 1), str(i + 3)] for i in range(4)] + [["a", "b"], []]
    got = vo.page_structure(spark.createDataFrame(book(pages), PAGE)).orderBy("page_no").collect()
    assert [r.n_footer for r in got] == [1, 1, 1, 1, 0, 0]


def test_edges(spark):
    df = spark.createDataFrame(book([["12", "--", "Text 5 here", "", "9"], ["1 2"], []]), PAGE)
    got = vo.strip_unlettered(df).orderBy("page_no").collect()
    assert [(r.cut_head, r.cut_tail, r.lines) for r in got] == [(2, 2, ["Text 5 here"]), (1, 0, []), (0, 0, [])]
    many = spark.createDataFrame(book([["Title Line", "and text"], ["TITLE", "and more"], ["text only", "x"]]), PAGE)
    done = vo.if_majority(many, vo.strip_headings).orderBy("page_no").collect()
    assert all(r.applied for r in done) and [len(r.lines) for r in done] == [1, 1, 2]
    assert not vo.if_majority(many, vo.strip_headings, 0.9).first().applied
    usual = vo.strip_usual(many).orderBy("page_no").collect()
    assert [r.cut_head for r in usual] == [1, 1, 0]
    words = spark.createDataFrame([("and",), ("text",), ("more",)], "word string")
    kept = vo.strip_unknown_words(spark.createDataFrame(book([["Qzx", "and text more", "Done."], [""]]), PAGE), words).orderBy("page_no").collect()
    assert [r.lines for r in kept] == [["and text more", "Done."], []]


def test_dehyphenation(spark):
    df = spark.createDataFrame(book([["the lan-", "tern and the pa-", ""], ["", "ge went on", "to the end-"], ["ing"]]), PAGE)
    got = [r.lines for r in vo.dehyphenate(df).orderBy("page_no").collect()]
    assert got == [["the lantern", "and the page", ""], ["", "went on", "to the ending"], [""]]


def test_reparagraph(spark):
    lines = [("b", 1, "It began", False), ("b", 2, "in May.", False), ("b", 3, "Then", False), ("b", 4, "CHAPTER II", True), ("b", 5, "it rained", False)]
    got = vo.reparagraph(spark.createDataFrame(lines, "book_id string, line_no int, line string, is_header boolean")).orderBy("para_no").collect()
    assert [r.text for r in got] == ["It began in May.", "Then", "CHAPTER II", "it rained"]


def test_features(spark):
    pages = spark.createDataFrame(book([["apple", "berry", "cherry", "date", "elder", "fig", "grape"], ["zz b", "aa"], [], ["1 2 3 4 9", "iv end"]]), PAGE)
    rho = pf.alphabetical(pages).collect()
    assert [(r.page_no, r.spearman) for r in rho] == [(1, 1.0)]
    assert abs(pf._beta_tail(2.0, 10) - 0.07338803) < 1e-6 and abs(pf._beta_tail(0.5, 3) - 0.65145) < 1e-4
    rise = pf.rising_numbers(pages).collect()
    assert [(r.page_no, r.rise, r.significant) for r in rise] == [(4, 5, True)]
    assert [r.page_no for r in pf.roman_numerals(pages).where("roman_top").collect()] == [4]
    assert pf.longest_rise([5, 1, 2, 2, 3, 0]) == 3 and pf.longest_rise([]) == 0
    first = pf.position_features(pages).where("page_no = 1").first()
    assert (first.first10, first.last10, first.ratio, first.quintile) == (1, 1, 0.25, 2)
    w = pf.word_features(pages).where("page_no = 4").first()
    assert w.num_numbers == 5 and w.num_words == 6


def test_text_tiling_equals_brute_force(spark):
    pages = [["a b"], ["b c"], ["a c d"], ["d"], [""]]
    got = {r.page_no: r.cosine for r in pf.text_tiling(spark.createDataFrame(book(pages), PAGE)).collect()}
    sets = [set(" ".join(p).split()) for p in pages]
    for i in range(len(pages) - 1):
        count = lambda part: {w: sum(w in s for s in part) for w in "abcd"}
        p, s = count(sets[: i + 1]), count(sets[i + 1 :])
        norm = math.sqrt(sum(x * x for x in p.values()) * sum(x * x for x in s.values()))
        assert got[i + 1] == round(sum(p[w] * s[w] for w in p) / norm if norm else 0, 3)
    assert len(got) == 4


def test_page_sequence(spark):
    pages = [["title"], ["preface"]] + [["text", str(n)] for n in range(1, 10)]
    got = pf.page_sequence(spark.createDataFrame(book(pages), PAGE)).orderBy("page_no").collect()
    assert [r.offset for r in got] == [2] * 11 and [r.before_marked for r in got] == [True] * 2 + [False] * 9
    assert pf.page_sequence(spark.createDataFrame(book([["a"], ["b"]]), PAGE)).count() == 0


def test_label_runs_and_sections(spark):
    labels = [("b", i + 1, x) for i, x in enumerate(["title", "content", "toc", "content", "content", "index"])] + [("c", 3, "ad"), ("c", 5, None), ("d", 1, "content")]
    df = spark.createDataFrame(labels, "book_id string, page_no int, label string")
    runs = sg.label_runs(df).where("book_id = 'b'").orderBy("start").collect()
    assert [(r.start, r.end, r.label) for r in runs] == [(1, 2, "title"), (2, 3, "content"), (3, 4, "toc"), (4, 6, "content"), (6, 7, "index")]
    where = {(r.book_id, r.page_no): r.section for r in sg.sections(df).collect()}
    assert [where["b", i] for i in range(1, 7)] == ["front"] * 3 + ["body"] * 2 + ["back"]
    assert where["c", 3] == "front" and where["c", 5] == "body"


def test_model_plug_in_and_vectors(spark):
    f = spark.createDataFrame([("b", 1, "x", 2.0), ("b", 2, "x", 4.0), ("b", 2, "y", 0.0)], "book_id string, page_no int, feature string, value double")
    ids = pf.map_vocabulary(f, spark.createDataFrame([("x", 1), ("y", 0)], "term string, id int"))
    z = pf.standardise(ids, spark.createDataFrame([(1, 3.0, 1.0)], "id int, mean double, sd double"), 3)
    assert {r.page_no: r.vector for r in z.collect()} == {1: [0.0, -1.0, 0.0], 2: [0.0, 1.0, 0.0]}
    out = sg.predict_labels(z, lambda pdf: ["content" if v[1] > 0 else "title" for v in pdf["vector"]])
    assert {r.page_no: r.label for r in out.collect()} == {1: "title", 2: "content"}


def test_empty(spark):
    none = spark.createDataFrame([], PAGE)
    for f in (vo.page_structure, vo.strip_unlettered, vo.strip_usual, vo.dehyphenate, pf.text_tiling, pf.letter_features, pf.alphabetical, pf.page_sequence, pf.long_features, sg.rule_labels):
        assert f(none).count() == 0
