from pyspark.sql import functions as F

from quire.functions import heading_rules as hr
from quire.functions import text as tx
from quire.operators import headings as hd


def test_grammar():
    assert len(hr.rules()) == 1328
    assert hr.best_rule("CHAPTER IV. THE OLD MILL") == ("desc", "whitespace", "roman_upper", "punctuation", "whitespace", "title_upper")
    assert hr.best_rule("He went home.") is None
    p = hr.parts("Chapter the Third", hr.best_rule("Chapter the Third"))
    assert (p["desc"], p["number"]) == ("Chapter the", 3)


def test_numbers(spark):
    df = spark.createDataFrame([("XIV",), ("mcmxc",), ("house",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(tx.roman_value("t")).collect()] == [14, 1990, None, None, None]
    words = spark.createDataFrame([("One Hundred and Twenty-First",), ("forty - two",), ("many",), (None,)], "t string")
    assert [r[0] for r in words.select(tx.number_word_value("t")).collect()] == [121, 42, None, None]


def paras(spark, texts, step=6):
    return spark.createDataFrame([("b", i * step if n else i, t) for i, (n, t) in enumerate(texts)], "book_id string, para_no int, text string")


def test_runs_are_kept_and_contents_are_not(spark):
    rows = [("b", 1, "CONTENTS")] + [("b", 2 + i, f"CHAPTER {r}") for i, r in enumerate(("I", "II", "III"))]
    rows += [("b", 10 + 8 * i, f"CHAPTER {r}") for i, r in enumerate(("I", "II", "III"))]
    rows += [("b", 11, "THE MILL"), ("b", 12, "It was late, and the keeper had gone home.")]
    df = spark.createDataFrame(rows, "book_id string, para_no int, text string")
    got = [(r.para_no, r.number, r.title) for r in hd.headings(df).orderBy("para_no").collect()]
    assert got == [(10, 1, "THE MILL"), (18, 2, None), (26, 3, None)]


def test_interleaved_runs(spark):
    rows = [("b", 10, "CHAPTER I"), ("b", 20, "Chapter II"), ("b", 30, "CHAPTER III"), ("b", 40, "Chapter IV"), ("b", 50, "CHAPTER V"), ("b", 60, "CHAPTER IX")]
    found = hd.number_runs(hd.match_headings(spark.createDataFrame(rows[:5], "book_id string, para_no int, text string")))
    assert hd.accepted_runs(found).count() == 2


def test_fallback_and_nulls(spark):
    rows = [("b", 1, "THE MILL"), ("b", 2, "THE POND"), ("b", 30, "THE INN"), ("b", 31, None), ("b", 32, ""), ("c", 1, "nothing here.")]
    df = spark.createDataFrame(rows, "book_id string, para_no int, text string")
    got = [(r.book_id, r.para_no, r.title) for r in hd.headings(df).orderBy("para_no").collect()]
    assert got == [("b", 1, "THE MILL\n\nTHE POND"), ("b", 30, "THE INN")]
    assert hd.headings(df.limit(0)).count() == 0


def test_capitals(spark):
    df = spark.createDataFrame([("THE MILl",), ("The Mill",), ("12",)], "t string")
    assert [r[0] for r in df.select(tx.raise_capitals("t")).collect()] == ["THE MILL", "The Mill", "12"]
    assert df.select(F.round(tx.capital_share("t"), 2)).collect()[2][0] is None


def test_transliteration_drops_no_letter(spark):
    texts = ["Привет Åsa 北京", "ひらがな", "สวัสดี", "नमस्ते", "Œuvre straße", "שלום", "Ελλάδα", "한글", "②٣", "plain", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.t for r in df.select("i", tx.transliterate("t").alias("t")).collect()}
    assert got[0] == "Privet Asa bei jing " and got[4] == "OEuvre strasse" and got[9] == "plain" and got[10] == "" and got[11] is None
    for i in range(9):
        letters = sum(c.isalnum() for c in texts[i])
        assert got[i].isascii() and sum(c.isalnum() for c in got[i]) >= letters


def test_prefilter_keeps_every_match(spark):
    texts = ["CHAPTER IV. THE OLD MILL", "(IV)", "One", "The Pond", "Кучер рисовал.\nУзкую кружку\nPage 6", "He said so.", "Two men came\nhome late.", "Twenty-First Letter", "xiv. Things", "it was", "\"THE INN\""]
    df = spark.createDataFrame([("b", i, t) for i, t in enumerate(texts)], "book_id string, para_no int, text string")
    found = {r.para_no for r in hd.match_headings(df).collect()}
    assert found == {i for i, t in enumerate(texts) if hr.best_rule(t.strip('"'))}
