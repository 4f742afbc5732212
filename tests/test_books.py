import io
import zipfile

from quire.operators import annotation as an
from quire.operators import characters as ch
from quire.operators import markup as mk
from quire.sources import books
from quire.streaming import ingest


def test_notices():
    lines = ["*** START OF THE BOOK", "", "Produced by someone", "", "CHAPTER I", "", "Text.", "", "*** END OF THE BOOK", "tail"]
    # the block right behind the first kept (blank) line is passed over with the notice
    assert mk.text_span(lines) == (6, 7)
    assert mk.text_span([]) == (0, 0) and mk.text_span(["", "one", ""])[1] == 2


def test_notices_of_a_collection():
    credit = ["Some title", "", "images generously made available by a library", "", "", "CHAPTER I", "", "Text."]
    assert mk.text_span(credit) == (5, 8) and mk.text_span(credit, mk.Notices(credits=None)) == (0, 8)
    own = mk.Notices(starts=("HERE IT BEGINS",), ends=("HERE IT STOPS",))
    assert mk.text_span(["x", "HERE IT BEGINS", "", "", "Text.", "HERE IT STOPS", "y"], own) == (4, 5)
    paired = ["at the University of", "Florida", "", "", "Text."]
    assert mk.text_span(paired)[0] == 4


def test_spans_never_overlap():
    text = "a _b c_ and *bold words* [Illustration: _x y_] =on e= end\n * * *\n"
    spans = mk.select_spans(text)
    assert [s[2] for s in spans] == ["italic", "bold2", "illustration", "bold", "star_sep"]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_paragraphs_and_regions(spark):
    df = spark.createDataFrame([("b", "One _two words_.\n\nNext\n* * *\nLast."), ("n", None), ("e", "")], "book_id string, body string")
    got = [(r.para_no, r.text.strip(), r.star) for r in mk.paragraphs(df).orderBy("para_no").collect()]
    assert got == [(1, "One two words.", False), (2, "Next", False), (3, "* * *", True), (4, "Last.", False)]
    rows = [("b", 1, "front", False), ("b", 2, "CHAPTER I", True), ("b", 3, "x", False), ("b", 4, "The End.", False), ("b", 5, "y", False), ("c", 1, "z", False)]
    paras = spark.createDataFrame(rows, "book_id string, para_no int, text string, is_header boolean")
    where = {(r.book_id, r.para_no): r.region for r in mk.regions(paras).collect()}
    assert [where["b", i] for i in range(1, 6)] == ["front", "body", "body", "back", "back"] and where["c", 1] == "body"
    nested = {(r.book_id, r.para_no): r.header_no for r in mk.nest(paras).collect()}
    assert nested["b", 0] == 1 and nested["b", 3] == 2


def test_overlaps(spark):
    spans = [("b", 0, 3), ("b", 2, 5), ("b", 4, 6), ("b", 4, 4), ("b", 9, 9), ("b", 9, 9)]
    df = spark.createDataFrame(spans, "book_id string, start_tok int, end_tok int")
    got = sorted((r.start_tok, r.end_tok) for r in an.resolve_overlaps(df, ["book_id"], "start_tok", "end_tok").collect())
    assert got == [(0, 3), (4, 6), (9, 9)]


def test_phrases_and_names(spark):
    words = "Mr. John Reed met John Reed , he said".split()
    tokens = spark.createDataFrame([("b", i, w) for i, w in enumerate(words)], "book_id string, tok_num int, word string")
    phrases = spark.createDataFrame([("b", "John Reed"), ("c", "met")], "book_id string, phrase string")
    hits = sorted((r.start_tok, r.end_tok) for r in ch.phrase_search(tokens, phrases).collect())
    assert hits == [(1, 2), (4, 5)]
    people = spark.createDataFrame([("b", 1, 2, "John Reed")], "book_id string, start_tok int, end_tok int, phrase string")
    assert ch.absorb_honorifics(people, tokens, people).first().phrase == "Mr. John Reed"
    refs = ch.pronoun_references(tokens, people).collect()
    assert [(r.tok_num, r.kind, r.phrase) for r in refs] == [(7, "male", "John Reed")]
    names = spark.createDataFrame([("Dr. J. Reed",), ("Anna",), ("A B. C",), ("a b c d",)], "name string")
    got = [(r.honorific, r.first_initial, r.last_name, r.generic_name) for r in ch.parse_names(names).collect()]
    assert got == [("Dr.", "J", "Reed", None), (None, None, None, "Anna"), (None, "A", None, None), (None, None, None, "a b c d")]


def test_nearest_name(spark):
    rows = [("b", 1, None, "John", "Reed", "male"), ("b", 3, None, "John", "Reed", "male"), ("b", 5, "Reed", None, None, None), ("b", 7, "Reed", None, None, "female"), ("b", 9, None, "Ann", "Reed", "female"), ("b", 11, None, "Ann", "Reed", "female")]
    df = spark.createDataFrame(rows, "book_id string, tok_num int, generic_name string, first_name string, last_name string, gender string")
    got = {r.tok_num: r.first_name for r in ch.resolve_generic(df).collect()}
    assert got == {5: "John", 7: "Ann"}


def test_readers(spark, tmp_path):
    (tmp_path / "lib").mkdir()
    with zipfile.ZipFile(tmp_path / "lib" / "v1.zip", "w") as z:
        z.writestr("v1_00000002.txt", "two")
        z.writestr("v1_00000001.txt", "one")
        z.writestr("notes.txt", "x")
    (tmp_path / "lib" / "bad.zip").write_bytes(io.BytesIO(b"none").getvalue())
    pages = books.page_numbers(books.read_volumes(spark, str(tmp_path)))
    assert sorted((r.lib_id, r.book_id, r.page_no, r.text) for r in pages.collect()) == [("lib", "v1", 1, "one"), ("lib", "v1", 2, "two")]
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts" / "b1.txt").write_text("line one\nline two\n")
    assert [tuple(r) for r in books.read_texts(spark, str(tmp_path / "texts")).collect()] == [("b1", "line one\nline two\n")]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b1.txt").write_text("a text")
    for _ in range(2):  # the second run has nothing new
        ingest.process_new(ingest.stream_texts(spark, str(tmp_path / "in")), lambda df: df, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [r.book_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["b1"]
