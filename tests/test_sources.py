"""Readers, caches, exports and the SQL surface."""

import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from quire import sql
from quire.functions import text as tx
from quire.operators import markup as mk
from quire.operators import volumes as vo
from quire.sources import books, exports


def test_archives_that_cannot_be_read_are_reported(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("v_00000001.txt", "one " * 50)
        z.writestr("v_00000002.txt", "two " * 50)
    broken = bytearray(buffer.getvalue())
    broken[60:70] = b"xxxxxxxxxx"  # within the first file's content
    rows = [("/lib/good.zip", buffer.getvalue()), ("/lib/none.zip", b"no archive"), ("/lib/half.zip", bytes(broken)), ("/lib/null.zip", None)]
    got = {(r.book_id, r.file): (r.text is None, r.error is None) for r in books.unzip_pages(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert got[("good", "v_00000001.txt")] == got[("half", "v_00000002.txt")] == (False, True)
    assert got[("none", None)] == got[("null", None)] == got[("half", "v_00000001.txt")] == (True, False)


def test_cached_stages_run_on_new_inputs_only(spark, tmp_path):
    path, seen = str(tmp_path / "out"), []

    def stage(df):
        seen.append(sorted(r.k for r in df.collect()))
        return df.withColumn("n", F.col("k") * 2)

    one = spark.createDataFrame([(1,), (2,)], "k int")
    books.cached(one, stage, path, ["k"])
    out = books.cached(one.union(spark.createDataFrame([(3,)], "k int")), stage, path, ["k"])
    assert seen == [[1, 2], [3]] and sorted(tuple(r) for r in out.collect()) == [(1, 2), (2, 4), (3, 6)]
    books.cached(one, stage, path, ["k"], force=True)
    assert seen[-1] == [1, 2] and spark.read.parquet(path).count() == 2


def test_the_first_version_there_is_read(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "b"))
    assert books.read_first(spark.read.parquet, [str(tmp_path / x) for x in "abc"]).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        books.read_first(spark.read.parquet, [str(tmp_path / "x")])


def test_tables_of_terms_and_means(spark, tmp_path):
    (tmp_path / "v").write_text("word:the : 3\nodd line\nx : 4\n")
    (tmp_path / "m").write_text("1 0.5 2\n2\t1.5\t0\nbad\n")
    assert [tuple(r) for r in books.read_vocabulary(spark, str(tmp_path / "v")).collect()] == [("word:the", 3), ("x", 4)]
    assert [tuple(r) for r in books.read_means(spark, str(tmp_path / "m")).collect()] == [(1, 0.5, 2.0), (2, 1.5, 0.0)]


def test_xml_and_csv_go_round(spark, tmp_path):
    df = spark.createDataFrame([("b1", "A & B"), ("b2", None)], "book_id string, title string")
    exports.write_artefact(df, str(tmp_path / "x"))
    assert sorted(map(tuple, books.read_artefact(spark, str(tmp_path / "x"), "book", df.schema).collect())) == [("b1", "A & B"), ("b2", None)]
    exports.write_csv(df.withColumn("n", F.lit(1)), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2


def test_sql_functions_equal_the_expressions(spark):
    assert len(sql.register_functions(spark)) == len(sql.FUNCTIONS)
    df = spark.createDataFrame([("THE Old, 3 mills!", "the new mill"), ("", ""), ("Ёлка\x01 ''x``", "лка"), (None, "a")], "a string, b string")
    df.createOrReplaceTempView("pairs_of_lines")
    got = spark.sql("SELECT quire_clean_line(a), quire_similarity(a, b), quire_capital_share(a), quire_xml_safe(a), quire_plain_quotes(a) FROM pairs_of_lines").collect()
    want = df.select(tx.clean_line("a"), tx.similarity(F.col("a"), F.col("b")), tx.capital_share("a"), tx.xml_safe("a"), tx.plain_quotes("a")).collect()
    assert list(map(tuple, got)) == list(map(tuple, want))


def test_queries_are_views(spark, tmp_path):
    spark.createDataFrame([("b", "Some text")], "book_id string, body string").write.parquet(str(tmp_path / "book.parquet"))
    sql.register_tables(spark, str(tmp_path), ["book"])
    sql.register_queries(spark, str(tmp_path), {"short_books": lambda s, d: s.table("book").select("book_id")})
    assert spark.sql("SELECT * FROM short_books JOIN book USING (book_id)").count() == 1


def test_stars_are_headers_only_without_others(spark):
    rows = [("a", 1, "I", False, True), ("a", 2, "* *", True, False), ("a", 3, "x", False, False), ("b", 1, "x", False, None), ("b", 2, "***", True, None), ("c", 1, "x", False, None)]
    got = sorted((r.book_id, r.para_no, r.is_header) for r in mk.settle_stars(spark.createDataFrame(rows, "book_id string, para_no int, text string, star boolean, is_header boolean")).collect())
    assert got == [("a", 1, True), ("a", 3, False), ("b", 0, True), ("b", 1, False), ("b", 2, True), ("c", 1, False)]


# The expectations that the survey gives for line cleaning and distances, and a volume with
# running headers and numbered feet like those it describes.


def test_line_cleaning(spark):
    df = spark.createDataFrame([("  12 Привет, мир!  ",), ("Şi-a spus: „Bună ziua”",), ("* * *",)], "t string")
    assert [r[0] for r in df.select(tx.clean_line("t")).collect()] == ["привет мир", "şi a spus bună ziua", ""]


def test_distances(spark):
    df = spark.createDataFrame([("rosettacode", "raisethysword", 8), ("same", "same", 0), ("", "abc", 3)], "a string, b string, d int")
    assert all(r[0] == r[1] for r in df.select(F.levenshtein("a", "b"), "d").collect())
    assert tx.weighted_distance("kitten", "sitting", replace=2) == 5 and tx.weighted_distance("rosettacode", "raisethysword") == 8
    assert tx.weighted_distance("", "abc") == 3 and tx.weighted_distance("x", "x", replace=2) == 0


def test_headers_feet_and_bodies_of_a_volume(spark):
    rng, pages = random.Random(1), []
    for no in range(1, 11):
        body = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=40)) for _ in range(1 + no % 4)]
        head = ["THE OLD MILL OF HOLM"] if no > 2 else []
        pages.append(("v", no, head + body + ([f"Page {no}"] if no > 2 else [])))
    df = spark.createDataFrame(pages, "book_id string, page_no int, lines array<string>")
    got = {r.page_no: (r.n_header, r.n_footer, r.header, r.footer, len(r.body)) for r in vo.page_structure(df).collect()}
    for no in range(3, 11):
        assert got[no] == (1, 1, ["THE OLD MILL OF HOLM"], [f"Page {no}"], 1 + no % 4)
    assert got[1][:2] == (0, 0) and got[1][4] == 2
