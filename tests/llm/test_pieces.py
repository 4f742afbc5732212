from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import pieces


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é漢🙂.,\n ", max_size=300), st.integers(4, 60), st.integers(0, 40))
def test_round_trip_limit_and_overlap(text, limit, overlap):
    if limit - overlap < 4:  # no room for a character of four bytes, perhaps for none
        try:
            cuts = pieces.split_text(text, limit, overlap)
        except ValueError:
            return
    else:
        cuts = pieces.split_text(text, limit, overlap)
    assert "".join(text[first:end] for first, _, end, _ in cuts) == text
    for i, (first, begin, end, _) in enumerate(cuts):
        assert len(text[begin:end].encode()) <= limit and end > first
        if i:
            shared = len(text[begin:first].encode())
            assert shared <= overlap
            assert begin == 0 or shared > overlap - 4


def test_weakest_boundaries_merge_first():
    text = "One two. Three four.\n\nFive six. Seven."
    cuts = pieces.split_text(text, 24, 0)
    assert [text[a:e] for a, _, e, _ in cuts] == ["One two. Three four.\n\n", "Five six. Seven."]


def test_deep_opening_equals_word_atoms():
    text = "Aa bb, cc dd. Ee ff gg.\nHh ii; jj.\n\nKk ll mm nn oo pp qq rr ss tt. Uu vv."
    words = []
    for s, e, n, strength in pieces.atoms(text, 1):
        if words and not text[words[-1][1] - 1].isspace():
            words[-1] = (words[-1][0], e, words[-1][2] + n, strength)
        elif words and text[s].isspace():
            words[-1] = (words[-1][0], e, words[-1][2] + n, strength)
        else:
            words.append((s, e, n, strength))
    for cap in (12, 20, 33):
        deep = pieces.merge(words, cap)
        lazy = pieces.merge(pieces.atoms(text, cap), cap)
        assert [x[1] for x in deep] == [x[1] for x in lazy]


def test_operator(spark):
    docs = spark.createDataFrame(
        [(1, "word " * 50, "s"), (2, None, "s"), (3, "", "s"), (4, "x" * 99, None), (5, "short", "s"), (6, "é" * 60, "t"), (6, "é" * 60, "t")],
        "doc_id long, text string, source string",
    ).selectExpr("*", "1 as piece", "2 as _max")
    limits = spark.createDataFrame([("s", 60, 10), ("default", 40, 4)], "source string, max_tokens int, overlap_tokens int")
    rows = pieces.split_oversized(docs, limits).collect()
    assert {r.doc_id for r in rows} == {1, 4, 6}
    assert all(r.n_tokens <= (60 if r.source == "s" else 40) for r in rows)
    one = sorted((r for r in rows if r.doc_id == 1), key=lambda r: r.piece_no)
    assert "".join(r.piece[r.content_char - r.start_char :] for r in one) == "word " * 50
    assert all(b.content_char - b.start_char == 10 for b in one[1:])
    assert pieces.split_oversized(docs, limits.limit(0)).count() == 0
    words = pieces.split_oversized(docs, limits, size=lambda t: len(t.split()))
    assert words.where("doc_id = 1").count() == 0
    assert pieces.split_oversized(docs.limit(0), limits).count() == 0


def test_the_overlap_asked_for_is_the_one_given(spark):
    text = "word " * 400
    cuts = pieces.split_text(text, 100, 80)
    assert all(first - begin == 80 for first, begin, *_ in cuts[5:]) and all(end - begin <= 100 for _, begin, end, _ in cuts)
    docs = spark.createDataFrame([(1, text, "s"), (2, text, "t"), (3, "🙂" * 20, "u")], "doc_id long, text string, source string")
    limits = spark.createDataFrame([("s", 100, 80), ("t", 50, 50), ("u", 10, 8)], "source string, max_tokens int, overlap_tokens int")
    rows = pieces.split_oversized(docs, limits).collect()
    assert all(r.error is None and r.piece for r in rows if r.doc_id == 1)
    assert [(r.piece_no, r.piece) for r in rows if r.doc_id != 1] == [(0, None)] * 2 and all(r.error for r in rows if r.doc_id != 1)
