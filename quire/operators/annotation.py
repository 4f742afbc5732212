"""Annotated text: a pluggable annotator and the alignment of its output with a book."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TOKENS = "book_id string, para_num int, sent int, tok int, start_char int, end_char int, word string, lemma string, pos_tag string, ner string"
_TOKEN = re.compile(r"\w+(?:['’-]\w+)*|[^\w\s]")
Annotator = Callable[[str], list[tuple[int, int, int, str, str, str, str]]]


def rule_annotator(text: str) -> list[tuple[int, int, int, str, str, str, str]]:
    """(sentence, start, end, word, lemma, pos, ner) by rule: words and signs; a sentence ends
    at a final mark; two capitalised words in a row within a sentence name a person."""
    out: list[tuple] = []
    sent, opens = 0, True
    for m in _TOKEN.finditer(text):
        w = m.group()
        kind = "PUNCT" if not w[0].isalnum() else "NUM" if w.isdigit() else "PROPN" if w[0].isupper() and not opens else "X"
        out.append((sent, m.start(), m.end(), w, w.lower(), kind, "O"))
        opens = w in ".!?…。！？।"
        sent += opens
    for i in range(1, len(out)):
        a, b = out[i - 1], out[i]
        if a[5] == "PROPN" and b[5] == "PROPN" and a[0] == b[0]:
            out[i - 1], out[i] = (*a[:6], "PERSON"), (*b[:6], "PERSON")
    return out


def annotate(paras: DataFrame, annotator: Annotator = rule_annotator) -> DataFrame:
    """Tokens of (book_id, para_num, text), numbered within paragraph and sentence.
    Texts are annotated in Arrow batches; a null text has no tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (book, para, s, i, a, b, w, lemma, pos, ner)
                for book, para, text in zip(pdf["book_id"], pdf["para_num"], pdf["text"])
                for i, (s, a, b, w, lemma, pos, ner) in enumerate(annotator(text))
            ]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _TOKENS.split(", ")])

    return paras.select("book_id", "para_num", "text").where("text is not null").mapInPandas(run, _TOKENS)


def number_tokens(tokens: DataFrame) -> DataFrame:
    """Add ``tok_num`` (from 0 in the book) and ``sent_num`` to (book_id, para_num, sent, tok).

    Only paragraph totals are added up along a book; tokens keep their own paragraph's task.
    """
    per = tokens.groupBy("book_id", "para_num").agg(F.count(F.lit(1)).alias("_n"), F.countDistinct("sent").alias("_s"))
    before = Window.partitionBy("book_id").orderBy("para_num").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("book_id", "para_num", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_t0"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s0"))
    para = Window.partitionBy("book_id", "para_num").orderBy("sent", "tok")
    return (
        tokens.join(base, ["book_id", "para_num"])
        .withColumn("tok_num", (F.col("_t0") + F.row_number().over(para) - 1).cast("int"))
        .withColumn("sent_num", (F.col("_s0") + F.dense_rank().over(Window.partitionBy("book_id", "para_num").orderBy("sent")) - 1).cast("int"))
        .drop("_t0", "_s0")
    )


def assign_paragraphs(sentences: DataFrame, paras: DataFrame) -> DataFrame:
    """Give every sentence (book_id, section, start) the paragraph (…, end_offset) it begins in:
    an as-of join by one sort of both, the next end behind each start."""
    keys = ["book_id", "section"]
    s = sentences.select(*keys, F.col("start").alias("at"), F.lit(0).alias("kind"), "sent", F.lit(None).cast("int").alias("para_num"))
    p = paras.select(*keys, F.col("end_offset").alias("at"), F.lit(-1).alias("kind"), F.lit(None).cast("int").alias("sent"), "para_num")
    w = Window.partitionBy(*keys).orderBy("at", "kind").rowsBetween(1, Window.unboundedFollowing)
    both = s.unionByName(p).withColumn("para", F.first("para_num", ignorenulls=True).over(w))
    return both.where("kind = 0").select(*keys, "sent", F.col("at").alias("start"), F.col("para").alias("para_num"))


def global_heads(tokens: DataFrame) -> DataFrame:
    """Add ``head``: the book-wide number of the token that a token depends on within its
    sentence (``head_in_sent`` from 1; 0 is the root, whose head is -1)."""
    first = F.min("tok_num").over(Window.partitionBy("book_id", "sent_num"))
    return tokens.withColumn("head", F.when(F.col("head_in_sent") > 0, first + F.col("head_in_sent") - 1).otherwise(-1))


def entity_spans(mentions: DataFrame, tokens: DataFrame) -> DataFrame:
    """Mentions (book_id, start_tok, end_tok, phrase) whose first token is part of a name,
    with its kind of name."""
    named = tokens.where("ner is not null and ner <> 'O'").select("book_id", F.col("tok_num").alias("start_tok"), "ner")
    return mentions.join(named, ["book_id", "start_tok"]).select("book_id", "start_tok", "end_tok", "phrase", "ner")


def resolve_overlaps(spans: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Spans in order of their start, skipping those that begin before the end of the last
    kept one (ends are inclusive; of equal starts the longest goes first).

    A new stretch begins where no earlier span reaches, so the fold runs over stretches of
    overlapping spans, not over a whole book.
    """
    w = Window.partitionBy(*keys).orderBy(start, F.col(end).desc())
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.dropDuplicates([*keys, start, end]).withColumn("_new", (reach.isNull() | (F.col(start) > reach)).cast("int"))
    marked = marked.withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    packed = marked.groupBy(*keys, "_g").agg(F.array_sort(F.collect_list(F.struct(F.col(start).alias("a"), (-F.col(end)).alias("e")))).alias("l"))
    keep = F.aggregate(
        "l",
        F.struct(F.lit(-1).cast("long").alias("last"), F.array().cast("array<struct<a:int,e:int>>").alias("kept")),
        lambda acc, x: F.when(x["a"].cast("long") > acc["last"], F.struct((-x["e"]).cast("long").alias("last"), F.array_append(acc["kept"], F.struct(x["a"].cast("int").alias("a"), x["e"].cast("int").alias("e"))).alias("kept"))).otherwise(acc),
        lambda acc: acc["kept"],
    )
    kept = packed.select(*keys, F.explode(keep).alias("k")).select(*keys, F.col("k.a").alias(start), (-F.col("k.e")).alias(end))
    return spans.dropDuplicates([*keys, start, end]).join(kept, [*keys, start, end], "left_semi")


def shift_spans(spans: DataFrame, tokens: DataFrame, columns: list[str], by: str = "header_no") -> DataFrame:
    """Token numbers within sections (or sentences) as numbers within the book: each is
    moved by its section's first token. Quotes and coreference mentions alike."""
    first = tokens.groupBy("book_id", by).agg(F.min("tok_num").alias("_first"))
    joined = spans.join(first, ["book_id", by])
    return joined.withColumns({c: F.col(c) + F.col("_first") for c in columns}).drop("_first")


def antecedents(mentions: DataFrame) -> DataFrame:
    """(book_id, tok_num, coref_start, coref_end): every token of a mention refers to the
    first mention of its chain; of several chains the later one holds.

    Mentions are (book_id, chain, start_tok, end_tok), ends included; first mentions refer to nothing.
    """
    w = Window.partitionBy("book_id", "chain").orderBy("start_tok", "end_tok")
    first = mentions.withColumn("_n", F.row_number().over(w)).withColumn("_a", F.first(F.struct("start_tok", "end_tok")).over(w))
    tokens = first.where("_n > 1").withColumn("tok_num", F.explode(F.sequence("start_tok", "end_tok")))
    last = tokens.groupBy("book_id", "tok_num").agg(F.max_by("_a", F.struct("chain", "_n")).alias("_a"))
    return last.select("book_id", "tok_num", F.col("_a.start_tok").alias("coref_start"), F.col("_a.end_tok").alias("coref_end"))
