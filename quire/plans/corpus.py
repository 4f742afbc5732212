"""Corpus counts and exports over the annotated tables."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.functions.text import xml_safe
from quire.operators import analytics, annotation
from quire.operators import characters as ch
from quire.runtime import checkpoint_dir, table
from quire.sources import books, exports


def lemma_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.value_counts(table(spark, sf_dir, "tokens"), "lemma")


def pos_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.value_counts(table(spark, sf_dir, "tokens"), "pos_tag")


def dep_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.value_counts(table(spark, sf_dir, "tokens"), "dependency_relation")


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "entities").select("book_id", F.col("start_tok_num").alias("start_tok"), F.col("end_tok_num").alias("end_tok"), "phrase", "ner")


def lemma_counts_non_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.counts_outside(table(spark, sf_dir, "tokens"), "lemma", _spans(spark, sf_dir))


def lemma_counts_non_character(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = ch.person_mentions(table(spark, sf_dir, "entities"))
    often = ch.frequent_mentions(people)
    return analytics.counts_outside(table(spark, sf_dir, "tokens"), "lemma", people.join(often, ["book_id", "phrase"], "left_semi"))


def tokens_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.tokens_export(table(spark, sf_dir, "tokens"))


def entities_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of all kinds; of a span tagged twice the first kind by alphabet."""
    tagged = _spans(spark, sf_dir).where("start_tok is not null and end_tok >= start_tok")
    spans = tagged.groupBy("book_id", "start_tok", "end_tok").agg(F.min("ner").alias("ner"))
    numbered = spans.select("book_id", F.struct("start_tok", "end_tok").alias("entity"), F.explode(F.sequence("start_tok", "end_tok")).alias("tok_num"), "ner")
    words = ch.distinct_tokens(table(spark, sf_dir, "tokens"))
    return exports.entities_export(numbered.join(words, ["book_id", "tok_num"]))


def quotes_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.quotes_export(table(spark, sf_dir, "quotes"))


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page numbers by the names of the delivered files, in both readings."""
    pages = table(spark, sf_dir, "page").select("page_id", "file")
    short = books.feature_page_numbers(pages).withColumnRenamed("page_no", "short_no").drop("file")
    return books.page_numbers(pages).join(short, "page_id").select("page_id", "page_no", "short_no")


def volume_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page packed into an archive of its own and read again."""
    def pack(batches):
        for pdf in batches:
            rows = []
            for lib, book, file, body in zip(pdf["lib_id"], pdf["book_id"], pdf["file"], pdf["page_body"]):
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr(file, body)
                rows.append((f"/volumes/{lib}/{book}.zip", buffer.getvalue()))
            yield pd.DataFrame(rows, columns=["path", "content"])

    pages = table(spark, sf_dir, "page").where("lib_id is not null and book_id is not null and file is not null and page_body is not null")
    packed = pages.select("lib_id", "book_id", "file", "page_body").mapInPandas(pack, "path string, content binary")
    return books.unzip_pages(packed).select("lib_id", "book_id", "file", F.md5(F.col("text").cast("binary")).alias("digest"), "error")


def xml_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and authors written as an XML artefact and read again."""
    path = f"{checkpoint_dir(spark)}/xml-{uuid.uuid4().hex}"
    safe = table(spark, sf_dir, "book").select("book_id", *[xml_safe(F.col(c)).alias(c) for c in ("work_title", "author")])
    exports.write_artefact(safe, path)
    return books.read_artefact(spark, path, "book", StructType().add("book_id", "string").add("work_title", "string").add("author", "string"))


def feature_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature lines of pages: sizes of header, body and footer."""
    p = table(spark, sf_dir, "page").where("book_id is not null and page_no is not null")
    sizes = F.create_map(*[x for c in ("page_body", "page_footer", "page_header") for x in (F.lit(c), F.coalesce(F.length(c), F.lit(0)).cast("double"))])
    one = p.groupBy("book_id", "page_no").agg(F.min_by(sizes, "page_id").alias("m"))
    return exports.feature_lines(one.select("book_id", "page_no", F.explode("m").alias("feature", "value")))


def new_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return books.only_new(table(spark, sf_dir, "book").select("book_id", "lib_id"), table(spark, sf_dir, "page"), ["book_id"])


def annotated_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    paras = table(spark, sf_dir, "p").groupBy("book_id", "para_num").agg(F.min_by("text", "para_id").alias("text"))
    return annotation.number_tokens(annotation.annotate(paras)).select("book_id", "para_num", "sent_num", "tok_num", "word", "pos_tag", "ner")


def entity_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "tokens").select("book_id", F.col("tok_num_in_doc").alias("tok_num"), "ner").distinct()
    return annotation.entity_spans(_spans(spark, sf_dir).drop("ner"), tokens).distinct()


def resolved_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.resolve_overlaps(_spans(spark, sf_dir).where("start_tok is not null").select("book_id", "start_tok", "end_tok"), ["book_id"], "start_tok", "end_tok")


def token_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "tokens").where("sent_num is not null").select(
        "book_id", F.col("tok_num_in_doc").alias("tok_num"), F.concat_ws("/", "para_num", "sent_num").alias("sent_num"), F.col("dependency_head_token_num").alias("head_in_sent")
    )
    return annotation.global_heads(tokens.distinct()).select("book_id", "tok_num", "head_in_sent", "head")


def quote_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes counted within paragraphs and moved back into the book."""
    tokens = table(spark, sf_dir, "tokens").select("book_id", "para_num", F.col("tok_num_in_doc").alias("tok_num"))
    first = tokens.groupBy("book_id", "para_num").agg(F.min("tok_num").alias("f"))
    begin = table(spark, sf_dir, "quotes").select("book_id", F.col("begin_tok_num").alias("tok_num"), "end_tok_num").distinct()
    local = begin.join(tokens.distinct(), ["book_id", "tok_num"]).join(first, ["book_id", "para_num"])
    local = local.select("book_id", "para_num", (F.col("tok_num") - F.col("f")).alias("begin"), (F.col("end_tok_num") - F.col("f")).alias("end"))
    return annotation.shift_spans(local, tokens, ["begin", "end"], by="para_num")


def character_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token with the person in whose mention it lies."""
    people = ch.person_mentions(table(spark, sf_dir, "entities")).withColumnRenamed("phrase", "character")
    return ch.annotate_tokens(ch.distinct_tokens(table(spark, sf_dir, "tokens")), people)


def antecedents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of one spelling as a chain."""
    people = ch.person_mentions(table(spark, sf_dir, "entities"))
    return annotation.antecedents(people.select("book_id", F.col("phrase").alias("chain"), "start_tok", "end_tok"))


def sentence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences by their first token, put into the paragraphs by the last token of each."""
    tokens = table(spark, sf_dir, "tokens").where("sent_num is not null and para_num is not null").select("book_id", F.lit(1).alias("section"), "para_num", "sent_num", "tok_num_in_doc")
    s = tokens.groupBy("book_id", "section", "para_num", "sent_num").agg(F.min("tok_num_in_doc").alias("start")).select("book_id", "section", "start", F.col("sent_num").alias("sent"))
    p = tokens.groupBy("book_id", "section", "para_num").agg((F.max("tok_num_in_doc") + 1).alias("end_offset"))
    return annotation.assign_paragraphs(s.distinct(), p.withColumn("end_offset", F.col("end_offset").cast("int"))).select("book_id", "start", "sent", "para_num")


QUERIES = {
    f.__name__: f
    for f in (
        lemma_counts, pos_counts, dep_counts, lemma_counts_non_entity, lemma_counts_non_character, tokens_export, entities_export,
        quotes_export, page_files, volume_pages, xml_books, feature_export, new_books, character_tokens, annotated_tokens, entity_spans, resolved_spans, token_heads, quote_offsets, antecedents, sentence_paragraphs,
    )
}

_PEOPLE = """people AS (
    SELECT book_id, start_tok_num AS a, end_tok_num AS b, min(phrase) AS phrase FROM entities
    WHERE ner = 'PERSON' AND start_tok_num IS NOT NULL GROUP BY ALL)"""
_WORDS = """words AS (
    SELECT book_id, tok_num_in_doc AS tok, min(word) AS word FROM tokens WHERE tok_num_in_doc IS NOT NULL GROUP BY ALL)"""
SQL = {
    "lemma_counts": "SELECT lemma, count(*) AS n FROM tokens WHERE lemma IS NOT NULL GROUP BY lemma",
    "pos_counts": "SELECT pos_tag, count(*) AS n FROM tokens WHERE pos_tag IS NOT NULL GROUP BY pos_tag",
    "dep_counts": "SELECT dependency_relation, count(*) AS n FROM tokens WHERE dependency_relation IS NOT NULL GROUP BY dependency_relation",
    "lemma_counts_non_entity": """
        SELECT lemma, count(*) AS n FROM tokens t WHERE lemma IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM entities e WHERE e.book_id = t.book_id AND t.tok_num_in_doc BETWEEN e.start_tok_num AND e.end_tok_num)
        GROUP BY lemma""",
    "lemma_counts_non_character": f"""
        WITH {_PEOPLE}, often AS (SELECT book_id, phrase FROM people WHERE phrase IS NOT NULL GROUP BY ALL HAVING count(*) >= 2),
        spans AS (SELECT * FROM people JOIN often USING (book_id, phrase))
        SELECT lemma, count(*) AS n FROM tokens t WHERE lemma IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM spans e WHERE e.book_id = t.book_id AND t.tok_num_in_doc BETWEEN e.a AND e.b)
        GROUP BY lemma""",
    "tokens_export": """
        WITH r AS (SELECT *, row_number() OVER (PARTITION BY book_id, tok_num_in_doc ORDER BY para_num NULLS FIRST, sent_num NULLS FIRST,
                word NULLS FIRST, lemma NULLS FIRST, pos_tag NULLS FIRST, dependency_relation NULLS FIRST, dependency_head_token_num NULLS FIRST, ner NULLS FIRST) AS k FROM tokens),
        t AS (SELECT * FROM r WHERE k = 1)
        SELECT book_id, para_num, sent_num, tok_num_in_doc, word, lemma, pos_tag, dependency_relation, dependency_head_token_num, ner,
               tok_num_in_doc - min(tok_num_in_doc) OVER (PARTITION BY book_id, para_num) AS tok_num_in_para,
               tok_num_in_doc - min(tok_num_in_doc) OVER (PARTITION BY book_id, para_num, sent_num) AS tok_num_in_sent
        FROM t""",
    "entities_export": f"""
        WITH {_WORDS}, p AS (
            SELECT book_id, start_tok_num AS a, end_tok_num AS b, min(ner) AS ner FROM entities
            WHERE start_tok_num IS NOT NULL AND end_tok_num >= start_tok_num GROUP BY ALL)
        SELECT p.book_id, min(w.tok) AS start_tok_num, max(w.tok) AS end_tok_num, string_agg(w.word, ' ' ORDER BY w.tok) AS phrase, any_value(p.ner) AS ner
        FROM p JOIN words w ON w.book_id = p.book_id AND w.tok BETWEEN p.a AND p.b GROUP BY p.book_id, p.a, p.b""",
    "resolved_spans": """
        WITH RECURSIVE s AS (SELECT DISTINCT book_id, start_tok_num AS a, end_tok_num AS e FROM entities WHERE start_tok_num IS NOT NULL),
        o AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY a, e DESC) AS k FROM s),
        w AS (SELECT book_id, k, a, e, true AS kept, e AS last FROM o WHERE k = 1 UNION ALL
              SELECT o.book_id, o.k, o.a, o.e, o.a > w.last, CASE WHEN o.a > w.last THEN o.e ELSE w.last END FROM w JOIN o ON o.book_id = w.book_id AND o.k = w.k + 1)
        SELECT book_id, a AS start_tok, e AS end_tok FROM w WHERE kept""",
    "quote_offsets": """
        WITH t AS (SELECT DISTINCT book_id, para_num, tok_num_in_doc AS tok_num FROM tokens)
        SELECT q.book_id, t.para_num, q.begin_tok_num AS "begin", q.end_tok_num AS "end"
        FROM (SELECT DISTINCT book_id, begin_tok_num, end_tok_num FROM quotes) q
        JOIN t ON t.book_id = q.book_id AND t.tok_num = q.begin_tok_num WHERE t.para_num IS NOT NULL""",
    "sentence_paragraphs": """
        WITH t AS (SELECT * FROM tokens WHERE sent_num IS NOT NULL AND para_num IS NOT NULL),
        s AS (SELECT DISTINCT book_id, sent_num AS sent, min(tok_num_in_doc) OVER (PARTITION BY book_id, para_num, sent_num) AS start FROM t),
        p AS (SELECT book_id, para_num, max(tok_num_in_doc) + 1 AS e FROM t GROUP BY ALL),
        n AS (SELECT book_id, e, min(para_num) AS para_num FROM p GROUP BY ALL)
        SELECT s.book_id, s.start, s.sent, n.para_num FROM s ASOF LEFT JOIN n ON n.book_id = s.book_id AND s.start < n.e""",
    "character_tokens": f"""
        WITH {_PEOPLE}, t AS (SELECT book_id, tok_num_in_doc AS tok_num, min(word) AS word FROM tokens WHERE tok_num_in_doc IS NOT NULL GROUP BY ALL),
        c AS (SELECT t.book_id, t.tok_num, p.phrase, row_number() OVER (PARTITION BY t.book_id, t.tok_num ORDER BY p.a DESC, p.phrase DESC) AS k
              FROM t JOIN people p ON p.book_id = t.book_id AND t.tok_num BETWEEN p.a AND p.b)
        SELECT t.book_id, t.tok_num, t.word, c.phrase AS "character" FROM t LEFT JOIN c ON c.book_id = t.book_id AND c.tok_num = t.tok_num AND c.k = 1""",
    "page_files": r"""
        WITH s AS (SELECT page_id, file, regexp_replace(file, '\.[^.]*$', '') AS stem FROM page),
        n AS (SELECT *, TRY_CAST(CASE WHEN contains(file, '_') THEN regexp_extract(stem, '_([^_]*)$', 1) ELSE stem[-8:] END AS INT) AS page_no FROM s
              WHERE NOT regexp_matches(stem, '^(?i:notes|pagedata)'))
        SELECT page_id, page_no, TRY_CAST(stem[-4:] AS INT) AS short_no FROM n WHERE page_no IS NOT NULL""",
    "volume_pages": """
        SELECT lib_id, book_id, file, md5(page_body) AS digest, NULL::VARCHAR AS error FROM page
        WHERE lib_id IS NOT NULL AND book_id IS NOT NULL AND file IS NOT NULL AND page_body IS NOT NULL""",
    "xml_books": "SELECT book_id, work_title, author FROM book",
    "feature_export": """
        WITH o AS (SELECT DISTINCT ON (book_id, page_no) * FROM page WHERE book_id IS NOT NULL AND page_no IS NOT NULL ORDER BY book_id, page_no, page_id)
        SELECT book_id, concat_ws(chr(9), book_id, page_no, 'page_body=' || coalesce(length(page_body), 0)::DOUBLE || ' page_footer=' || coalesce(length(page_footer), 0)::DOUBLE
                   || ' page_header=' || coalesce(length(page_header), 0)::DOUBLE) AS value FROM o""",
    "quotes_export": "SELECT DISTINCT book_id, mention, begin_tok_num, end_tok_num, begin_mention_tok_num, end_mention_tok_num FROM quotes",
    "new_books": "SELECT book_id, lib_id FROM book WHERE book_id NOT IN (SELECT book_id FROM page WHERE book_id IS NOT NULL)",
    "entity_spans": """
        SELECT DISTINCT e.book_id, e.start_tok_num AS start_tok, e.end_tok_num AS end_tok, e.phrase, t.ner
        FROM entities e JOIN tokens t ON t.book_id = e.book_id AND t.tok_num_in_doc = e.start_tok_num
        WHERE t.ner IS NOT NULL AND t.ner <> 'O'""",
    "token_heads": """
        WITH t AS (SELECT DISTINCT book_id, tok_num_in_doc AS tok_num, para_num, sent_num, dependency_head_token_num AS head_in_sent
                   FROM tokens WHERE sent_num IS NOT NULL)
        SELECT book_id, tok_num, head_in_sent,
               CASE WHEN head_in_sent > 0 THEN min(tok_num) OVER (PARTITION BY book_id, para_num, sent_num) + head_in_sent - 1 ELSE -1 END AS head
        FROM t""",
    "antecedents": f"""
        WITH {_PEOPLE}, n AS (
            SELECT *, row_number() OVER w AS k, first_value(a) OVER w AS fa, first_value(b) OVER w AS fb FROM people
            WINDOW w AS (PARTITION BY book_id, phrase ORDER BY a, b)),
        t AS (SELECT book_id, unnest(range(a, b + 1)) AS tok_num, phrase, k, fa, fb FROM n WHERE k > 1)
        SELECT book_id, tok_num::INT AS tok_num, arg_max(fa, (phrase, k)) AS coref_start, arg_max(fb, (phrase, k)) AS coref_end
        FROM t GROUP BY book_id, tok_num""",
}
