"""Queries of the training-data operators, and the SQL that can check them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import languages, leaks, mixing, pieces, scans, sentences
from quire.llm import name_links as nl
from quire.llm import near_duplicates as nd
from quire.runtime import table

#: Words of a run and similarity by which the found pairs are defined.
_WORDS, _THRESHOLD = 3, 0.5


def _sentences(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    return sentences.paragraph_sentences(table(spark, sf_dir, "p"), table(spark, sf_dir, "book"), with_text)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sentences(spark, sf_dir, with_text=False).select(F.col("key").alias("para_id"), "end_char")


def p1_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sentences(spark, sf_dir).withColumnRenamed("key", "para_id")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.findings(table(spark, sf_dir, "page"))


def p2_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.paragraphs(table(spark, sf_dir, "page"))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.segment_languages(table(spark, sf_dir, "page"), "page_id", "page_body", "lang")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.unnamed_languages(_segments(spark, sf_dir)).withColumnRenamed("key", "page_id")


def p3_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir).withColumnRenamed("key", "page_id")


def p3_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.page_languages(_segments(spark, sf_dir)).withColumnRenamed("key", "page_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, links = nd.near_duplicates(table(spark, sf_dir, "book"), "book_id", "body", _WORDS, _THRESHOLD)
    return nd.all_pairs(members, links).select(F.col("key_a").alias("book_id_a"), F.col("key_b").alias("book_id_b"))


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of nearly equal bodies with five-word shingles and similarity 0.8."""
    members, links = nd.near_duplicates(table(spark, sf_dir, "book"), "book_id", "body", short=True)
    return nd.groups(members, links).select(
        F.col("key").alias("book_id"), F.col("group").alias("group_id"), "copies", "links"
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = nl.link_names(table(spark, sf_dir, "characters"))
    return nl.entity_pairs(linked).select(F.col("a").alias("char_uid_a"), F.col("b").alias("char_uid_b"))


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = nl.link_names(table(spark, sf_dir, "characters"))
    return nl.entity_groups(linked).select(
        F.col("uid").alias("char_uid"), F.col("book").alias("book_id"), F.col("group").alias("entity_uid"), "links"
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.exact_leaks(leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")))


def p6_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.tolerant_leaks(leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")))


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, targets = table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")
    return mixing.water_fill(mixing.source_sizes(docs, targets))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.unreachable(_plan(spark, sf_dir))


def p7_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).withColumns({"granted": F.round("granted", 2), "epochs": F.round("epochs", 6)})


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample_mix(table(spark, sf_dir, "documents"), _plan(spark, sf_dir))


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _plan(spark, sf_dir)
    return mixing.mix_report(plan, mixing.sample_mix(table(spark, sf_dir, "documents"), plan))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_pieces(spark, sf_dir).where("piece_no <= 1").select("doc_id")


def p8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.split_oversized(table(spark, sf_dir, "documents"), table(spark, sf_dir, "piece_limits"))


def p8_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that was cut, put together again from the new parts of its pieces."""
    parts = p8_pieces(spark, sf_dir).select("doc_id", "piece_no", F.expr("substring(piece, content_char - start_char + 1)").alias("part"))
    whole = parts.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("piece_no", "part"))).alias("parts"))
    return whole.select("doc_id", F.md5(F.array_join("parts.part", "").cast("binary")).alias("digest"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_sentences, p2_found, p2_paragraphs, p3_found, p3_segments, p3_pages, p4_found, p4_groups, p5_found, p5_groups, p6_found, p6_leaks, p7_found, p7_plan, p7_mix, p7_report, p8_found, p8_pieces, p8_rebuilt)
}

_SIZE = "octet_length(encode(coalesce(text, '')))"

_GROUPS = r"""
    WITH RECURSIVE w AS (
        SELECT book_id, regexp_extract_all(lower(body), '[\p{L}\p{M}\p{Nd}]+') AS w FROM book WHERE body IS NOT NULL),
    s AS (
        SELECT book_id, CASE WHEN len(w) < 5 THEN ['~' || array_to_string(w, ' ')]
            ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
        FROM w WHERE len(w) > 0),
    e AS (SELECT book_id, len(s) AS n, unnest(s) AS g FROM s),
    c AS (SELECT a.book_id AS a, b.book_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
          FROM e a JOIN e b ON a.g = b.g GROUP BY ALL),
    l AS (SELECT a, b, k = na AND k = nb AS same FROM c WHERE k >= 0.8 * (na + nb - k)),
    reach AS (SELECT a, a AS b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON l.a = r.b),
    g AS (SELECT a, min(b) AS group_id FROM reach GROUP BY a)
    SELECT l.a AS book_id, g.group_id, count(*) FILTER (same) AS copies, count(*) - 1 AS links
    FROM l JOIN g ON g.a = l.a GROUP BY ALL"""

SQL: dict[str, str] = {
    "p4_groups": _GROUPS,
    "p6_found": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
        i AS (SELECT item_id, regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE text IS NOT NULL),
        a AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[k:k + 11], ' ') FOR k IN range(1, len(w) - 10)]) AS g FROM d WHERE len(w) >= 12),
        b AS (SELECT DISTINCT item_id, unnest([array_to_string(w[k:k + 11], ' ') FOR k IN range(1, len(w) - 10)]) AS g FROM i WHERE len(w) >= 12)
        SELECT DISTINCT doc_id, item_id FROM a JOIN b USING (g)""",
    "p7_plan": f"""
        WITH RECURSIVE s AS (
            SELECT m.source, max(m.target_share) AS target_share, max(m.max_repeats) AS max_repeats,
                   coalesce(max(d.size), 0)::BIGINT AS size, coalesce(max(d.n), 0) AS records
            FROM mix_targets m
            LEFT JOIN (SELECT source, sum({_SIZE}) AS size, count(*) AS n FROM documents GROUP BY source) d ON d.source = m.source
            WHERE m.source IS NOT NULL GROUP BY m.source),
        level AS (
            SELECT 1 AS round, (SELECT sum(size) FROM s)::DOUBLE AS scale
            UNION ALL
            SELECT round + 1, ((SELECT sum(size) FROM s) - (SELECT coalesce(sum(max_repeats * size), 0) FROM s WHERE target_share * scale > max_repeats * size))
                / (SELECT sum(target_share) FROM s WHERE target_share * scale <= max_repeats * size)
            FROM level WHERE round < 14 AND EXISTS (SELECT 1 FROM s WHERE target_share * scale <= max_repeats * size)),
        c AS (SELECT s.*, min(l.round) FILTER (target_share * l.scale > max_repeats * size) AS clamped_round, max(l.scale) AS scale
              FROM s CROSS JOIN level l GROUP BY ALL),
        g AS (SELECT *, CASE WHEN clamped_round IS NULL THEN target_share * scale ELSE max_repeats * size::DOUBLE END AS granted FROM c)
        SELECT source, target_share, max_repeats, size, records, round(granted, 2) AS granted,
               round(CASE WHEN size > 0 THEN granted / size ELSE 0.0 END, 6) AS epochs, clamped_round
        FROM g""",
    "p8_rebuilt": f"""
        SELECT d.doc_id, md5(d.text) AS digest
        FROM documents d
        LEFT JOIN piece_limits l ON l.source = d.source AND l.source <> 'default'
        CROSS JOIN (SELECT max_tokens FROM piece_limits WHERE source = 'default') f
        WHERE {_SIZE.replace('text', 'd.text')} > coalesce(l.max_tokens, f.max_tokens)""",
    "p4_found": r"""
        WITH w AS (
            SELECT book_id, regexp_extract_all(lower(body), '[\p{L}\p{M}\p{Nd}]+') AS w FROM book WHERE body IS NOT NULL),
        s AS (
            SELECT book_id, list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) AS s
            FROM w WHERE len(w) >= 3),
        e AS (SELECT book_id, len(s) AS n, unnest(s) AS g FROM s),
        c AS (
            SELECT a.book_id AS book_id_a, b.book_id AS book_id_b, a.n + b.n AS total, count(*) AS k
            FROM e a JOIN e b ON a.g = b.g AND a.book_id < b.book_id
            GROUP BY ALL)
        SELECT book_id_a, book_id_b FROM c WHERE k >= 0.5 * (total - k)""",
    "p7_found": f"""
        WITH s AS (
            SELECT m.source, max(m.target_share) AS target_share, max(m.max_repeats) AS max_repeats,
                   coalesce(max(d.size), 0) AS size
            FROM mix_targets m
            LEFT JOIN (SELECT source, sum({_SIZE}) AS size FROM documents GROUP BY source) d ON d.source = m.source
            WHERE m.source IS NOT NULL
            GROUP BY m.source)
        SELECT source FROM s WHERE target_share * (SELECT sum(size) FROM s) > max_repeats * size""",
    "p8_found": f"""
        SELECT d.doc_id
        FROM documents d
        LEFT JOIN piece_limits l ON l.source = d.source AND l.source <> 'default'
        CROSS JOIN (SELECT max_tokens FROM piece_limits WHERE source = 'default') f
        WHERE {_SIZE.replace('text', 'd.text')} > coalesce(l.max_tokens, f.max_tokens)""",
}
