"""Scanned volumes: edges, structure, features and sections, over the page table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators import page_features as pf
from quire.operators import segmentation as sg
from quire.operators import volumes as vo
from quire.runtime import durable, table


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vo.volume(table(spark, sf_dir, "page"))


def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _pages(spark, sf_dir).select("book_id", "page_no", F.posexplode("lines").alias("at", "line"))
    return lines.select("book_id", "page_no", "at", tx.clean_line("line").alias("clean"))


def similar_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vo.similar_lines(vo.edge_lines(_pages(spark, sf_dir)))


def running_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vo.running_lines(vo.edge_lines(_pages(spark, sf_dir)))


def page_number_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vo.page_number_runs(_pages(spark, sf_dir))


def page_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = vo.page_structure(_pages(spark, sf_dir))
    return s.select("book_id", "page_no", "n_header", "n_footer", F.array_join("body", "\n").alias("body"))


def _cut(df: DataFrame) -> DataFrame:
    return df.select("book_id", "page_no", "cut_head", "cut_tail", F.array_join("lines", "\n").alias("text"))


def strip_unlettered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut(vo.strip_unlettered(_pages(spark, sf_dir)))


def strip_numerals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut(vo.strip_numerals(_pages(spark, sf_dir)))


def majority_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vo.if_majority(vo.strip_numerals(vo.strip_unlettered(_pages(spark, sf_dir))), vo.strip_headings)
    return out.select("book_id", "page_no", "applied", F.array_join("lines", "\n").alias("text"))


def strip_usual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vo.strip_usual(_pages(spark, sf_dir)).select("book_id", "page_no", "cut_head", F.array_join("lines", "\n").alias("text"))


def clean_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    words = pages.select(F.explode(F.array_distinct(F.split(tx.clean_line(F.array_join("lines", " ")), " "))).alias("word"))
    vocabulary = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 3 and word <> ''")
    return vo.clean_edges(pages, vocabulary).select("book_id", "page_no", F.array_join("lines", "\n").alias("text"))


def dehyphenate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vo.dehyphenate(_pages(spark, sf_dir)).select("book_id", "page_no", F.array_join("lines", "\n").alias("text"))


def reparagraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _pages(spark, sf_dir).select("book_id", "page_no", F.posexplode("lines").alias("at", "line"))
    header = F.col("line").rlike(r"^\s*(CHAPTER|CHAPITRE|KAPITEL|CAPITOLO) [IVXLC]+\.$")
    return vo.reparagraph(lines.select("book_id", (F.col("page_no") * 10_000 + F.col("at")).alias("line_no"), "line", header.alias("is_header")))


def position_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.position_features(_pages(spark, sf_dir)).withColumn("ratio", F.round(F.col("ratio") * 100).cast("int"))


def word_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pf.word_features(_pages(spark, sf_dir))
    return out.withColumns({c: F.array_join(c, " ") for c in ("key_words", "header_words")})


def alphabetical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.alphabetical(_pages(spark, sf_dir))


def rising_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.rising_numbers(_pages(spark, sf_dir))


def roman_numerals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.roman_numerals(_pages(spark, sf_dir))


def letter_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.letter_features(_pages(spark, sf_dir))


def page_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.page_sequence(vo.volume(table(spark, sf_dir, "page").withColumn("t", F.concat_ws("\n", "page_header", "page_body", "page_footer")), "t"))


def offset_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.offset_votes(_pages(spark, sf_dir))


def text_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.text_tiling(_pages(spark, sf_dir))


def ngram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.ngram_counts(_pages(spark, sf_dir))


def _few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of lines and of blank lines as features."""
    p = _pages(spark, sf_dir)
    blank = F.size(F.filter("lines", lambda s: s == ""))
    return p.select("book_id", "page_no", F.explode(F.create_map(F.lit("blank"), blank.cast("double"), F.lit("lines"), F.size("lines").cast("double"))).alias("feature", "value"))


def context_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.context_features(_few(spark, sf_dir))


def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised vectors; ids and means are those of the collection."""
    features = pf.long_features(_pages(spark, sf_dir))
    vocabulary = features.select(F.col("feature").alias("term")).distinct()
    names = vocabulary.groupBy().agg(F.array_sort(F.collect_set("term")).alias("all")).select(F.posexplode("all").alias("id", "term"))
    by_id = pf.map_vocabulary(features, names)
    means = by_id.groupBy("id").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"))
    return pf.standardise(by_id, means, 200).select("book_id", "page_no", F.array_join(F.transform("vector", lambda v: F.round(v, 6).cast("string")), " ").alias("vector"))


def adjacent_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.adjacent_similarity(_few(spark, sf_dir)).withColumn("cosine", F.round("cosine", 6) + 0.0)


def page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sg.rule_labels(_pages(spark, sf_dir))


def model_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of a model fitted to the delivered tags; a page without tag counts as content."""
    tags = table(spark, sf_dir, "page").where("book_id is not null and page_no is not null").groupBy("book_id", "page_no").agg(F.min_by("bamman_tag", "page_id").alias("tag"))
    features = durable(pf.context_features(pf.long_features(_pages(spark, sf_dir))))
    model = sg.fit_labels(features, tags.select("book_id", "page_no", F.coalesce("tag", F.lit("content")).alias("label")))
    return sg.model_labels(features, model).withColumn("confidence", F.round("confidence", 3))


def label_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the labels as delivered (``lang`` stands for a label that changes)."""
    labels = table(spark, sf_dir, "page").where("book_id is not null and page_no is not null").groupBy("book_id", "page_no").agg(F.min_by("lang", "page_id").alias("label"))
    return sg.label_runs(labels)


def volume_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sg.sections(sg.rule_labels(_pages(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        clean_lines, similar_lines, running_lines, page_number_runs, page_structure, strip_unlettered, strip_numerals, majority_headings,
        strip_usual, clean_edges, dehyphenate, reparagraph, position_features, word_features, alphabetical, rising_numbers, roman_numerals,
        letter_features, page_sequence, offset_votes, text_tiling, ngram_counts, context_features, feature_vectors, adjacent_similarity,
        page_labels, model_labels, label_runs, volume_sections,
    )
}

_VOL = r"""vol AS (
    SELECT book_id, page_no, arg_min(coalesce(page_body, ''), page_id) AS t FROM page
    WHERE book_id IS NOT NULL AND page_no IS NOT NULL GROUP BY ALL),
pg AS (
    SELECT book_id, page_no, CASE WHEN t = '' THEN []::VARCHAR[] ELSE
        [regexp_replace(x, '[\s\p{Z}]+$', '') FOR x IN string_split(regexp_replace(t, '\n$', ''), chr(10))] END AS lines FROM vol)"""
_CLEAN = r"lower(trim(regexp_replace({0}, '[^\p{{L}}\p{{M}}]+', ' ', 'g')))"
_EDGE = f"""{_VOL}, pos AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY page_no) AS pos FROM pg),
ln AS (SELECT book_id, page_no, pos, len(lines) AS n, unnest(range(len(lines)))::INT AS i, unnest(lines) AS line FROM pos)"""
_STRIP = """
WITH {vol}, k AS (SELECT book_id, page_no, lines, len(lines) AS n, [{keep} FOR s IN lines] AS keep FROM pg),
e AS (SELECT *, CASE WHEN list_position(keep, true) IS NULL OR list_position(keep, true) = 0 THEN n ELSE list_position(keep, true) - 1 END AS h,
             CASE WHEN list_position(list_reverse(keep), true) IS NULL OR list_position(list_reverse(keep), true) = 0 THEN n ELSE list_position(list_reverse(keep), true) - 1 END AS f FROM k)
SELECT book_id, page_no, h::INT AS cut_head, least(f, n - h)::INT AS cut_tail, array_to_string(lines[h + 1:n - least(f, n - h)], chr(10)) AS text FROM e"""
# edit distance counts bytes in SQL: the signs of each pair become single bytes first
_BYTES = "array_to_string([chr((20 + list_position(d, c))::INT) FOR c IN string_split({0}, '')], '')"
_SIMILAR = _EDGE + rf""", cl AS (SELECT book_id, pos, n, i, {_CLEAN.format('line')} AS c FROM ln),
eg AS (SELECT *, unnest([s FOR s IN [CASE WHEN i < 3 THEN 'header' END, CASE WHEN i >= n - 3 THEN 'footer' END] IF s IS NOT NULL]) AS side FROM cl WHERE length(c) >= 4),
pr AS (SELECT a.book_id, a.side, a.pos AS pos_a, a.i AS at_a, b.pos AS pos_b, b.i AS at_b, a.c AS ca, b.c AS cb,
              list_distinct(string_split(a.c || b.c, '')) AS d, greatest(length(a.c), length(b.c)) AS m
       FROM eg a JOIN eg b ON b.book_id = a.book_id AND b.side = a.side AND b.pos BETWEEN a.pos + 1 AND a.pos + 5
       WHERE abs(length(a.c) - length(b.c)) <= (1 - 0.7::DOUBLE) * greatest(length(a.c), length(b.c))),
sim AS (SELECT book_id, side, pos_a, at_a, pos_b, at_b FROM pr WHERE 1 - levenshtein({_BYTES.format('ca')}, {_BYTES.format('cb')}) / m::DOUBLE >= 0.7)"""
_RUNNING = _SIMILAR + r""", nd AS (
    SELECT book_id, printf('%s%s%s%s%09d%s%04d', book_id, chr(1), side, chr(1), pos_a, chr(1), at_a) AS a,
           printf('%s%s%s%s%09d%s%04d', book_id, chr(1), side, chr(1), pos_b, chr(1), at_b) AS b FROM sim),
ed AS (SELECT a, b FROM nd UNION SELECT b, a FROM nd),
re AS (SELECT a, a AS b FROM ed UNION SELECT re.a, ed.b FROM re JOIN ed ON ed.a = re.b),
co AS (SELECT a, min(b) AS cluster, count(*) AS n FROM re GROUP BY a),
run AS (SELECT string_split(a, chr(1)) AS x, cluster FROM co WHERE n >= 3),
rl AS (SELECT x[1] AS book_id, x[2] AS side, x[3]::INT AS pos, x[4]::INT AS i, cluster FROM run)"""
_NUMBERS = rf"""x AS (SELECT *, CASE WHEN trim(lines[-1]) = '' AND len(lines) > 1 THEN len(lines) - 2 ELSE len(lines) - 1 END AS i
                            FROM pos WHERE len(lines) > 0),
        y AS (SELECT book_id, pos, i, [d FOR d IN regexp_extract_all(lines[i + 1], '\d+') IF length(d) <= 4] AS d FROM x),
        z AS (SELECT book_id, pos, i, d[1]::INT AS number FROM y WHERE len(d) = 1),
        b AS (SELECT *, CASE WHEN number <> lag(number) OVER (PARTITION BY book_id ORDER BY pos) + 1 THEN 1 ELSE 0 END AS b FROM z),
        r AS (SELECT *, sum(b) OVER (PARTITION BY book_id ORDER BY pos) AS run FROM b),
        s AS (SELECT *, count(*) OVER (PARTITION BY book_id, run) AS n FROM r)"""
_HEADING_LIKE = r"(regexp_matches(s, '\p{Lu}') AND (NOT regexp_matches(s, '\p{Ll}') OR NOT regexp_matches(s, '(^|[^\p{L}])\p{Ll}|\p{L}\p{Lu}')))"


def _stripped(name: str, source: str, keep: str, tail: bool = True) -> str:
    """CTEs that take off the edge lines of ``source`` which don't keep ``keep``."""
    at = "coalesce(nullif(list_position({0}, true), 0) - 1, len(lines))"
    foot = at.format("list_reverse(k)") if tail else "0"
    return f"""{name}k AS (SELECT *, [{keep} FOR s IN lines] AS k FROM {source}),
        {name}e AS (SELECT * EXCLUDE (k), {at.format('k')} AS h, {foot} AS f FROM {name}k),
        {name} AS (SELECT book_id, page_no, lines[h + 1:len(lines) - least(f, len(lines) - h)] AS lines, len(lines) AS n FROM {name}e)"""


_LETTERED, _UNNUMBERED = r"regexp_matches(s, '\p{L}')", r"NOT (regexp_matches(s, '^[\s\p{Z}]*[^\s\p{Z}]*\d') OR regexp_matches(s, '\d[^\s\p{Z}]*[\s\p{Z}]*$'))"
_TOKENS = "regexp_split_to_array(regexp_replace(lower(rtrim({0}, ' ')), '[^a-z0-9$£ ]', '', 'g'), '\\s+')"
_KEYS = "[" + ", ".join(f"'{w}'" for w in dict.fromkeys(pf.KEY_WORDS)) + "]"
_WORD_FEATURES = f"""t AS (SELECT book_id, page_no, {_TOKENS.format("array_to_string(lines, '')")} AS t,
                flatten([{_TOKENS.format('s')} FOR s IN lines[1:6]]) AS h FROM pg),
        c AS (SELECT *, len(t) AS n, len([x FOR x IN t IF regexp_matches(x, '^[a-z0-9_]')]) AS w, len([x FOR x IN t IF regexp_matches(x, '^[0-9]')]) AS m FROM t)"""


def _any(column: str, *words: str) -> str:
    return f"list_has_any({column}, [" + ", ".join(f"'{w}'" for w in words) + "])"


_LABELS = f"""{_VOL}, {_WORD_FEATURES},
        po AS (SELECT book_id, page_no, page_no <= 10 AS early, count(*) OVER (PARTITION BY book_id) - page_no <= 10 AS late FROM pg),
        la AS (SELECT c.book_id, c.page_no, CASE WHEN n < 5 THEN 'blank' WHEN early AND {_any('h', 'contents')} THEN 'toc'
                WHEN early AND {_any('t', 'copyright', 'copyrighted', 'published')} THEN 'pubinfo'
                WHEN early AND ({_any('h', 'dedicated')} OR {_any('t', 'dedicated')}) THEN 'dedication'
                WHEN early AND {_any('h', 'preface', 'introduction', 'foreword')} THEN 'preface'
                WHEN late AND {_any('h', 'index')} THEN 'index' WHEN late AND {_any('h', 'appendix')} THEN 'appendix'
                WHEN {_any('h', 'advertisement', 'advertisements')} THEN 'ad' WHEN early AND w < 5 THEN 'title' ELSE 'content' END AS label
               FROM c JOIN po ON po.book_id = c.book_id AND po.page_no = c.page_no)"""
SQL = {
    "rising_numbers": f"""
        WITH {_VOL}, x AS (SELECT book_id, page_no, [[d::INT] FOR d IN regexp_extract_all(array_to_string(lines, ''), '[0-9]+') IF length(d) <= 9] AS x FROM pg),
        r AS (SELECT book_id, page_no, len(x) AS n, list_reduce(x, lambda a, e: list_concat(list_concat(list_filter(a, lambda t: t < e[1]), e),
                  a[len(list_filter(a, lambda t: t < e[1])) + 2:])) AS tails FROM x WHERE len(x) >= 4)
        SELECT book_id, page_no, n::INT AS numbers, len(tails)::INT AS rise,
               len(tails) > 2 * sqrt(n) - 1.771 * pow(n, 1 / 6::DOUBLE) + 1.65 * 0.902 * pow(n, 1 / 6::DOUBLE) AS significant FROM r""",
    "dehyphenate": rf"""
        WITH {_EDGE}, t AS (SELECT *, [s FOR s IN lines IF trim(s, ' ') <> ''] AS t FROM pos),
        h AS (SELECT *, len(t) > 0 AND regexp_matches(coalesce(t[-1], ''), '[^\-\s]-\s*$') AS hangs, regexp_extract(coalesce(t[1], ''), '^[\s\p{{Z}}]*([^\s\p{{Z}}]+)', 1) AS word FROM t),
        j AS (SELECT *, lead(word) OVER w AS next_word, coalesce(lag(hangs) OVER w, false) AS owed FROM h WINDOW w AS (PARTITION BY book_id ORDER BY pos)),
        g AS (SELECT * REPLACE (CASE WHEN owed AND len(t) > 0 THEN [CASE WHEN i = list_position(lines, t[1]) THEN regexp_replace(s, '^[\s\p{{Z}}]*[^\s\p{{Z}}]+[\s\p{{Z}}]*', '') ELSE s END FOR s, i IN lines]
                ELSE lines END AS lines) FROM j),
        a AS (SELECT *, len(lines) + 1 - coalesce(nullif(list_position([trim(s, ' ') <> '' FOR s IN list_reverse(lines)], true), 0), 0) AS k FROM g),
        k AS (SELECT book_id, page_no, CASE WHEN hangs AND coalesce(next_word, '') <> '' THEN [CASE WHEN i = k THEN regexp_replace(s, '-\s*$', '') || next_word ELSE s END FOR s, i IN lines]
                ELSE lines END AS lines FROM a),
        m AS (SELECT book_id, page_no, list_reduce(CASE WHEN len(lines) = 0 THEN [['']] ELSE [[regexp_replace(s, '[\s\p{{Z}}]+$', '')] FOR s IN lines] END, lambda o, e:
                  CASE WHEN o[-1] LIKE '%-' AND NOT o[-1] LIKE '%--' AND regexp_matches(e[1], '[^\s\p{{Z}}]') THEN
                       list_concat(list_concat(o[:-2], [o[-1][:-2] || string_split(regexp_replace(e[1], '^[\s\p{{Z}}]+', ''), ' ')[1]]),
                                   [x FOR x IN [trim(regexp_replace(e[1], '^[\s\p{{Z}}]*[^ ]*', ''), ' ')] IF x <> ''])
                       ELSE list_concat(o, e) END) AS lines FROM k)
        SELECT book_id, page_no, coalesce(array_to_string(lines, chr(10)), '') AS text FROM m""",
    "clean_edges": rf"""
        WITH {_VOL}, {_stripped('a', 'pg', _LETTERED)}, {_stripped('b', 'a', _UNNUMBERED)},
        {_stripped('c', 'b', 'NOT ' + _HEADING_LIKE, tail=False)},
        d AS (SELECT c.book_id, c.page_no, CASE WHEN avg((len(c.lines) < len(b.lines))::INT) OVER (PARTITION BY c.book_id) >= 0.5 THEN c.lines ELSE b.lines END AS lines
              FROM c JOIN b ON b.book_id = c.book_id AND b.page_no = c.page_no),
        vw AS (SELECT unnest(list_distinct(string_split({_CLEAN.format("array_to_string(lines, ' ')")}, ' '))) AS word FROM pg),
        vo AS (SELECT list(word) AS known FROM (SELECT word FROM vw WHERE word <> '' GROUP BY word HAVING count(*) >= 3)),
        li AS (SELECT book_id, page_no, len(lines) AS n, unnest(range(len(lines)))::INT AS i, unnest(lines) AS line FROM d),
        lw AS (SELECT *, list_filter(string_split({_CLEAN.format('line')}, ' '), lambda x: x <> '') AS w FROM li),
        fl AS (SELECT book_id, page_no, i, line, (i = n - 1 AND regexp_matches(trim(line, ' '), '^\p{{L}}+[.!?]["''”’]?$')) OR NOT (trim(line, ' ') = ''
                OR NOT ({_UNNUMBERED.replace('(s,', '(line,')})
                OR CASE WHEN len(w) = 0 THEN true ELSE 1 - len(list_filter(w, lambda x: list_contains(known, x))) / len(w)::DOUBLE > 0.75 END) AS keep FROM lw CROSS JOIN vo),
        fk AS (SELECT book_id, page_no, list(line ORDER BY i) AS lines, list(keep ORDER BY i) AS k FROM fl GROUP BY ALL),
        fe AS (SELECT *, coalesce(nullif(list_position(k, true), 0) - 1, len(lines)) AS h, coalesce(nullif(list_position(list_reverse(k), true), 0) - 1, len(lines)) AS f FROM fk),
        f AS (SELECT d.book_id, d.page_no, CASE WHEN fe.lines IS NULL THEN [] ELSE fe.lines[h + 1:len(fe.lines) - least(f, len(fe.lines) - h)] END AS lines FROM d LEFT JOIN fe ON fe.book_id = d.book_id AND fe.page_no = d.page_no),
        uk AS (SELECT *, [NOT ({_HEADING_LIKE} OR NOT regexp_matches(s, '\p{{L}}')) FOR s IN lines] AS k FROM f),
        o AS (SELECT *, coalesce(nullif(list_position(k, true), 0) - 1, len(lines)) AS own FROM uk),
        u AS (SELECT book_id, own, count(*) AS n, min(page_no) AS first FROM o WHERE own > 0 GROUP BY ALL),
        m AS (SELECT DISTINCT ON (book_id) book_id, own AS usual FROM u ORDER BY book_id, n DESC, first),
        sh AS (SELECT book_id, avg((own > 0)::INT) AS share FROM o GROUP BY ALL)
        SELECT o.book_id, o.page_no, array_to_string(lines[CASE WHEN share > 0.25 THEN least(own, coalesce(usual, 0)) ELSE 0 END + 1:], chr(10)) AS text
        FROM o JOIN sh USING (book_id) LEFT JOIN m USING (book_id)""",
    "similar_lines": f"""WITH {_SIMILAR} SELECT book_id, side, pos_a::INT AS pos_a, at_a, pos_b::INT AS pos_b, at_b FROM sim""",
    "running_lines": f"""WITH RECURSIVE {_RUNNING} SELECT book_id, side, pos, i AS "at", cluster FROM rl""",
    "page_structure": f"""
        WITH RECURSIVE {_RUNNING}, {_NUMBERS},
        mk AS (SELECT book_id, side, pos, i FROM rl UNION ALL
               SELECT book_id, 'footer', pos, i FROM s WHERE n >= 3 AND book_id NOT IN (SELECT book_id FROM rl WHERE side = 'footer')),
        pe AS (SELECT book_id, pos, max(i + 1) FILTER (side = 'header') AS h, min(i) FILTER (side = 'footer') AS f FROM mk GROUP BY ALL),
        j AS (SELECT p.book_id, p.page_no, p.lines, len(p.lines) AS n, coalesce(h, 0) AS h, f FROM pos p LEFT JOIN pe USING (book_id, pos)),
        c AS (SELECT *, greatest(0, least(n - coalesce(f, n), n - h)) AS t FROM j)
        SELECT book_id, page_no, h::INT AS n_header, t::INT AS n_footer, array_to_string(lines[h + 1:n - t], chr(10)) AS body FROM c""",
    "majority_headings": f"""
        WITH {_VOL}, {_stripped('a', 'pg', _LETTERED)}, {_stripped('b', 'a', _UNNUMBERED)},
        {_stripped('c', 'b', 'NOT ' + _HEADING_LIKE, tail=False)},
        d AS (SELECT c.book_id, c.page_no, c.lines AS short, b.lines AS long, avg((len(c.lines) < len(b.lines))::INT) OVER (PARTITION BY c.book_id) >= 0.5 AS applied
              FROM c JOIN b ON b.book_id = c.book_id AND b.page_no = c.page_no)
        SELECT book_id, page_no, applied, array_to_string(CASE WHEN applied THEN short ELSE long END, chr(10)) AS text FROM d""",
    "strip_usual": f"""
        WITH {_VOL}, k AS (SELECT *, [NOT ({_HEADING_LIKE} OR NOT regexp_matches(s, '\\p{{L}}')) FOR s IN lines] AS k FROM pg),
        o AS (SELECT *, coalesce(nullif(list_position(k, true), 0) - 1, len(lines)) AS own FROM k),
        u AS (SELECT book_id, own, count(*) AS n, min(page_no) AS first FROM o WHERE own > 0 GROUP BY ALL),
        m AS (SELECT DISTINCT ON (book_id) book_id, own AS usual FROM u ORDER BY book_id, n DESC, first),
        a AS (SELECT book_id, avg((own > 0)::INT) AS share FROM o GROUP BY ALL),
        c AS (SELECT o.*, CASE WHEN share > 0.25 THEN least(own, coalesce(usual, 0)) ELSE 0 END AS cut FROM o JOIN a USING (book_id) LEFT JOIN m USING (book_id))
        SELECT book_id, page_no, cut::INT AS cut_head, array_to_string(lines[cut + 1:], chr(10)) AS text FROM c""",
    "reparagraph": f"""
        WITH {_EDGE}, l AS (SELECT book_id, page_no * 10000 + i AS line_no, line, regexp_matches(line, '^\\s*(CHAPTER|CHAPITRE|KAPITEL|CAPITOLO) [IVXLC]+\\.$') AS hd
                            FROM ln WHERE trim(line, ' ') <> ''),
        b AS (SELECT *, CASE WHEN lag(line) OVER w IS NULL OR hd OR lag(hd) OVER w
                OR (regexp_matches(rtrim(lag(line) OVER w, ' '), '[.?!"'']$') AND regexp_matches(ltrim(line, ' '), '^["''\\p{{Lu}}]')) THEN 1 ELSE 0 END AS b
              FROM l WINDOW w AS (PARTITION BY book_id ORDER BY line_no)),
        g AS (SELECT *, sum(b) OVER (PARTITION BY book_id ORDER BY line_no) AS para_no FROM b)
        SELECT book_id, para_no::BIGINT AS para_no, bool_or(hd) AS is_header, string_agg(trim(line, ' '), ' ' ORDER BY line_no) AS text FROM g GROUP BY ALL""",
    "word_features": f"""
        WITH {_VOL}, {_WORD_FEATURES}
        SELECT book_id, page_no, (n < 5)::INT AS blank_page, (w < 5)::INT AS words_under_5, w::INT AS num_words, m::INT AS num_numbers,
               CASE WHEN w > 0 THEN round_even(w / n::DOUBLE, 3) END AS word_ratio, CASE WHEN w > 0 THEN round_even(m / n::DOUBLE, 3) END AS num_ratio,
               CASE WHEN w > 0 THEN round_even((w + 5) / (m + 5)::DOUBLE, 3) END AS word_num_ratio,
               array_to_string(list_sort([k FOR k IN {_KEYS} IF list_contains(t, k)]), ' ') AS key_words,
               array_to_string(list_sort([k FOR k IN {_KEYS} IF list_contains(h, k)]), ' ') AS header_words
        FROM c""",
    "page_labels": f"WITH {_LABELS} SELECT book_id, page_no, label FROM la",
    "volume_sections": f"""
        WITH {_LABELS}, ch AS (SELECT *, CASE WHEN label IS DISTINCT FROM lag(label) OVER w THEN 1 ELSE 0 END AS b FROM la WINDOW w AS (PARTITION BY book_id ORDER BY page_no)),
        ru AS (SELECT *, sum(b) OVER (PARTITION BY book_id ORDER BY page_no) AS run FROM ch),
        gr AS (SELECT book_id, run, min(page_no) AS a, max(page_no) AS z, any_value(label) AS label FROM ru GROUP BY ALL),
        en AS (SELECT *, coalesce(lead(a) OVER (PARTITION BY book_id ORDER BY run), z + 1) AS e FROM gr),
        bo AS (SELECT DISTINCT ON (book_id) book_id, a, e FROM en
               ORDER BY book_id, label = 'content' DESC, CASE WHEN label = 'content' THEN e - a ELSE 0 END DESC, CASE WHEN label = 'content' THEN a ELSE -a END)
        SELECT la.book_id, la.page_no, la.label, CASE WHEN la.page_no < bo.a THEN 'front' WHEN la.page_no >= bo.e THEN 'back' ELSE 'body' END AS section
        FROM la JOIN bo ON bo.book_id = la.book_id""",
    "adjacent_similarity": f"""
        WITH {_VOL}, f AS (
            SELECT book_id, page_no, 'lines' AS k, len(lines)::DOUBLE AS v FROM pg UNION ALL SELECT book_id, page_no, 'blank', len([s FOR s IN lines IF s = ''])::DOUBLE FROM pg),
        z AS (SELECT book_id, page_no, k, (v - avg(v) OVER w) / nullif(stddev_pop(v) OVER w, 0) AS z FROM f WINDOW w AS (PARTITION BY book_id, k)),
        n AS (SELECT book_id, page_no, sqrt(sum(z * z)) AS n FROM z WHERE z IS NOT NULL GROUP BY ALL),
        d AS (SELECT a.book_id, a.page_no, sum(a.z * b.z) AS d FROM z a JOIN z b ON b.book_id = a.book_id AND b.k = a.k AND b.page_no = a.page_no - 1 GROUP BY ALL)
        SELECT n.book_id, n.page_no, round(coalesce(d.d, 0) / nullif(n.n * m.n, 0), 6) + 0.0 AS cosine
        FROM n JOIN n m ON m.book_id = n.book_id AND m.page_no = n.page_no - 1 LEFT JOIN d ON d.book_id = n.book_id AND d.page_no = n.page_no""",
    "roman_numerals": f"""
        WITH {_VOL}, r AS (SELECT [{", ".join(f"'{pf.roman(n)}'" for n in range(2, 500))}] AS r),
        w AS (SELECT book_id, page_no, flatten([regexp_split_to_array(lower(trim(s, ' ')), '\\s+') FOR s IN lines[1:5]]) AS a,
                     flatten([regexp_split_to_array(lower(trim(s, ' ')), '\\s+') FOR s IN lines[greatest(len(lines) - 4, 1):]]) AS b FROM pg)
        SELECT book_id, page_no, list_has_any(a, r) AS roman_top, list_has_any(b, r) AS roman_bottom FROM w CROSS JOIN r""",
    "letter_features": f"""
        WITH {_VOL}, w AS (SELECT book_id, page_no, unnest(regexp_split_to_array(lower(array_to_string(lines, '')), '\\s+'))[1] AS l FROM pg),
        c AS (SELECT book_id, page_no, l, count(*) AS c FROM w WHERE l BETWEEN 'a' AND 'z' GROUP BY ALL),
        f AS (SELECT pg.book_id, pg.page_no, a.l, coalesce(c.c, 0) + 1 AS c FROM pg CROSS JOIN (SELECT chr(unnest(range(97, 123))::INT) AS l) a
              LEFT JOIN c ON c.book_id = pg.book_id AND c.page_no = pg.page_no AND c.l = a.l),
        j AS (SELECT *, sum(c) OVER (PARTITION BY book_id, page_no) AS pc, sum(c) OVER (PARTITION BY book_id, l)::DOUBLE / sum(c) OVER (PARTITION BY book_id) AS u FROM f)
        SELECT book_id, page_no, sum(((c / pc::DOUBLE - u) / sqrt(u * (1 - u) / c) > 1.65)::INT)::BIGINT AS letters,
               (sum(((c / pc::DOUBLE - u) / sqrt(u * (1 - u) / c) > 1.65)::INT) > 0)::INT AS letter_1,
               (sum(((c / pc::DOUBLE - u) / sqrt(u * (1 - u) / c) > 1.65)::INT) > 1)::INT AS letter_2
        FROM j GROUP BY ALL""",
    "clean_lines": f"""WITH {_EDGE} SELECT book_id, page_no, i AS "at", {_CLEAN.format('line')} AS clean FROM ln""",
    "strip_unlettered": _STRIP.format(vol=_VOL, keep=r"regexp_matches(s, '\p{L}')"),
    "strip_numerals": _STRIP.format(vol=_VOL, keep=r"NOT (regexp_matches(s, '^[\s\p{Z}]*[^\s\p{Z}]*\d') OR regexp_matches(s, '\d[^\s\p{Z}]*[\s\p{Z}]*$'))"),
    "position_features": f"""
        WITH {_VOL}, n AS (SELECT *, count(*) OVER (PARTITION BY book_id) AS n FROM pg),
        r AS (SELECT *, round_even(page_no / n::DOUBLE, 2) AS r FROM n)
        SELECT book_id, page_no, (page_no <= 10)::INT AS first10, (n - page_no <= 10)::INT AS last10, round(r * 100)::INT AS ratio,
               CASE WHEN r <= 0.2 THEN 1 WHEN r <= 0.4 THEN 2 WHEN r <= 0.6 THEN 3 WHEN r <= 0.8 THEN 4 ELSE 5 END AS quintile FROM r""",
    "ngram_counts": f"""
        WITH {_VOL}, w AS (SELECT list_filter(string_split({_CLEAN.format("array_to_string(lines, ' ')")}, ' '), lambda x: x <> '') AS w FROM pg),
        g AS (SELECT n, unnest([array_to_string(w[i:i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS gram
              FROM w, (SELECT unnest([1, 2, 3]) AS n) WHERE len(w) >= n)
        SELECT n::INT AS n, gram, count(*) AS count FROM g GROUP BY ALL""",
    "text_tiling": f"""
        WITH {_EDGE}, w AS (SELECT DISTINCT book_id, pos, unnest(string_split({_CLEAN.format("array_to_string(lines, ' ')")}, ' ')) AS w FROM pos),
        v AS (SELECT * FROM w WHERE w <> ''),
        c AS (SELECT a.book_id, a.page_no, a.pos, v.w, count(*) FILTER (v.pos <= a.pos) AS p, count(*) FILTER (v.pos > a.pos) AS s
              FROM pos a JOIN v ON v.book_id = a.book_id GROUP BY ALL),
        d AS (SELECT book_id, page_no, pos, sum(p * s) AS ps, sum(p * p) AS pp, sum(s * s) AS ss FROM c GROUP BY ALL),
        n AS (SELECT book_id, max(pos) AS n FROM pos GROUP BY ALL)
        SELECT pos.book_id, pos.page_no, CASE WHEN pp > 0 AND ss > 0 THEN round_even(ps / sqrt(pp::DOUBLE * ss), 3) ELSE 0.0 END AS cosine
        FROM pos JOIN n USING (book_id) LEFT JOIN d USING (book_id, pos) WHERE pos.pos < n.n""",
    "offset_votes": f"""
        WITH {_VOL}, t AS (SELECT DISTINCT book_id, page_no, unnest(regexp_split_to_array(array_to_string(
                [lines[i] FOR i IN range(1, len(lines) + 1) IF i <= 5 OR i > len(lines) - 5], ' '), '\\s+')) AS t FROM pg WHERE page_no > 0),
        c AS (SELECT book_id, page_no - t::INT AS o FROM t WHERE regexp_matches(t, '^[0-9]{{1,9}}$') AND abs(page_no - t::INT) < 25),
        v AS (SELECT book_id, o, count(*) AS votes FROM (SELECT book_id, o FROM c) GROUP BY ALL)
        SELECT DISTINCT ON (book_id) book_id, o AS "offset", votes FROM v ORDER BY book_id, votes DESC, o""",
    "label_runs": """
        WITH l AS (SELECT book_id, page_no, arg_min_null(lang, page_id) AS label FROM page
                   WHERE book_id IS NOT NULL AND page_no IS NOT NULL GROUP BY ALL),
        c AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR label IS DISTINCT FROM lag(label) OVER w THEN 1 ELSE 0 END AS b FROM l
              WINDOW w AS (PARTITION BY book_id ORDER BY page_no)),
        r AS (SELECT *, sum(b) OVER (PARTITION BY book_id ORDER BY page_no) AS run FROM c),
        g AS (SELECT book_id, run, min(page_no) AS start, max(page_no) AS last, any_value(label) AS label, count(*) AS pages FROM r GROUP BY ALL)
        SELECT book_id, start, coalesce(lead(start) OVER (PARTITION BY book_id ORDER BY run), last + 1) AS "end", label, pages FROM g""",
    "page_number_runs": f"""
        WITH {_EDGE}, x AS (SELECT *, CASE WHEN trim(lines[-1]) = '' AND len(lines) > 1 THEN len(lines) - 2 ELSE len(lines) - 1 END AS i
                            FROM pos WHERE len(lines) > 0),
        y AS (SELECT book_id, pos, i, [d FOR d IN regexp_extract_all(lines[i + 1], '\\d+') IF length(d) <= 4] AS d FROM x),
        z AS (SELECT book_id, pos, i, d[1]::INT AS number FROM y WHERE len(d) = 1),
        b AS (SELECT *, CASE WHEN number <> lag(number) OVER (PARTITION BY book_id ORDER BY pos) + 1 THEN 1 ELSE 0 END AS b FROM z),
        r AS (SELECT *, sum(b) OVER (PARTITION BY book_id ORDER BY pos) AS run FROM b),
        s AS (SELECT *, count(*) OVER (PARTITION BY book_id, run) AS n FROM r)
        SELECT book_id, pos::INT AS pos, i::INT AS "at", number FROM s WHERE n >= 3""",
    "context_features": f"""
        WITH {_VOL}, f AS (
            SELECT book_id, page_no, 'lines' AS feature, len(lines)::DOUBLE AS value FROM pg UNION ALL
            SELECT book_id, page_no, 'blank', len([s FOR s IN lines IF s = ''])::DOUBLE FROM pg),
        j AS (SELECT unnest([1, 2, 3]) AS j)
        SELECT * FROM f UNION ALL
        SELECT p.book_id, p.page_no, 'prev_' || j || '_' || f.feature, f.value FROM pg p CROSS JOIN j JOIN f ON f.book_id = p.book_id AND f.page_no = p.page_no - j
        UNION ALL
        SELECT p.book_id, p.page_no, 'foll_' || j || '_' || f.feature, f.value FROM pg p CROSS JOIN j JOIN f ON f.book_id = p.book_id AND f.page_no = p.page_no + j
        WHERE EXISTS (SELECT 1 FROM pg b WHERE b.book_id = p.book_id AND b.page_no = p.page_no - j)""",
}
