"""Plain-text books: markup, paragraphs, headings, names and characters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators import annotation
from quire.operators import characters as ch
from quire.operators import headings as hd
from quire.operators import markup as mk
from quire.runtime import table
from quire.sources import exports


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "book").where("body is not null").select("book_id", F.col("body").alias("text"))


def split_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mk.split_notices(_bodies(spark, sf_dir))


def book_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mk.paragraphs(_bodies(spark, sf_dir), "text").select("book_id", "para_no", "text")


def markup_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = table(spark, sf_dir, "documents").select("doc_id", F.explode(mk.markup_spans("text")).alias("s"))
    return spans.select("doc_id", "s.start", "s.end", "s.tag", "s.text")


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of the pages, parted by blank lines, as paragraphs of the volumes."""
    page = table(spark, sf_dir, "page").where("book_id is not null and page_no is not null and page_body is not null")
    one = page.groupBy("book_id", "page_no").agg(F.min_by("page_body", "page_id").alias("t"))
    parts = one.select("book_id", "page_no", F.posexplode(F.split("t", r"\n[^\S\n]*\n\s*")).alias("at", "text")).where(F.trim("text") != "")
    order = Window.partitionBy("book_id").orderBy("page_no", "at")
    return parts.select("book_id", F.row_number().over(order).alias("para_no"), F.trim("text").alias("text"))


def heading_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hd.match_headings(_blocks(spark, sf_dir)).drop("bare_title", "bare_upper")


def headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hd.headings(_blocks(spark, sf_dir))


def headings_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hd.headings(_blocks(spark, sf_dir), upper_only=True)


def _headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.col("text").rlike(r"^\S+ [IVXLC]+\.$") & ~F.contains("text", F.lit("\n"))
    return _blocks(spark, sf_dir).withColumn("is_header", header)


def _with_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with the headings that the heading operator finds."""
    blocks = _blocks(spark, sf_dir)
    found = hd.headings(blocks).select("book_id", "para_no", F.lit(True).alias("is_header"))
    return blocks.join(found, ["book_id", "para_no"], "left")


def settled_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of the bodies with lines of signs as separators and capitals as headers."""
    paras = mk.paragraphs(_bodies(spark, sf_dir), "text").withColumn("is_header", F.col("text").rlike(r"^[A-Z]{2,}[^a-z]*$"))
    return mk.settle_stars(paras).select("book_id", "para_no", "star", "is_header")


def headed_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mk.regions(_with_headings(spark, sf_dir)).select("book_id", "para_no", "is_header", "region")


def headed_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mk.sections(mk.nest(_with_headings(spark, sf_dir)))


def body_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings in the paragraphs of the delivered bodies."""
    return hd.headings(mk.paragraphs(_bodies(spark, sf_dir), "text").where("not star"))


def book_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mk.regions(_headed(spark, sf_dir)).select("book_id", "para_no", "is_header", "region")


def nested_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mk.nest(_headed(spark, sf_dir)).select("book_id", "para_no", "is_header", "header_no")


def book_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mk.sections(mk.nest(_headed(spark, sf_dir)))
    return out.select("book_id", "header_no", "text", F.array_join(F.transform("end_offsets", lambda x: x.cast("string")), " ").alias("end_offsets"))


def capital_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _blocks(spark, sf_dir)
    return b.where(tx.capital_share("text") > 0.75).select("book_id", "para_no", tx.raise_capitals("text").alias("text"))


def plain_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ASCII renderings of the paragraphs without forbidden characters and doubled quotes."""
    p = table(spark, sf_dir, "p")
    return p.select("para_id", tx.transliterate(tx.plain_quotes(tx.xml_safe("text"))).alias("text"))


def roman_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page footers that are Roman numerals, with their values."""
    f = table(spark, sf_dir, "page").select("page_id", F.trim("page_footer").alias("numeral"))
    return f.withColumn("value", tx.roman_value("numeral")).where("value is not null")


def number_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers 0..200 spelt out and read back."""
    rows = [(n, tx.cardinal(n), tx.ordinal(n)) for n in range(201)]
    df = spark.createDataFrame(rows, "n int, cardinal string, ordinal string")
    return df.select("n", "cardinal", "ordinal", tx.number_word_value(F.upper("cardinal")).alias("cardinal_value"), tx.number_word_value(F.initcap("ordinal")).alias("ordinal_value"))


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.distinct_tokens(table(spark, sf_dir, "tokens"))


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.person_mentions(table(spark, sf_dir, "entities"))


def person_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir)


def absorbed_honorifics(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _people(spark, sf_dir)
    spans = table(spark, sf_dir, "entities").select("book_id", F.col("start_tok_num").alias("start_tok"), F.col("end_tok_num").alias("end_tok")).where("start_tok is not null")
    return ch.absorb_honorifics(people, _words(spark, sf_dir), spans)


def frequent_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.frequent_mentions(_people(spark, sf_dir))


def phrase_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.phrase_search(_words(spark, sf_dir), frequent_mentions(spark, sf_dir))


def complete_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.complete_entities(table(spark, sf_dir, "entities"), _words(spark, sf_dir))


def consecutive_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of person tokens by their tag."""
    t = table(spark, sf_dir, "tokens").where("ner = 'PERSON' and tok_num_in_doc is not null")
    one = t.groupBy("book_id", F.col("tok_num_in_doc").alias("tok_num")).agg(F.min("word").alias("word"))
    return ch.consecutive_phrases(one)


def pronoun_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.pronoun_references(_words(spark, sf_dir), _people(spark, sf_dir))


def reference_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = ch.reference_counts(pronoun_references(spark, sf_dir))
    return c.withColumn("gender", ch.counted_gender(F.col("male"), F.col("female")))


def parsed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of all spellings in the ``names`` of the character table."""
    names = table(spark, sf_dir, "characters").select(F.explode(F.map_keys("names")).alias("name")).distinct()
    parsed = ch.parse_names(names)
    return parsed.withColumn("gender", ch.honorific_gender(F.col("honorific")))


def nearest_honorifics(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = ch.parse_names(_absorbed(spark, sf_dir), "phrase")
    named = parsed.withColumn("name", F.coalesce("generic_name", F.concat_ws(" ", "first_name", "last_name"))).withColumn("gender", ch.honorific_gender(F.col("honorific")))
    return ch.nearest_honorific(named.withColumn("gender", F.lit(None).cast("string"))).select("book_id", "tok_num", "name", "honorific")


def _absorbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return absorbed_honorifics(spark, sf_dir).withColumnRenamed("start_tok", "tok_num")


def resolved_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = ch.parse_names(_absorbed(spark, sf_dir), "phrase")
    return ch.resolve_generic(parsed.withColumn("gender", ch.honorific_gender(F.col("honorific")))).select("book_id", "tok_num", "generic_name", "first_name", "last_name", "gender")


def chain_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pronouns through chains: all mentions of one spelling and the pronouns right after them."""
    people, words = _people(spark, sf_dir).where("phrase is not null"), _words(spark, sf_dir)
    said = pronoun_references(spark, sf_dir).select("book_id", F.col("phrase").alias("chain"), F.col("tok_num").alias("start_tok"), F.col("tok_num").alias("end_tok"))
    mentions = people.select("book_id", F.col("phrase").alias("chain"), "start_tok", "end_tok").unionByName(said)
    return ch.chain_references(annotation.antecedents(mentions), people, words)


def name_genders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genders of the delivered characters by their names: those names that the table itself
    shows with one gender only."""
    c = table(spark, sf_dir, "characters")
    known = c.where("gender is not null").select(F.coalesce("first_name", "generic_name").alias("name"), "gender")
    return ch.name_gender(c.select("char_uid", "first_name", "generic_name"), known.where("name is not null"))


def character_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.characters(table(spark, sf_dir, "entities"), table(spark, sf_dir, "tokens")).drop("names")


def character_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.characters_json(ch.characters(table(spark, sf_dir, "entities"), table(spark, sf_dir, "tokens")))


def ranked_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivered character rows rolled up by name, genders filled and ranked again."""
    c = table(spark, sf_dir, "characters").select("book_id", "last_name", "first_name", "generic_name", "gender", F.col("count").cast("long").alias("count"))
    rolled = c.groupBy("book_id", "last_name", "first_name", "generic_name", "gender").agg(F.sum("count").alias("count"))
    return ch.rank_characters(ch.fill_genders(rolled))


QUERIES = {
    f.__name__: f
    for f in (
        split_notices, book_paragraphs, markup_spans, heading_matches, headings, headings_upper, body_headings, settled_stars, headed_regions, headed_sections, book_regions, nested_paragraphs, book_sections,
        capital_paragraphs, plain_texts, roman_values, number_words, person_mentions, absorbed_honorifics, frequent_mentions, phrase_search,
        complete_entities, consecutive_phrases, pronoun_references, reference_counts, parsed_names, nearest_honorifics, resolved_names, chain_references, name_genders,
        character_table, character_json, ranked_characters,
    )
}

_PEOPLE = """people AS (
    SELECT book_id, start_tok_num AS start_tok, end_tok_num AS end_tok, min(phrase) AS phrase FROM entities
    WHERE ner = 'PERSON' AND start_tok_num IS NOT NULL GROUP BY ALL)"""
_TOK = """words AS (
    SELECT book_id, tok_num_in_doc AS tok_num, min(word) AS word FROM tokens WHERE tok_num_in_doc IS NOT NULL GROUP BY ALL)"""
_BLOCKS = r"""blocks AS (
    SELECT book_id, (row_number() OVER (PARTITION BY book_id ORDER BY page_no, i))::INT AS para_no, trim(text) AS text FROM (
        SELECT book_id, page_no, unnest(range(len(x)))::INT AS i, unnest(x) AS text FROM (
            SELECT book_id, page_no, regexp_split_to_array(arg_min(page_body, page_id), '\n[^\S\n]*\n\s*') AS x FROM page
            WHERE book_id IS NOT NULL AND page_no IS NOT NULL AND page_body IS NOT NULL GROUP BY ALL))
    WHERE trim(text) <> '')"""
_HEADED = _BLOCKS + r""", headed AS (SELECT *, regexp_matches(text, '^\S+ [IVXLC]+\.$') AND NOT contains(text, chr(10)) AS is_header FROM blocks)"""


def _in(words: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


# parts of the names of persons with the honorifics before them
_PARSED = rf"""ti AS (
            SELECT w.book_id, w.tok_num + 1 AS start_tok, w.word FROM words w WHERE lower(w.word) IN {_in(ch.HONORIFICS)} AND NOT EXISTS (
                SELECT 1 FROM entities e WHERE e.book_id = w.book_id AND w.tok_num BETWEEN e.start_tok_num AND e.end_tok_num)),
        ab AS (SELECT p.book_id, CASE WHEN ti.word IS NULL THEN p.start_tok ELSE p.start_tok - 1 END AS tok_num, concat_ws(' ', ti.word, p.phrase) AS phrase
              FROM people p LEFT JOIN ti USING (book_id, start_tok)),
        pw AS (SELECT *, list_filter(regexp_split_to_array(trim(phrase), '\s+'), lambda x: x <> '') AS w FROM ab),
        ph AS (SELECT *, len(w) > 1 AND lower(w[1]) IN {_in(ch.HONORIFICS)} AS has FROM pw),
        pr AS (SELECT book_id, tok_num, CASE WHEN has THEN w[1] END AS hon, CASE WHEN has THEN w[2:] ELSE w END AS r FROM ph),
        parsed AS (SELECT book_id, tok_num, hon,
            CASE WHEN len(r) = 1 THEN r[1] WHEN len(r) > 3 THEN array_to_string(r, ' ') END AS generic_name,
            CASE WHEN len(r) IN (2, 3) AND NOT regexp_full_match(r[1], '.\.?') THEN r[1] END AS first_name,
            CASE WHEN len(r) IN (2, 3) AND NOT regexp_full_match(r[-1], '.\.?') THEN r[-1] END AS last_name,
            CASE WHEN lower(hon) IN {_in(ch.MALE_HONORIFICS)} THEN 'male' WHEN lower(hon) IN {_in(ch.FEMALE_HONORIFICS)} THEN 'female' END AS gender FROM pr)"""
SQL = {
    "person_mentions": f"WITH {_PEOPLE} SELECT * FROM people",
    "frequent_mentions": f"WITH {_PEOPLE} SELECT book_id, phrase, count(*) AS n FROM people WHERE phrase IS NOT NULL GROUP BY ALL HAVING count(*) >= 2",
    "absorbed_honorifics": f"""
        WITH {_PEOPLE}, {_TOK}, t AS (
            SELECT w.book_id, w.tok_num + 1 AS start_tok, w.word FROM words w WHERE lower(w.word) IN {_in(ch.HONORIFICS)} AND NOT EXISTS (
                SELECT 1 FROM entities e WHERE e.book_id = w.book_id AND w.tok_num BETWEEN e.start_tok_num AND e.end_tok_num))
        SELECT p.book_id, CASE WHEN t.word IS NULL THEN p.start_tok ELSE p.start_tok - 1 END AS start_tok, p.end_tok, concat_ws(' ', t.word, p.phrase) AS phrase
        FROM people p LEFT JOIN t USING (book_id, start_tok)""",
    "phrase_search": rf"""
        WITH {_PEOPLE}, {_TOK}, f AS (
            SELECT book_id, phrase, string_split_regex(phrase, '\s+') AS w FROM people WHERE phrase IS NOT NULL AND phrase <> '' GROUP BY ALL HAVING count(*) >= 2),
        h AS (SELECT f.book_id, f.phrase, len(f.w) AS n, t.tok_num - i.i + 1 AS start_tok, i.i
              FROM f, LATERAL (SELECT unnest(range(1, len(f.w) + 1)) AS i) i JOIN words t ON t.book_id = f.book_id AND t.word = f.w[i.i])
        SELECT book_id, start_tok::INT AS start_tok, (start_tok + n - 1)::INT AS end_tok, phrase FROM h
        GROUP BY book_id, phrase, n, start_tok HAVING count(DISTINCT i) = n""",
    "consecutive_phrases": """
        WITH t AS (SELECT book_id, tok_num_in_doc AS k, min(word) AS word FROM tokens WHERE ner = 'PERSON' AND tok_num_in_doc IS NOT NULL GROUP BY ALL),
        r AS (SELECT *, k - row_number() OVER (PARTITION BY book_id ORDER BY k) AS run FROM t)
        SELECT book_id, min(k) AS start_tok, max(k) AS end_tok, string_agg(word, ' ' ORDER BY k) AS phrase FROM r GROUP BY book_id, run""",
    "pronoun_references": f"""
        WITH {_PEOPLE}, {_TOK}, k AS (
            SELECT book_id, tok_num, CASE WHEN lower(word) IN {_in(ch.MALE_PRONOUNS)} THEN 'male' WHEN lower(word) IN {_in(ch.FEMALE_PRONOUNS)} THEN 'female'
                WHEN lower(word) IN {_in(ch.FIRST_PERSON)} THEN 'first' WHEN lower(word) IN {_in(ch.SECOND_PERSON)} THEN 'second' END AS kind FROM words),
        m AS (SELECT book_id, start_tok, max(phrase) AS phrase FROM people WHERE phrase IS NOT NULL GROUP BY ALL)
        SELECT k.book_id, k.tok_num, k.kind, m.phrase FROM (SELECT * FROM k WHERE kind IS NOT NULL) k
        ASOF JOIN m ON m.book_id = k.book_id AND m.start_tok <= k.tok_num""",
    "capital_paragraphs": rf"""
        WITH {_BLOCKS} SELECT book_id, para_no, upper(text) AS text FROM blocks
        WHERE length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) > 0.75 * length(regexp_replace(text, '[^\p{{L}}]', '', 'g'))""",
    "nested_paragraphs": f"""
        WITH {_HEADED}, f AS (SELECT book_id, min(para_no) AS p, arg_min(is_header, para_no) AS h FROM headed GROUP BY ALL),
        u AS (SELECT book_id, para_no, is_header FROM headed UNION ALL SELECT book_id, p - 1, true FROM f WHERE NOT h)
        SELECT *, sum(is_header::INT) OVER (PARTITION BY book_id ORDER BY para_no)::BIGINT AS header_no FROM u""",
    "book_sections": f"""
        WITH {_HEADED}, f AS (SELECT book_id, min(para_no) AS p, arg_min(is_header, para_no) AS h FROM headed GROUP BY ALL),
        u AS (SELECT book_id, para_no, text, is_header FROM headed UNION ALL SELECT book_id, p - 1, NULL, true FROM f WHERE NOT h),
        n AS (SELECT *, sum(is_header::INT) OVER (PARTITION BY book_id ORDER BY para_no)::BIGINT AS header_no FROM u),
        o AS (SELECT *, (sum(length(text) + 2) OVER (PARTITION BY book_id, header_no ORDER BY para_no))::BIGINT AS e FROM n WHERE NOT is_header)
        SELECT book_id, header_no, string_agg(text, chr(10) || chr(10) ORDER BY para_no) AS text, string_agg(e::VARCHAR, ' ' ORDER BY para_no) AS end_offsets
        FROM o GROUP BY book_id, header_no HAVING count(*) > 1""",
    "number_words": f"SELECT * FROM (VALUES {', '.join(str((n, tx.cardinal(n), tx.ordinal(n), n, n)) for n in range(201))}) t(n, cardinal, ordinal, cardinal_value, ordinal_value)",
    "roman_values": """
        WITH f AS (SELECT page_id, trim(page_footer) AS numeral FROM page WHERE regexp_full_match(trim(page_footer), '[MDCLXVImdclxvi]+')),
        c AS (SELECT page_id, numeral, generate_subscripts(string_split(upper(numeral), ''), 1) AS i, unnest(string_split(upper(numeral), '')) AS c FROM f),
        v AS (SELECT *, CASE c WHEN 'I' THEN 1 WHEN 'V' THEN 5 WHEN 'X' THEN 10 WHEN 'L' THEN 50 WHEN 'C' THEN 100 WHEN 'D' THEN 500 ELSE 1000 END AS v FROM c),
        m AS (SELECT *, max(v) OVER (PARTITION BY page_id ORDER BY i DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS later FROM v)
        SELECT page_id, numeral, sum(CASE WHEN v < coalesce(later, 0) THEN -v ELSE v END)::INT AS value FROM m GROUP BY ALL""",
    "reference_counts": f"""
        WITH {_PEOPLE}, {_TOK}, k AS (
            SELECT book_id, tok_num, CASE WHEN lower(word) IN {_in(ch.MALE_PRONOUNS)} THEN 'male' WHEN lower(word) IN {_in(ch.FEMALE_PRONOUNS)} THEN 'female'
                WHEN lower(word) IN {_in(ch.FIRST_PERSON)} THEN 'first' WHEN lower(word) IN {_in(ch.SECOND_PERSON)} THEN 'second' END AS kind FROM words),
        m AS (SELECT book_id, start_tok, max(phrase) AS phrase FROM people WHERE phrase IS NOT NULL GROUP BY ALL),
        r AS (SELECT k.book_id, k.kind, m.phrase FROM (SELECT * FROM k WHERE kind IS NOT NULL) k ASOF JOIN m ON m.book_id = k.book_id AND m.start_tok <= k.tok_num),
        c AS (SELECT book_id, phrase, count(*) FILTER (kind = 'male') AS male, count(*) FILTER (kind = 'female') AS female,
                     count(*) FILTER (kind = 'first') AS first, count(*) FILTER (kind = 'second') AS second FROM r GROUP BY ALL)
        SELECT *, CASE WHEN male > 1.1 * female THEN 'male' WHEN female > 1.1 * male THEN 'female' END AS gender FROM c""",
    "parsed_names": rf"""
        WITH n AS (SELECT DISTINCT unnest(map_keys(names)) AS name FROM characters),
        w AS (SELECT name, list_filter(regexp_split_to_array(trim(name), '\s+'), lambda x: x <> '') AS w FROM n),
        h AS (SELECT *, len(w) > 1 AND lower(w[1]) IN {_in(ch.HONORIFICS)} AS has FROM w),
        r AS (SELECT *, CASE WHEN has THEN w[1] END AS honorific, CASE WHEN has THEN w[2:] ELSE w END AS r FROM h),
        p AS (SELECT *, len(r) AS k, r[1] AS a, r[2] AS b, r[-1] AS z FROM r)
        SELECT name, honorific, CASE WHEN k = 1 THEN a WHEN k > 3 THEN array_to_string(r, ' ') END AS generic_name,
            CASE WHEN k IN (2, 3) AND NOT regexp_full_match(a, '.\.?') THEN a END AS first_name,
            CASE WHEN k IN (2, 3) AND regexp_full_match(a, '.\.?') THEN a[1] END AS first_initial,
            CASE WHEN k = 3 AND NOT regexp_full_match(b, '.\.?') THEN b END AS middle_name,
            CASE WHEN k = 3 AND regexp_full_match(b, '.\.?') THEN b[1] END AS middle_initial,
            CASE WHEN k IN (2, 3) AND NOT regexp_full_match(z, '.\.?') THEN z END AS last_name,
            CASE WHEN k IN (2, 3) AND regexp_full_match(z, '.\.?') THEN z[1] END AS last_initial,
            CASE WHEN lower(honorific) IN {_in(ch.MALE_HONORIFICS)} THEN 'male' WHEN lower(honorific) IN {_in(ch.FEMALE_HONORIFICS)} THEN 'female' END AS gender
        FROM p""",
    "book_regions": f"""
        WITH {_HEADED}, a AS (SELECT *, min(para_no) FILTER (is_header) OVER (PARTITION BY book_id) AS f,
                coalesce(max(para_no) FILTER (is_header) OVER (PARTITION BY book_id), -1) AS l,
                trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS w FROM headed),
        b AS (SELECT *, min(para_no) FILTER (w IN {_in(mk.BACK)} AND para_no > l) OVER (PARTITION BY book_id) AS e FROM a)
        SELECT book_id, para_no, is_header, CASE WHEN para_no < f THEN 'front' WHEN para_no >= e THEN 'back' ELSE 'body' END AS region FROM b""",
    "resolved_names": f"""
        WITH {_PEOPLE}, {_TOK}, {_PARSED},
        f AS (SELECT *, count(*) OVER (PARTITION BY book_id, first_name, last_name) AS n FROM parsed WHERE first_name IS NOT NULL AND last_name IS NOT NULL),
        refs AS (SELECT DISTINCT book_id, unnest([first_name, last_name]) AS key, tok_num AS t, first_name, last_name, gender AS g FROM f WHERE n >= 2),
        asks AS (SELECT DISTINCT book_id, tok_num, generic_name, gender FROM parsed WHERE generic_name IS NOT NULL),
        j AS (SELECT a.*, r.t, r.first_name, r.last_name, r.g,
                     CASE WHEN r.t IS NULL THEN 9 WHEN a.gender IS NULL OR r.g = a.gender THEN 0 WHEN r.g IS NULL THEN 1 ELSE 9 END AS tier
              FROM asks a LEFT JOIN refs r ON r.book_id = a.book_id AND r.key = a.generic_name AND r.t <> a.tok_num),
        k AS (SELECT *, row_number() OVER (PARTITION BY book_id, tok_num, generic_name, gender ORDER BY tier, t > tok_num, abs(t - tok_num)) AS k FROM j)
        SELECT book_id, tok_num, generic_name, CASE WHEN tier < 9 THEN first_name END AS first_name, CASE WHEN tier < 9 THEN last_name END AS last_name,
               coalesce(CASE WHEN tier < 9 THEN g END, gender) AS gender FROM k WHERE k = 1""",
    "complete_entities": rf"""
        WITH RECURSIVE spans AS (
            SELECT book_id, start_tok_num AS a, end_tok_num AS b, min(phrase) AS phrase, min(ner) AS ner FROM entities
            WHERE start_tok_num IS NOT NULL AND end_tok_num >= start_tok_num GROUP BY ALL),
        {_TOK}, q AS (
            SELECT book_id, phrase, string_split_regex(phrase, '\s+') AS w FROM spans WHERE ner = 'PERSON' AND phrase IS NOT NULL AND phrase <> '' GROUP BY ALL HAVING count(*) >= 2),
        h AS (SELECT q.book_id, q.phrase, len(q.w) AS n, t.tok_num - i.i + 1 AS a, i.i
              FROM q, LATERAL (SELECT unnest(range(1, len(q.w) + 1)) AS i) i JOIN words t ON t.book_id = q.book_id AND t.word = q.w[i.i]),
        found AS (SELECT book_id, a, a + n - 1 AS b, phrase FROM h GROUP BY book_id, phrase, n, a HAVING count(DISTINCT i) = n),
        cover AS (SELECT DISTINCT book_id, unnest(range(a, b + 1)) AS t FROM spans),
        k AS (SELECT f.book_id, f.a, f.b, f.phrase, count(c.t) AS k FROM found f LEFT JOIN cover c ON c.book_id = f.book_id AND c.t BETWEEN f.a AND f.b GROUP BY ALL),
        free AS (SELECT DISTINCT ON (book_id, a, b) book_id, a, b, phrase, row_number() OVER (PARTITION BY book_id ORDER BY a, b DESC) AS o FROM k WHERE k = 0),
        walk AS (SELECT book_id, o, a, b, phrase, true AS kept, b AS last FROM free WHERE o = 1 UNION ALL
                 SELECT f.book_id, f.o, f.a, f.b, f.phrase, f.a > w.last, CASE WHEN f.a > w.last THEN f.b ELSE w.last END
                 FROM walk w JOIN free f ON f.book_id = w.book_id AND f.o = w.o + 1)
        SELECT s.book_id, s.a::INT AS start_tok, s.b::INT AS end_tok, s.phrase,
               CASE WHEN EXISTS (SELECT 1 FROM k WHERE k.book_id = s.book_id AND k.a = s.a AND k.b = s.b AND k.k = k.b - k.a + 1) THEN 'PERSON' ELSE s.ner END AS ner
        FROM spans s UNION ALL
        SELECT book_id, a::INT, b::INT, phrase, 'PERSON' FROM walk WHERE kept""",
    "name_genders": """
        WITH k AS (SELECT lower(coalesce(first_name, generic_name)) AS name, min(gender) AS g FROM characters
                   WHERE gender IS NOT NULL AND coalesce(first_name, generic_name) IS NOT NULL GROUP BY ALL HAVING count(DISTINCT gender) = 1)
        SELECT char_uid, first_name, generic_name, k.g AS gender_name FROM characters c LEFT JOIN k ON k.name = lower(coalesce(first_name, generic_name))""",
    "nearest_honorifics": f"""
        WITH {_PEOPLE}, {_TOK}, {_PARSED}, n AS (SELECT *, coalesce(generic_name, concat_ws(' ', first_name, last_name)) AS name FROM parsed)
        SELECT book_id, tok_num, name, coalesce(hon, last_value(hon IGNORE NULLS) OVER (PARTITION BY book_id, name ORDER BY tok_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                first_value(hon IGNORE NULLS) OVER (PARTITION BY book_id, name ORDER BY tok_num ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS honorific FROM n""",
    "ranked_characters": """
        WITH r AS (SELECT book_id, last_name, first_name, generic_name, gender, sum("count")::BIGINT AS n FROM characters GROUP BY ALL),
        m AS (SELECT book_id, last_name, first_name, generic_name, arg_max(gender, (n, gender = 'female')) AS g FROM r WHERE gender IS NOT NULL GROUP BY ALL),
        f AS (SELECT r.book_id, r.last_name, r.first_name, r.generic_name, coalesce(r.gender, m.g) AS gender, sum(n)::BIGINT AS "count" FROM r
              LEFT JOIN m ON m.book_id IS NOT DISTINCT FROM r.book_id AND m.last_name IS NOT DISTINCT FROM r.last_name
                AND m.first_name IS NOT DISTINCT FROM r.first_name AND m.generic_name IS NOT DISTINCT FROM r.generic_name GROUP BY ALL)
        SELECT *, (row_number() OVER (PARTITION BY book_id ORDER BY "count" DESC, last_name DESC NULLS LAST, first_name DESC NULLS LAST,
                   generic_name NULLS LAST, gender NULLS LAST) - 1)::INT AS id FROM f WHERE "count" >= 2""",
}
