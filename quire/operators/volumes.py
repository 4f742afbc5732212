"""Scanned volumes: running headers, page numbers, edge cleaning, hyphens, paragraphs.

A volume is (book_id, page_no, lines array<string>), one row per page. Pages are
ordered by number; rows without a book or number are left out.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.functions.types import STRINGS
from quire.operators.graph import connected_components
from quire.operators.windows import edge_length, first_most_common, islands

#: Lines looked at on either edge, following pages compared, and sizes that count.
EDGE, NEIGHBOURS, RATIO, CLUSTER, SHORTEST = 3, 5, 0.7, 3, 4


def volume(pages: DataFrame, text: str = "page_body") -> DataFrame:
    """One row per page: of pages delivered twice the one with the least ``page_id``.
    A null text has no lines."""
    return (
        pages.where("book_id is not null and page_no is not null")
        .groupBy("book_id", "page_no")
        .agg(F.min_by(F.coalesce(F.col(text), F.lit("")), "page_id").alias("t"))
        .select("book_id", "page_no", tx.lines_of("t").alias("lines"))
    )


def positions(pages: DataFrame) -> DataFrame:
    """Rank of every page in its volume, from 1."""
    return pages.withColumn("pos", F.row_number().over(Window.partitionBy("book_id").orderBy("page_no")))


def edge_lines(pages: DataFrame) -> DataFrame:
    """First and last three lines of a page whose cleaned text has four characters or more."""
    long = positions(pages).select("book_id", "page_no", "pos", F.size("lines").alias("n"), F.posexplode("lines").alias("at", "line"))
    sides = F.array(
        F.when(F.col("at") < EDGE, F.lit("header")),
        F.when(F.col("at") >= F.col("n") - EDGE, F.lit("footer")),
    )
    return (
        long.withColumn("clean", tx.clean_line("line"))
        .where(F.length("clean") >= SHORTEST)
        .select("book_id", "page_no", "pos", "at", "clean", F.explode(F.array_compact(sides)).alias("side"))
    )


def similar_lines(edges: DataFrame) -> DataFrame:
    """Pairs of edge lines of a side at most five pages apart with similarity of 0.7 or more.

    The distance is an equi-join: every line is sent to the five following positions.
    """
    a = edges.select("book_id", "side", F.col("pos").alias("pos_a"), F.col("at").alias("at_a"), F.col("clean").alias("a")).withColumn(
        "pos", F.explode(F.transform(F.sequence(F.lit(1), F.lit(NEIGHBOURS)), lambda k: F.col("pos_a") + k))
    )
    b = edges.select("book_id", "side", "pos", F.col("at").alias("at_b"), F.col("clean").alias("b"))
    return (
        a.join(b, ["book_id", "side", "pos"])
        .where(tx.similar(F.col("a"), F.col("b"), RATIO))
        .select("book_id", "side", "pos_a", "at_a", F.col("pos").alias("pos_b"), "at_b")
    )


def running_lines(edges: DataFrame) -> DataFrame:
    """(book_id, side, pos, at, cluster): edge lines in a component of three or more similar lines."""
    pairs = similar_lines(edges)
    node = lambda p, a: F.concat_ws("\x01", "book_id", "side", F.format_string("%09d", p), F.format_string("%04d", a))
    whole = connected_components(pairs.select("book_id", node("pos_a", "at_a").alias("a"), node("pos_b", "at_b").alias("b")), "a", "b", within="book_id")
    sizes = whole.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(f"n >= {CLUSTER}")
    part = F.split("node", "\x01")
    return whole.join(sizes, "component").select(
        part[0].alias("book_id"), part[1].alias("side"), part[2].cast("int").alias("pos"), part[3].cast("int").alias("at"), F.col("component").alias("cluster")
    )


def page_number_runs(pages: DataFrame) -> DataFrame:
    """Page numbers on the last line (or the one before a blank last line) that rise by one
    from candidate to candidate over three pages or more: (book_id, pos, at, number)."""
    last = positions(pages).withColumn("n", F.size("lines")).where("n > 0")
    at = F.when((F.trim(F.element_at("lines", -1)) == "") & (F.col("n") > 1), F.col("n") - 2).otherwise(F.col("n") - 1)
    found = last.withColumn("at", at).withColumn("numbers", F.regexp_extract_all(F.get("lines", F.col("at")), F.lit(r"(?<!\d)(\d{1,4})(?!\d)"), F.lit(1)))
    one = found.where(F.size("numbers") == 1).select("book_id", "pos", "at", F.col("numbers")[0].cast("int").alias("number"))
    w = Window.partitionBy("book_id").orderBy("pos")
    runs = islands(one, ["book_id"], ["pos"], F.col("number") != F.lag("number").over(w) + 1)
    long = runs.groupBy("book_id", "island").agg(F.count(F.lit(1)).alias("size")).where(f"size >= {CLUSTER}")
    return runs.join(long, ["book_id", "island"]).select("book_id", "pos", "at", "number")


def page_structure(pages: DataFrame) -> DataFrame:
    """Header and footer lines of every page: (book_id, page_no, n_header, n_footer, header, body, footer).

    Numbers at the foot count only in volumes without any running footer.
    """
    running = running_lines(edge_lines(pages))
    footed = running.where("side = 'footer'").select("book_id").distinct()
    numbers = page_number_runs(pages).join(footed, "book_id", "left_anti").select("book_id", F.lit("footer").alias("side"), "pos", "at")
    marks = running.select("book_id", "side", "pos", "at").unionByName(numbers)
    per = marks.groupBy("book_id", "pos").agg(
        F.max(F.when(F.col("side") == "header", F.col("at") + 1)).alias("h"), F.min(F.when(F.col("side") == "footer", F.col("at"))).alias("f")
    )
    n = F.size("lines")
    return (
        positions(pages)
        .join(per, ["book_id", "pos"], "left")
        .withColumn("n_header", F.coalesce("h", F.lit(0)))
        .withColumn("n_footer", F.greatest(F.lit(0), F.least(n - F.coalesce("f", n), n - F.col("n_header"))))
        .select(
            "book_id",
            "page_no",
            "n_header",
            "n_footer",
            F.slice("lines", F.lit(1), F.col("n_header")).alias("header"),
            F.slice("lines", F.col("n_header") + 1, n - F.col("n_header") - F.col("n_footer")).alias("body"),
            F.when(F.col("n_footer") > 0, F.slice("lines", n - F.col("n_footer") + 1, F.col("n_footer"))).otherwise(F.array().cast("array<string>")).alias("footer"),
        )
    )


# edge cleaning -----------------------------------------------------------------


def has_letter(line: Column) -> Column:
    return line.rlike(r"\p{L}")


def numeral_at_end(line: Column) -> Column:
    """Whether the first or last word of a line holds a digit."""
    return line.rlike(r"(?U)^\s*\S*\d|\d\S*\s*$")


def heading_like(line: Column) -> Column:
    """Whether a line is in capitals or in title case (every word begins with a capital)."""
    upper = line.rlike(r"\p{Lu}") & ~line.rlike(r"\p{Ll}")
    title = line.rlike(r"\p{Lu}") & ~line.rlike(r"(?U)(^|[^\p{L}])\p{Ll}|\p{L}\p{Lu}")
    return upper | title


def strip_edges(pages: DataFrame, drop: Callable[[Column], Column], tail: bool = True) -> DataFrame:
    """Take the leading (and trailing) lines for which ``drop`` holds off the body:
    ``lines`` shrinks, ``cut_head`` and ``cut_tail`` say by how many."""
    keep = F.transform("lines", lambda s: ~drop(s))
    head = edge_length(F.col("lines"), keep)
    marked = pages.withColumn("cut_head", head)
    foot = edge_length(F.col("lines"), F.reverse(keep)) if tail else F.lit(0)
    marked = marked.withColumn("cut_tail", F.least(foot, F.size("lines") - F.col("cut_head")))
    return marked.withColumn("lines", F.slice("lines", F.col("cut_head") + 1, F.size("lines") - F.col("cut_head") - F.col("cut_tail")))


def strip_unlettered(pages: DataFrame) -> DataFrame:
    return strip_edges(pages, lambda s: ~has_letter(s))


def strip_numerals(pages: DataFrame) -> DataFrame:
    return strip_edges(pages, numeral_at_end)


def strip_headings(pages: DataFrame) -> DataFrame:
    return strip_edges(pages, heading_like, tail=False)


def if_majority(pages: DataFrame, change: Callable[[DataFrame], DataFrame], ratio: float = 0.5) -> DataFrame:
    """Apply a stripping to a volume only if it changes at least ``ratio`` of its pages."""
    kept = pages.withColumnRenamed("lines", "_before").withColumn("lines", F.col("_before"))
    changed = change(kept).withColumn("_changed", (F.size("lines") < F.size("_before")).cast("int"))
    share = F.avg("_changed").over(Window.partitionBy("book_id"))
    done = changed.withColumn("_share", share).withColumn("applied", F.col("_share") >= ratio)
    return done.withColumn("lines", F.when(F.col("applied"), F.col("lines")).otherwise(F.col("_before"))).drop("_before", "_changed", "_share")


def strip_unknown_words(pages: DataFrame, vocabulary: DataFrame, unknown: float = 0.75) -> DataFrame:
    """Take off edge lines that are blank, begin or end with a numeral, or have more than
    ``unknown`` of their words outside ``vocabulary`` (word). A last line of one word that
    ends a sentence stays."""
    long = pages.select("book_id", "page_no", F.size("lines").alias("n"), F.posexplode("lines").alias("at", "line"))
    words = long.select("book_id", "page_no", "at", F.explode(F.split(tx.clean_line("line"), " ")).alias("word")).where("word <> ''")
    known = vocabulary.select("word").distinct().withColumn("known", F.lit(1))
    shares = words.join(known, "word", "left").groupBy("book_id", "page_no", "at").agg((1 - F.sum(F.coalesce("known", F.lit(0))) / F.count(F.lit(1))).alias("odd"))
    closing = (F.col("at") == F.col("n") - 1) & F.trim("line").rlike(r"^\p{L}+[.!?][\"'”’]?$")
    flags = long.join(shares, ["book_id", "page_no", "at"], "left").withColumn(
        "keep", closing | ~((F.trim("line") == "") | numeral_at_end(F.col("line")) | (F.coalesce("odd", F.lit(1.0)) > unknown))
    )
    per = flags.groupBy("book_id", "page_no").agg(F.array_sort(F.collect_list(F.struct("at", "keep"))).alias("k")).select("book_id", "page_no", F.col("k.keep").alias("keep"))
    joined = pages.join(per, ["book_id", "page_no"], "left").withColumn("keep", F.coalesce("keep", F.array().cast("array<boolean>")))
    joined = joined.withColumn("cut_head", edge_length(F.col("lines"), F.col("keep")))
    joined = joined.withColumn("cut_tail", F.least(edge_length(F.col("lines"), F.reverse("keep")), F.size("lines") - F.col("cut_head")))
    return joined.withColumn("lines", F.slice("lines", F.col("cut_head") + 1, F.size("lines") - F.col("cut_head") - F.col("cut_tail"))).drop("keep")


def heading_lines(lines: Column) -> Column:
    """Number of leading lines that are headings or hold only numbers."""
    return edge_length(lines, F.transform(lines, lambda s: ~(heading_like(s) | ~has_letter(s))))


def strip_usual(pages: DataFrame, share: float = 0.25) -> DataFrame:
    """Where more than ``share`` of a volume's pages begin with heading lines, take off as
    many as is most usual (of the numbers seen equally often the first), at most the own."""
    counted = pages.withColumn("_own", heading_lines(F.col("lines")))
    usual = first_most_common(counted.where("_own > 0"), ["book_id"], "_own", "page_no").withColumnRenamed("_own", "_usual")
    often = counted.groupBy("book_id").agg(F.avg((F.col("_own") > 0).cast("int")).alias("_share"))
    both = counted.join(often, "book_id").join(usual, "book_id", "left")
    cut = F.when(F.col("_share") > share, F.least("_own", F.coalesce("_usual", F.lit(0)))).otherwise(0)
    return both.withColumn("cut_head", cut.cast("int")).withColumn("lines", F.slice("lines", F.col("cut_head") + 1, F.size("lines"))).drop("_own", "_usual", "_share")


def clean_edges(pages: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """All edge cleaning in order: unlettered lines, numerals, majority headings, unknown words, usual headings."""
    out = strip_numerals(strip_unlettered(pages))
    out = if_majority(out, strip_headings)
    out = strip_unknown_words(out, vocabulary)
    return strip_usual(out).select("book_id", "page_no", "lines")


# hyphens and paragraphs ----------------------------------------------------------

_LAST_HYPHEN = r"(?U)(\S*[^\s\-])-\s*$"


def join_within(lines: list[str]) -> list[str]:
    """A line that ends in a hyphen takes the first word of the next line; a line left
    empty by that is dropped."""
    out: list[str] = []
    for line in lines:
        if out and out[-1].endswith("-") and not out[-1].endswith("--") and line.strip():
            word, _, rest = line.strip().partition(" ")
            out[-1] = out[-1][:-1] + word
            if rest.strip():
                out.append(rest.strip())
            continue
        out.append(line)
    return out


@F.pandas_udf(STRINGS)
def joined_lines(lines: pd.Series) -> pd.Series:
    return lines.map(lambda x: join_within([s.rstrip() for s in x]), na_action="ignore")


def dehyphenate(pages: DataFrame) -> DataFrame:
    """Rejoin words broken at line ends and, past blank lines, at page ends: the earlier
    page takes the first word of the next page."""
    placed = positions(pages).withColumn("text", F.filter("lines", lambda s: F.trim(s) != ""))
    here = placed.withColumn("hangs", (F.size("text") > 0) & F.element_at(F.concat(F.array(F.lit("")), "text"), -1).rlike(r"[^\-\s]-\s*$"))
    word = F.regexp_extract(F.try_element_at("text", F.lit(1)), r"(?U)^\s*(\S+)", 1)
    ahead = here.select("book_id", (F.col("pos") - 1).alias("pos"), word.alias("next_word"))
    behind = here.select("book_id", (F.col("pos") + 1).alias("pos"), F.col("hangs").alias("owed"))
    both = here.join(ahead, ["book_id", "pos"], "left").join(behind, ["book_id", "pos"], "left")
    # give the first word away, then take the next page's
    first = F.try_element_at("lines", F.lit(1))
    given = F.when(
        F.coalesce("owed", F.lit(False)) & (F.size("text") > 0),
        F.transform("lines", lambda s, i: F.when(i == F.array_position("lines", F.try_element_at("text", F.lit(1))) - 1, F.regexp_replace(s, r"(?U)^\s*\S+\s*", "")).otherwise(s)),
    ).otherwise(F.col("lines"))
    both = both.withColumn("lines", given)
    at = F.size("lines") - F.array_position(F.transform(F.reverse("lines"), lambda s: F.trim(s) != ""), F.lit(True))
    taken = F.when(
        F.col("hangs") & (F.coalesce("next_word", F.lit("")) != ""),
        F.transform("lines", lambda s, i: F.when(i == at, F.concat(F.regexp_replace(s, r"-\s*$", ""), "next_word")).otherwise(s)),
    ).otherwise(F.col("lines"))
    return both.withColumn("lines", taken).select("book_id", "page_no", joined_lines("lines").alias("lines"))


def reparagraph(lines: DataFrame) -> DataFrame:
    """Lines (book_id, line_no, line, is_header) as paragraphs: a line runs on into the next
    unless it ends a sentence and the next begins with a quote or capital; headers stand alone."""
    w = Window.partitionBy("book_id").orderBy("line_no")
    before, header = F.lag("line").over(w), F.coalesce("is_header", F.lit(False))
    ends = F.rtrim(before).rlike(r"[.?!\"']$")
    begins = F.ltrim("line").rlike(r"^[\"'\p{Lu}]")
    marked = lines.where(F.trim("line") != "").withColumn("is_header", header)
    marked = islands(marked, ["book_id"], ["line_no"], before.isNull() | (ends & begins) | F.col("is_header") | F.lag("is_header").over(w), "para_no")
    return (
        marked.groupBy("book_id", "para_no")
        .agg(F.array_sort(F.collect_list(F.struct("line_no", F.trim("line").alias("t")))).alias("l"), F.max("is_header").alias("is_header"))
        .select("book_id", "para_no", "is_header", F.array_join(F.col("l.t"), " ").alias("text"))
    )
