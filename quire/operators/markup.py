"""Plain-text books: distribution notices, inline markup, paragraphs, front and back matter."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from quire.functions import text as tx
from quire.functions.types import struct
from quire.operators.windows import islands

# How the last lines of a notice before the text begin.
START_PREFIXES = (
    "*END*THE SMALL PRINT", "*** START OF THE PROJECT GUTENBERG", "*** START OF THIS PROJECT GUTENBERG", "This etext was prepared by",
    "E-text prepared by", "Produced by", "Distributed Proofreading Team", "*END THE SMALL PRINT", "***START OF THE PROJECT GUTENBERG",
    "This etext was produced by", "*** START OF THE COPYRIGHTED", "The Project Gutenberg", "http://gutenberg.spiegel.de/ erreichbar.",
    "Project Runeberg publishes", "Beginning of this Project Gutenberg", "Project Gutenberg Online Distributed", "Gutenberg Online Distributed",
    "the Project Gutenberg Online Distributed", "Project Gutenberg TEI", "This eBook was prepared by", "http://gutenberg2000.de erreichbar.",
    "This Etext was prepared by", "This Etext prepared by", "This Project Gutenberg Etext was prepared by", "Gutenberg Distributed Proofreaders",
    "Project Gutenberg Distributed Proofreaders", "**The Project Gutenberg", "*SMALL PRINT!", "More information about this book is at the top of this file.",
    "tells you about restrictions in how the file may be used.", "l'authorization à les utilizer pour preparer ce texte.", "of the etext through OCR.",
    "*****These eBooks Were Prepared By Thousands of Volunteers!*****", "We need your donations more than ever!", " *** START OF THIS PROJECT GUTENBERG",
    "****     SMALL PRINT!", '["Small Print" V.', "*** START OF", "***START OF", "This etext was", "[Transcriber's Note",
)
# How notices behind the text begin.
END_PREFIXES = (
    "*** END OF THE PROJECT GUTENBERG", "*** END OF THIS PROJECT GUTENBERG", "***END OF THE PROJECT GUTENBERG", "End of the Project Gutenberg",
    "End of The Project Gutenberg", "Ende dieses Project Gutenberg", "by Project Gutenberg", "End of Project Gutenberg", "End of this Project Gutenberg",
    "Ende dieses Projekt Gutenberg", "        ***END OF THE PROJECT GUTENBERG", "*** END OF THE COPYRIGHTED", "End of this is COPYRIGHTED",
    "Ende dieses Etextes ", "Ende dieses Project Gutenber", "Ende diese Project Gutenberg", "**This is a COPYRIGHTED Project Gutenberg Etext, Details Above**",
    "Fin de Project Gutenberg", "The Project Gutenberg Etext of ", "Ce document fut presente en lecture", "Ce document fut présenté en lecture",
    "More information about this book is at the top of this file.", "We need your donations more than ever!", "END OF PROJECT GUTENBERG",
    " End of the Project Gutenberg", " *** END OF THIS PROJECT GUTENBERG", "End Project Gutenberg", "*** END OF", "***END OF", "End of this Etext",
)
# Whole lines that end a notice, sections to pass over, addresses.
FULL_LINES = ("Bowler", "Team.", "Jim Tinsley.", "Team")
SKIP_BEGIN, SKIP_END = ("<<THIS ELECTRONIC VERSION OF",), ("SERVICE THAT CHARGES FOR DOWNLOAD",)
ADDRESSES = ("gutenberg.net", "www.archive.org")
#: Beginnings of lines that end a notice if the line before ends with the second part.
PAIRED = (("Florida", "university of"),)
#: Rule for lines of credit, in place of a list of the hundreds that occur.
CREDITS = re.compile(r"distributed proofread|proofreading team|pgdp|internet archive|google (?:print|book)|generously made|images of public domain|bibliothèque nationale", re.I)


class Notices(NamedTuple):
    """Marks of the notices of a collection; ``read_marks`` in ``sources.books`` reads longer lists."""

    starts: tuple[str, ...] = START_PREFIXES
    ends: tuple[str, ...] = END_PREFIXES
    full_lines: tuple[str, ...] = FULL_LINES
    addresses: tuple[str, ...] = ADDRESSES
    paired: tuple[tuple[str, str], ...] = PAIRED
    credits: re.Pattern[str] | None = CREDITS

    def ends_header(self, line: str, before: str) -> bool:
        """Whether a line is the last of a notice before the text, as far as it alone tells."""
        bare, low = line.strip(), line.lower()
        return (
            line.startswith(self.starts)
            or bare in self.full_lines
            or any(a in low for a in self.addresses)
            or any(bare.startswith(b) and before.strip().lower().endswith(a) for b, a in self.paired)
            or self.credits is not None and self.credits.search(line) is not None
        )


#: Lines kept after which no header ends, and before the end where a footer may begin.
REACH, RESET = 600, 100


def text_span(lines: Sequence[str], notices: Notices = Notices()) -> tuple[int, int]:
    """First and behind-last line of the text proper, by line index.

    A header line discards what was kept so far as long as at most ``RESET`` lines lie
    between it and the first kept one; a block of lines right behind the first kept line
    is passed over (credits), as are blank lines at both ends.
    """
    begin: int | None = None
    stop, kept, skipping = len(lines), 0, False
    for n, line in enumerate(lines):
        if kept <= REACH and notices.ends_header(line, lines[n - 1] if n else ""):
            if not begin or n - begin <= RESET:
                begin = None
                continue
        if kept >= len(lines) - REACH and line.startswith(notices.ends):
            stop = n
            break
        if line.startswith(SKIP_BEGIN) or line.startswith(SKIP_END):
            skipping = line.startswith(SKIP_BEGIN)
            continue
        if not skipping:
            begin = n if begin is None else begin
            kept += 1
    filled = [bool(s.strip()) for s in lines]
    first = begin or 0
    if first + 1 < len(lines) and filled[first + 1]:
        while first + 1 < len(lines) and filled[first + 1]:
            first += 1
        first += 1
    while first < len(lines) and not filled[first]:
        first += 1
    while stop > 0 and not filled[stop - 1]:
        stop -= 1
    return first, stop


def split_notices(books: DataFrame, text: str = "text", notices: Notices = Notices()) -> DataFrame:
    """(book_id, header, body, footer): the text between the notices, characters that XML
    forbids removed. A null text gives three nulls, an empty one three empty texts."""

    @F.pandas_udf(struct("first int, last int"))
    def span(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_span(t.splitlines(), notices) if isinstance(t, str) else (0, 0) for t in texts], columns=["first", "last"])

    spans = books.select("book_id", F.col(text).alias("t")).withColumn("l", tx.lines_of("t")).withColumn("s", span("t"))
    part = lambda a, n: tx.xml_safe(F.array_join(F.slice("l", a, F.greatest(n, F.lit(0))), "\n"))
    first, last = F.least("s.first", F.size("l")), F.greatest("s.last", "s.first")
    return spans.select(
        "book_id",
        part(F.lit(1), first).alias("header"),
        part(first + 1, last - first).alias("body"),
        part(last + 1, F.size("l") - last).alias("footer"),
    )


# Inline markup, in the order in which it wins.
MARKS = (
    ("transcriber_note", r"\[Transcriber[^\]]*\]", ""),
    ("illustration", r"\[Illustration[^\]]*\]", ""),
    ("italic", r"_[^\s][^_]*[^\s]_", "_"),
    ("bold", r"\=[^\s][^\=]*[^\s]\=(?!\=)", "="),
    ("bold2", r"\*[^\s][^\*]*[^\s]\*(?!\*)", "*"),
    ("star_sep", r"(?<=\n)[^\S\r\n]*[\*][\*\s]*(?=\n)", ""),
)
_COMPILED = [(tag, re.compile(pattern), strip) for tag, pattern, strip in MARKS]
SPAN = ArrayType(struct("start int, end int, tag string, text string"))


def select_spans(text: str) -> list[tuple[int, int, str, str]]:
    """Spans of inline markup that don't overlap: kinds in order of priority, each from the left."""
    taken: list[tuple[int, int]] = []
    out = []
    for tag, pattern, strip in _COMPILED:
        for m in pattern.finditer(text):
            a, b = m.span()
            if all(b <= x or a >= y for x, y in taken):
                taken.append((a, b))
                out.append((a, b, tag, m.group().strip(strip) if strip else m.group()))
    return sorted(out)


@F.pandas_udf(SPAN)
def markup_spans(text: pd.Series) -> pd.Series:
    return text.map(lambda t: [dict(zip(("start", "end", "tag", "text"), s)) for s in select_spans(t)], na_action="ignore")


def unwrap(text: str) -> list[tuple[str, bool]]:
    """A body as pieces (text, is star separator): emphasis unwrapped, notes and illustrations gone."""
    out, at, buffer = [], 0, []
    for a, b, tag, inner in select_spans(text):
        buffer.append(text[at:a])
        at = b
        if tag == "star_sep":
            out += [("".join(buffer), False), (text[a:b].strip(), True)]
            buffer = []
        elif tag in ("italic", "bold", "bold2"):
            buffer.append(inner)
    out.append(("".join(buffer) + text[at:], False))
    return out


@F.pandas_udf(ArrayType(struct("text string, star boolean")))
def unwrapped(text: pd.Series) -> pd.Series:
    return text.map(lambda t: [{"text": s, "star": star} for s, star in unwrap(t)], na_action="ignore")


def paragraphs(books: DataFrame, body: str = "body") -> DataFrame:
    """(book_id, para_no, text, star): paragraphs at blank lines; a line of stars is a row of its own."""
    pieces = books.select("book_id", F.posexplode(unwrapped(F.col(body))).alias("piece", "p"))
    split = pieces.select(
        "book_id",
        "piece",
        "p.star",
        F.posexplode(F.when(F.col("p.star"), F.array("p.text")).otherwise(F.split("p.text", r"(?U)\n\n\s*"))).alias("part", "text"),
    ).where(F.regexp_replace("text", r"(?U)\s+", "") != "")
    order = Window.partitionBy("book_id").orderBy("piece", "part")
    return split.select("book_id", F.row_number().over(order).alias("para_no"), "text", "star")


# What opens the back matter.
BACK = ("the end", "acknowledgments", "bibliography", "glossary", "creative commons")


def regions(paras: DataFrame) -> DataFrame:
    """Add ``region`` to (book_id, para_no, text, is_header): ``front`` before the first
    header, ``back`` from the first closing paragraph after the last header, else ``body``.
    A book without headers has no front matter."""
    book = Window.partitionBy("book_id")
    header = F.coalesce("is_header", F.lit(False))
    first = F.min(F.when(header, F.col("para_no"))).over(book)
    last = F.max(F.when(header, F.col("para_no"))).over(book)
    words = F.trim(F.regexp_replace(F.regexp_replace(F.lower("text"), r"[^a-z0-9\s]", ""), r"\s+", " "))
    marked = paras.withColumn("_first", first).withColumn("_last", F.coalesce(last, F.lit(-1))).withColumn("_end", words.isin(*BACK))
    back = F.min(F.when(F.col("_end") & (F.col("para_no") > F.col("_last")), F.col("para_no"))).over(book)
    region = F.when(F.col("para_no") < F.col("_first"), "front").when(F.col("para_no") >= F.col("_back"), "back").otherwise("body")
    return marked.withColumn("_back", back).withColumn("region", region).drop("_first", "_last", "_end", "_back")


def settle_stars(paras: DataFrame) -> DataFrame:
    """Star separators: dropped from books with headers, headers themselves in books without;
    such a book begins with an unnamed header at paragraph 0."""
    any_header = F.max(F.coalesce("is_header", F.lit(False)).cast("int")).over(Window.partitionBy("book_id")) == 1
    star = F.coalesce("star", F.lit(False))
    marked = paras.withColumn("_headed", any_header).where(~(star & F.col("_headed")))
    only = marked.where(~F.col("_headed"))
    starred = only.where("star").select("book_id").distinct()
    opening = starred.select("book_id", F.lit(0).alias("para_no"), F.lit("").alias("text"), F.lit(False).alias("star"), F.lit(True).alias("is_header"))
    settled = marked.withColumn("is_header", F.when(F.col("_headed"), F.coalesce("is_header", F.lit(False))).otherwise(star))
    return settled.select("book_id", "para_no", "text", "star", "is_header").unionByName(opening)


def nest(paras: DataFrame) -> DataFrame:
    """Give every paragraph the number of the header it stands under (0: before any), and
    every book that doesn't begin with a header an unnamed one at paragraph 0."""
    first = paras.groupBy("book_id").agg(F.min_by(F.coalesce("is_header", F.lit(False)), "para_no").alias("h"), F.min("para_no").alias("p"))
    dummy = first.where("not h").select("book_id", (F.col("p") - 1).alias("para_no"), F.lit(None).cast("string").alias("text"), F.lit(True).alias("is_header"))
    whole = paras.select("book_id", "para_no", "text", F.coalesce("is_header", F.lit(False)).alias("is_header")).unionByName(dummy)
    return islands(whole, ["book_id"], ["para_no"], F.col("is_header"), "header_no")


def sections(paras: DataFrame) -> DataFrame:
    """Text of every header with more than one paragraph, and where each paragraph ends in it."""
    body = paras.where("not is_header")
    w = Window.partitionBy("book_id", "header_no").orderBy("para_no")
    ended = body.withColumn("end_offset", F.sum(F.length("text") + 2).over(w)).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("book_id", "header_no")))
    return (
        ended.where("_n > 1")
        .groupBy("book_id", "header_no")
        .agg(F.array_sort(F.collect_list(F.struct("para_no", "text", "end_offset"))).alias("p"))
        .select("book_id", "header_no", F.array_join("p.text", "\n\n").alias("text"), F.col("p.end_offset").alias("end_offsets"))
    )
