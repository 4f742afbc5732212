"""Chapter headings: matching paragraphs, accepting numbered runs, merging titles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import heading_rules as hr
from quire.functions import text as tx
from quire.functions.types import struct
from quire.operators.windows import islands
from quire.runtime import durable

_HEADING = "rule string, desc string, number int, number_text string, number_type string, title string, bare_title boolean, bare_upper boolean"
#: A run is no list of contents if matches fill at most this share of its span, and its
#: headings stand at least so many paragraphs apart.
DENSE, APART = 0.75, 4
#: Steps of a relaxed run, and how many may be longer than one.
STEP, GAPS = 2, 3


@F.pandas_udf(struct(_HEADING))
def _match(text: pd.Series) -> pd.DataFrame:
    rows = []
    for t in text:
        rule = hr.best_rule(t) if isinstance(t, str) else None
        p = hr.parts(t, rule) if rule else {}
        rows.append((
            ",".join(rule) if rule else None, p.get("desc"), p.get("number"), p.get("number_text"), p.get("number_type"), p.get("title"),
            bool(rule) and hr.is_title(t), bool(rule) and hr.is_title(t, ("title_upper",)),
        ))
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in _HEADING.split(", ")])
    return out.astype({"number": "Int32"})


_NUMBERED = r"^[^A-Za-z0-9]*(?:[0-9]|[MDCLXVImdclxvi]+(?![A-Za-z0-9])|(?i:" + "|".join((*hr.DESCRIPTORS, *hr.NUMBER_PARTS)) + "))"


def match_headings(paras: DataFrame) -> DataFrame:
    """Paragraphs (book_id, para_no, text) that a heading rule matches as a whole, with its parts.
    Paragraphs mostly in capitals are raised to capitals first; quotes around them don't count."""
    raised = paras.select("book_id", "para_no", tx.bare(tx.raise_capitals(F.trim("text"))).alias("text"))
    # a heading begins with a descriptor or number, or is a title: without small letters,
    # or one line (of Latin letters on) that doesn't end like a sentence
    possible = F.col("text").rlike(_NUMBERED) | ~F.col("text").rlike("[a-z]") | (~F.contains(F.regexp_replace("text", "^[^A-Za-z]*", ""), F.lit("\n")) & ~F.col("text").rlike(r"[.?\-!:;,]$"))
    return raised.where((F.col("text") != "") & possible).withColumn("m", _match("text")).where("m.rule is not null").select("book_id", "para_no", "text", "m.*")


def merge_titles(found: DataFrame, upper_only: bool = False) -> DataFrame:
    """A numbered heading without title takes a bare title in the paragraph right after it,
    unless that has a descriptor or speaks of contents; the title's own row goes.
    ``upper_only`` is the reading for scanned volumes, where only capitals are titles."""
    w = Window.partitionBy("book_id").orderBy("para_no")
    bare = "bare_upper" if upper_only else "bare_title"
    fits = (
        F.col("number").isNotNull()
        & F.col("title").isNull()
        & (F.lead("para_no").over(w) == F.col("para_no") + 1)
        & F.lead("desc").over(w).isNull()
        & F.lead("number").over(w).isNull()
        & ~F.contains(F.lower(F.coalesce(F.lead("title").over(w), F.lit(""))), F.lit("contents"))
        & F.lead(bare).over(w)
    )
    marked = found.withColumn("_takes", F.coalesce(fits, F.lit(False))).withColumn("_next", F.lead("text").over(w))
    marked = marked.withColumn("_taken", F.coalesce(F.lag("_takes").over(w), F.lit(False)))
    return (
        marked.where("not _taken or _takes")
        .withColumn("title", F.when(F.col("_takes"), F.col("_next")).otherwise(F.col("title")))
        .withColumn("text", F.when(F.col("_takes"), F.concat_ws("\n\n", "text", "_next")).otherwise(F.col("text")))
        .drop("_takes", "_next", "_taken")
    )


def number_runs(found: DataFrame) -> DataFrame:
    """Add ``kind`` (the rule without space, punctuation and titles) and ``run``: per book,
    descriptor and kind a new run begins wherever the number doesn't rise."""
    kind = F.array_join(F.filter(F.split("rule", ","), lambda x: ~x.isin("punctuation", "whitespace", *hr.TITLES, "generic_text")), ",")
    numbered = found.where("number is not null").withColumn("kind", kind).withColumn("_desc", F.coalesce("desc", F.lit("")))
    keys = ["book_id", "_desc", "kind"]
    w = Window.partitionBy(*keys).orderBy("para_no")
    return islands(numbered, keys, ["para_no"], F.col("number") <= F.lag("number").over(w), "run")


_RUN = ["book_id", "_desc", "kind", "run"]


def accepted_runs(runs: DataFrame) -> DataFrame:
    """Runs of two headings or more whose numbers follow each other, or nearly (steps of at
    most two, at most three of them), and pairs of runs that interleave to such a sequence."""
    w = Window.partitionBy(*_RUN).orderBy("para_no")
    stepped = runs.withColumn("step", F.col("number") - F.lag("number").over(w))
    per = stepped.groupBy(*_RUN).agg(
        F.count(F.lit(1)).alias("n"),
        F.max("step").alias("widest"),
        F.sum((F.col("step") > 1).cast("int")).alias("gaps"),
        F.array_sort(F.collect_list(F.struct("number", "para_no"))).alias("seq"),
    )
    strict = (F.col("n") > 1) & (F.col("widest") == 1)
    relaxed = (F.col("n") > 1) & (F.col("widest") <= STEP) & (F.col("gaps") <= GAPS)
    alone = per.where(strict | relaxed).select(*_RUN)
    left = per.where(~strict).where("n > 1")
    a = left.select(*[F.col(c).alias(f"a{c}") for c in _RUN], F.col("seq").alias("sa"), F.col("book_id"))
    b = per.where(~strict).select(*[F.col(c).alias(f"b{c}") for c in _RUN], F.col("seq").alias("sb"), F.col("book_id"))
    pairs = a.join(b, "book_id").where(F.struct(*[f"a{c}" for c in _RUN[1:]]) != F.struct(*[f"b{c}" for c in _RUN[1:]]))
    union = F.array_sort(F.concat("sa", "sb"))
    step = F.transform(F.sequence(F.lit(2), F.size("u")), lambda i: (F.element_at("u", i)["number"] - F.element_at("u", i - 1)["number"] == 1) & (F.element_at("u", i)["para_no"] > F.element_at("u", i - 1)["para_no"]))
    good = pairs.withColumn("u", union).where(F.forall(step, lambda x: x))
    both = good.select(*[F.col(f"a{c}").alias(c) for c in _RUN]).unionByName(good.select(*[F.col(f"b{c}").alias(c) for c in _RUN]))
    return alone.unionByName(both).distinct()


def prune_runs(runs: DataFrame, accepted: DataFrame, found: DataFrame) -> DataFrame:
    """Headings of accepted runs that are no list of contents: matches of any kind fill at
    most ``DENSE`` of the run's span, and its headings stand ``APART`` on average."""
    members = runs.join(accepted, _RUN)
    spans = members.groupBy(*_RUN).agg(F.min("para_no").alias("a"), F.max("para_no").alias("b"), F.count(F.lit(1)).alias("n"))
    # matches up to a paragraph are a running count, so the number within a span is a difference
    w = Window.partitionBy("book_id").orderBy("para_no")
    upto = found.select("book_id", "para_no", F.row_number().over(w).alias("k"))
    ends = spans.join(upto.select("book_id", F.col("para_no").alias("a"), F.col("k").alias("ka")), ["book_id", "a"]).join(
        upto.select("book_id", F.col("para_no").alias("b"), F.col("k").alias("kb")), ["book_id", "b"]
    )
    good = ends.where((F.col("kb") - F.col("ka") + 1) / (F.col("b") - F.col("a") + 1) <= DENSE).where((F.col("b") - F.col("a")) / (F.col("n") - 1) >= APART)
    return members.join(good.select(*_RUN), _RUN)


def headings(paras: DataFrame, upper_only: bool = False) -> DataFrame:
    """(book_id, para_no, desc, number, number_text, number_type, title, rule, text): the
    chapter headings of every book.

    Books without any accepted run fall back to bare capital titles, else to all
    matches; a book whose runs are all lists of contents has none. Headings in a row
    with the same bare title rule are one.
    """
    columns = ["book_id", "para_no", "desc", "number", "number_text", "number_type", "title", "rule", "text"]
    # read by six branches below; the grammar runs once
    found = durable(merge_titles(match_headings(paras), upper_only))
    runs = number_runs(found)
    accepted = accepted_runs(runs)
    kept = prune_runs(runs, accepted, found).select(*columns)
    without = found.join(accepted.select("book_id").distinct(), "book_id", "left_anti")
    upper = F.max((F.col("rule") == "title_upper").cast("int")).over(Window.partitionBy("book_id"))
    fallback = without.withColumn("_u", upper).where("_u = 0 or rule = 'title_upper'").select(*columns)
    chosen = kept.unionByName(fallback).dropDuplicates(["book_id", "para_no"])
    w = Window.partitionBy("book_id").orderBy("para_no")
    joins = (F.lag("para_no").over(w) == F.col("para_no") - 1) & (F.lag("rule").over(w) == F.col("rule")) & F.col("rule").isin(*hr.TITLES)
    grouped = islands(chosen, ["book_id"], ["para_no"], ~F.coalesce(joins, F.lit(False)), "_g")
    ordered = F.array_sort(F.collect_list(F.struct("para_no", "text", "title")))
    first = lambda c: F.min_by(c, "para_no").alias(c)
    return (
        grouped.groupBy("book_id", "_g")
        .agg(F.min("para_no").alias("para_no"), *[first(c) for c in ("desc", "number", "number_text", "number_type", "rule")], ordered.alias("l"))
        .withColumn("text", F.array_join("l.text", "\n\n"))
        .withColumn("title", F.when(F.size("l") > 1, F.array_join("l.title", "\n\n")).otherwise(F.element_at("l", 1)["title"]))
        .select(*columns)
    )
