"""Features of the pages of a volume (book_id, page_no, lines), each as columns per page."""

from __future__ import annotations

import math
from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from quire.functions import text as tx
from quire.functions.types import struct
from quire.operators.volumes import positions
from quire.runtime import durable

# Words that mark the parts of a book.
KEY_WORDS = """
my to wife dedicated dedication father mother husband finis fin son daughter index appendix appendices illustrations
preface reader life period letters price published volume cents pages contents page section chap frontispiece drawing
copyright library printers university square press copyrighted errata subscribers notes glossary dramatis personae
notice foreword erratum editor publisher advertisement epilogue chapter introduction intro advertisements author
printed dedicatory prefatory mr mrs miss dr rev esq efq hon list ditto lady lord
""".split()


def _book() -> Window:
    return Window.partitionBy("book_id")


def position_features(pages: DataFrame) -> DataFrame:
    """first10, last10, ratio (2 decimals) and fifth of the book, by page number and number of pages."""
    n = F.count(F.lit(1)).over(_book())
    ratio = F.bround(F.col("page_no") / n, 2)
    return pages.select(
        "book_id",
        "page_no",
        (F.col("page_no") <= 10).cast("int").alias("first10"),
        (n - F.col("page_no") <= 10).cast("int").alias("last10"),
        ratio.alias("ratio"),
        F.when(ratio <= 0.2, 1).when(ratio <= 0.4, 2).when(ratio <= 0.6, 3).when(ratio <= 0.8, 4).otherwise(5).alias("quintile"),
    )


def _tokens(text: Column) -> Column:
    return F.split(F.regexp_replace(F.lower(F.rtrim(text)), r"[^a-z0-9$£ ]", ""), r"\s+", -1)


def word_features(pages: DataFrame) -> DataFrame:
    """Counts and ratios of words and numbers, key words anywhere and in the first six lines."""
    keys = F.array(*[F.lit(w) for w in dict.fromkeys(KEY_WORDS)])
    tokens = _tokens(F.array_join("lines", ""))
    top = F.flatten(F.transform(F.slice("lines", 1, 6), _tokens))
    counted = pages.select("book_id", "page_no", tokens.alias("t"), top.alias("h")).withColumns(
        {
            "n": F.size("t"),
            "words": F.size(F.filter("t", lambda w: w.rlike("^[a-z0-9_]"))),
            "numbers": F.size(F.filter("t", lambda w: w.rlike("^[0-9]"))),
        }
    )
    three = lambda x: F.bround(x, 3)
    some = F.col("words") > 0
    return counted.select(
        "book_id",
        "page_no",
        (F.col("n") < 5).cast("int").alias("blank_page"),
        (F.col("words") < 5).cast("int").alias("words_under_5"),
        F.col("words").alias("num_words"),
        F.col("numbers").alias("num_numbers"),
        F.when(some, three(F.col("words") / F.col("n"))).alias("word_ratio"),
        F.when(some, three(F.col("numbers") / F.col("n"))).alias("num_ratio"),
        F.when(some, three((F.col("words") + 5) / (F.col("numbers") + 5))).alias("word_num_ratio"),
        F.array_sort(F.array_intersect("t", keys)).alias("key_words"),
        F.array_sort(F.array_intersect("h", keys)).alias("header_words"),
    )


def _beta_tail(t: float, df: int) -> float:
    """Two-sided p-value of Student's t by the continued fraction of the incomplete beta."""
    x, a, b = df / (df + t * t), df / 2, 0.5
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if 0 < x < 1 else 0.0
    if x in (0.0, 1.0):
        return x
    if x > (a + 1) / (a + b + 2):
        return 1 - front * _fraction(1 - x, b, a) / b
    return front * _fraction(x, a, b) / a


def _fraction(x: float, a: float, b: float) -> float:
    tiny, c, d = 1e-30, 1.0, 1 / max(1 - (a + b) * x / (a + 1), 1e-30)
    out = d
    for m in range(1, 300):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + top * d or tiny)
            c = 1 + top / c or tiny
            out *= c * d
        if abs(c * d - 1) < 1e-12:
            break
    return out


@F.pandas_udf(struct("p double"))
def _p_value(rho: pd.Series, n: pd.Series) -> pd.DataFrame:
    def one(r: float, k: int) -> float | None:
        if k < 3 or r != r:
            return None
        return 0.0 if abs(r) >= 1 else _beta_tail(r * math.sqrt((k - 2) / (1 - r * r)), int(k) - 2)

    return pd.DataFrame({"p": [one(r, k) for r, k in zip(rho, n)]})


def alphabetical(pages: DataFrame, significance: float = 0.01) -> DataFrame:
    """Spearman correlation of the order of lines with their alphabetical order (equal lines
    in page order), where positive and significant."""
    lines = pages.select("book_id", "page_no", F.posexplode("lines").alias("at", "line")).where(F.col("line").rlike(r"(?U)\w"))
    page = Window.partitionBy("book_id", "page_no")
    ranked = lines.withColumn("a", F.row_number().over(page.orderBy("at"))).withColumn("b", F.row_number().over(page.orderBy("line", "at")))
    n = F.count(F.lit(1)).cast("double")
    rho = F.when(n > 1, 1 - 6 * F.sum((F.col("a") - F.col("b")) * (F.col("a") - F.col("b"))) / (n * (n * n - 1)))
    per = ranked.groupBy("book_id", "page_no").agg(rho.alias("spearman"), F.count(F.lit(1)).alias("n"))
    return per.withColumn("p", _p_value("spearman", "n")["p"]).where((F.col("spearman") > 0) & (F.col("p") < significance)).select("book_id", "page_no", "spearman", "p")


def longest_rise(numbers: list[int]) -> int:
    """Length of the longest strictly rising subsequence."""
    tails: list[int] = []
    for x in numbers:
        i = bisect_left(tails, x)
        tails[i : i + 1] = [x]
    return len(tails)


@F.pandas_udf(IntegerType())
def _rise(numbers: pd.Series) -> pd.Series:
    return numbers.map(lambda x: longest_rise(list(x)))


def rising_numbers(pages: DataFrame, shortest: int = 4) -> DataFrame:
    """Longest rising subsequence of a page's numbers (of up to nine digits), where there are
    at least ``shortest``, and whether it is longer than chance allows.

    By chance the length of n numbers in random order has mean 2√n - 1.771 n^(1/6) and
    standard deviation 0.902 n^(1/6); beyond the mean and 1.65 deviations it is significant.
    """
    digits = F.filter(F.split(F.array_join("lines", ""), r"[^0-9]+"), lambda s: (s != "") & (F.length(s) <= 9))
    found = pages.select("book_id", "page_no", F.transform(digits, lambda s: s.cast("int")).alias("x")).where(F.size("x") >= shortest)
    n = F.size("x").cast("double")
    sixth = F.pow(n, F.lit(1 / 6))
    out = found.withColumn("rise", _rise("x")).withColumn("numbers", F.size("x"))
    return out.select("book_id", "page_no", "numbers", "rise", (F.col("rise") > 2 * F.sqrt(n) - 1.771 * sixth + 1.65 * 0.902 * sixth).alias("significant"))


def roman(n: int) -> str:
    out = ""
    for value, sign in ((400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out += sign * (n // value)
        n %= value
    return out


def roman_numerals(pages: DataFrame, most: int = 499) -> DataFrame:
    """Whether the first or last five lines hold a Roman numeral of 2..``most``."""
    numerals = F.array(*[F.lit(roman(n)) for n in range(2, most + 1)])
    words = lambda lines: F.flatten(F.transform(lines, lambda s: F.split(F.lower(F.trim(s)), r"\s+")))
    last = F.slice("lines", F.greatest(F.size("lines") - 4, F.lit(1)), F.lit(5))
    return pages.select(
        "book_id",
        "page_no",
        F.arrays_overlap(words(F.slice("lines", 1, 5)), numerals).alias("roman_top"),
        F.arrays_overlap(words(last), numerals).alias("roman_bottom"),
    )


def letter_features(pages: DataFrame, z: float = 1.65) -> DataFrame:
    """Number of letters that begin far more words of a page than of its book: counts of
    initials (a-z, plus one each) as shares against the mean counts of the book's pages."""
    words = pages.select("book_id", "page_no", F.explode(F.split(F.lower(F.array_join("lines", "")), r"\s+")).alias("w"))
    initials = words.select("book_id", "page_no", F.substring("w", 1, 1).alias("letter")).where(F.col("letter").between("a", "z"))
    counts = initials.groupBy("book_id", "page_no", "letter").agg(F.count(F.lit(1)).alias("c"))
    grid = pages.select("book_id", "page_no", F.explode(F.array(*[F.lit(chr(c)) for c in range(97, 123)])).alias("letter"))
    full = grid.join(counts, ["book_id", "page_no", "letter"], "left").withColumn("c", F.coalesce("c", F.lit(0)) + 1)
    per_letter = full.groupBy("book_id", "letter").agg(F.sum("c").alias("all_c"))
    per_book = full.groupBy("book_id").agg(F.sum("c").alias("all"))
    per_page = full.groupBy("book_id", "page_no").agg(F.sum("c").alias("page_c"))
    joined = full.join(per_page, ["book_id", "page_no"]).join(per_letter, ["book_id", "letter"]).join(per_book, "book_id")
    usual = F.col("all_c") / F.col("all")
    score = (F.col("c") / F.col("page_c") - usual) / F.sqrt(usual * (1 - usual) / F.col("c"))
    return joined.groupBy("book_id", "page_no").agg(F.sum((score > z).cast("int")).alias("letters")).select(
        "book_id", "page_no", "letters", (F.col("letters") > 0).cast("int").alias("letter_1"), (F.col("letters") > 1).cast("int").alias("letter_2")
    )


def text_tiling(pages: DataFrame) -> DataFrame:
    """Cosine of the vocabulary up to each page with that after it (3 decimals; none on the last page).

    With a word counted once per page, the k-th of its n pages moves Σp² by 2k-1, Σs² by
    -(2n-2k+1) and Σps by n-2k+1, so three running sums over the pages give all cosines.
    """
    placed = positions(pages)
    words = placed.select("book_id", "pos", F.explode(F.array_distinct(F.split(tx.clean_line(F.array_join("lines", " ")), " "))).alias("w")).where("w <> ''")
    in_word = Window.partitionBy("book_id", "w")
    ranked = words.withColumn("k", F.row_number().over(in_word.orderBy("pos"))).withColumn("n", F.count(F.lit(1)).over(in_word))
    moves = ranked.groupBy("book_id", "pos").agg(
        F.sum(2 * F.col("k") - 1).alias("pp"), F.sum(-(2 * F.col("n") - 2 * F.col("k") + 1)).alias("ss"), F.sum(F.col("n") - 2 * F.col("k") + 1).alias("ps")
    )
    start = ranked.where("k = 1").groupBy("book_id").agg(F.sum(F.col("n") * F.col("n")).alias("ss0"))
    run = Window.partitionBy("book_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    zero = lambda c: F.sum(F.coalesce(c, F.lit(0))).over(run)
    summed = (
        placed.select("book_id", "page_no", "pos").join(moves, ["book_id", "pos"], "left").join(start, "book_id", "left")
        .withColumns({"p2": zero("pp"), "s2": F.coalesce("ss0", F.lit(0)) + zero("ss"), "p_s": zero("ps"), "_n": F.count(F.lit(1)).over(_book())})
    )
    cosine = F.when((F.col("p2") > 0) & (F.col("s2") > 0), F.bround(F.col("p_s") / F.sqrt(F.col("p2").cast("double") * F.col("s2")), 3)).otherwise(0.0)
    return summed.where(F.col("pos") < F.col("_n")).select("book_id", "page_no", cosine.alias("cosine"))


def ngram_counts(pages: DataFrame, longest: int = 3) -> DataFrame:
    """Occurrences of all runs of 1..``longest`` cleaned words within pages: (n, gram, count)."""
    words = pages.select(F.filter(F.split(tx.clean_line(F.array_join("lines", " ")), " "), lambda w: w != "").alias("w"))
    sized = words.select("w", F.explode(F.sequence(F.lit(1), F.lit(longest))).alias("n")).where(F.size("w") >= F.col("n"))
    grams = sized.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1), lambda i: F.array_join(F.slice("w", i, F.col("n")), " "))).alias("gram"))
    return grams.groupBy("n", "gram").agg(F.count(F.lit(1)).alias("count"))


def context_features(features: DataFrame, reach: int = 3) -> DataFrame:
    """Features (book_id, page_no, feature, value) of the pages ``j`` = 1..reach before and
    after, by page number. What follows at distance j counts only if the page j before exists."""
    features = durable(features)  # read for every distance and direction
    there = features.select("book_id", "page_no").distinct()
    out = features
    for j in range(1, reach + 1):
        before = features.select("book_id", (F.col("page_no") + j).alias("page_no"), F.concat(F.lit(f"prev_{j}_"), "feature").alias("feature"), "value")
        after = features.select("book_id", (F.col("page_no") - j).alias("page_no"), F.concat(F.lit(f"foll_{j}_"), "feature").alias("feature"), "value")
        after = after.join(there.select("book_id", (F.col("page_no") + j).alias("page_no")), ["book_id", "page_no"], "left_semi")
        out = out.unionByName(before.unionByName(after).join(there, ["book_id", "page_no"], "left_semi"))
    return out


def map_vocabulary(features: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Features by id (vocabulary: term, id); zeros and unknown features are dropped."""
    return features.where("value <> 0").join(vocabulary.select(F.col("term").alias("feature"), "id"), "feature").select("book_id", "page_no", "id", "value")


def standardise(features: DataFrame, means: DataFrame, size: int) -> DataFrame:
    """Dense vector of ``size`` z-scores per page (means: id, mean, sd; no mean: 0; sd 0 counts as 1)."""
    z = features.join(means, "id").withColumn("z", (F.col("value") - F.col("mean")) / F.when(F.col("sd") != 0, F.col("sd")).otherwise(1.0))
    per = z.groupBy("book_id", "page_no").agg(F.map_from_entries(F.collect_list(F.struct("id", "z"))).alias("m"))
    return per.select("book_id", "page_no", F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("vector"))


def long_features(pages: DataFrame) -> DataFrame:
    """Position, word, key word and letter features as (book_id, page_no, feature, value)."""
    p = position_features(pages).select("book_id", "page_no", F.explode(F.create_map(*[x for c in ("first10", "last10", "ratio", "quintile") for x in (F.lit(f"position:{c}"), F.col(c).cast("double"))])).alias("feature", "value"))
    w = word_features(pages)
    counts = w.select("book_id", "page_no", F.explode(F.create_map(*[x for c in ("blank_page", "words_under_5", "num_words", "num_numbers", "word_ratio", "num_ratio", "word_num_ratio") for x in (F.lit(f"word:{c}"), F.col(c).cast("double"))])).alias("feature", "value"))
    keys = w.select("book_id", "page_no", F.explode(F.concat(F.transform("key_words", lambda k: F.concat(F.lit("word:"), k)), F.transform("header_words", lambda k: F.concat(F.lit("word:header_"), k)))).alias("feature"), F.lit(1.0).alias("value"))
    letters = letter_features(pages).select("book_id", "page_no", F.explode(F.create_map(F.lit("letter:1"), F.col("letter_1").cast("double"), F.lit("letter:2"), F.col("letter_2").cast("double"))).alias("feature", "value"))
    return p.unionByName(counts).unionByName(keys).unionByName(letters).where("value is not null")


# page numbers --------------------------------------------------------------------


def number_candidates(pages: DataFrame, near: int = 25) -> DataFrame:
    """Numbers in the first and last five lines less than ``near`` from the page number."""
    n = F.size("lines")
    edge = F.filter("lines", lambda s, i: (i < 5) | (i >= n - 5))
    tokens = pages.select("book_id", "page_no", F.explode(F.array_distinct(F.split(F.array_join(edge, " "), r"\s+"))).alias("t")).where("page_no > 0").where(F.col("t").rlike("^[0-9]{1,9}$"))
    return tokens.select("book_id", "page_no", F.col("t").cast("int").alias("number")).where(F.abs(F.col("page_no") - F.col("number")) < near).distinct()


def _best_path(found: dict[int, list[int]], last: int) -> list[int]:
    """Cheapest sequence of rising numbers (or -1, unmarked) over the pages 1..last-1.

    Numbers in a row cost the log of their difference, two unmarked pages log 10, a change
    between marked and unmarked log 100."""
    cost, back = {-1: math.log(10)}, []
    for page in range(1, last):
        now, came = {}, {}
        for x in (-1, *found.get(page, ())):
            options = [
                (c + math.log(10 if x == y == -1 else 100 if -1 in (x, y) else x - y), y) for y, c in cost.items() if x == -1 or y == -1 or x > y
            ]
            now[x], came[x] = min(options, key=lambda o: o[0])
        cost = now
        back.append(came)
    path = []
    at = min(cost, key=lambda x: cost[x])
    for came in reversed(back):
        path.append(at)
        at = came[at]
    return path[::-1]


_SEQUENCE = "book_id string, page_no int, offset int, first_marked int, identified boolean, before_inferred boolean, before_marked boolean"


def page_sequence(pages: DataFrame, votes: int = 20, least: int = 5) -> DataFrame:
    """Which page carries number 1: the cheapest rising path through the candidate numbers,
    then a vote of its first ``votes`` marked pages on the offset; books with fewer than
    ``least`` votes for one offset give no row. One small row per page reaches the search."""
    numbers = number_candidates(pages).groupBy("book_id", "page_no").agg(F.sort_array(F.collect_list("number")).alias("numbers"))
    source = pages.select("book_id", "page_no").join(numbers, ["book_id", "page_no"], "left")

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        found = {int(p): list(n) for p, n in zip(pdf["page_no"], pdf["numbers"]) if n is not None}
        path = _best_path(found, int(pdf["page_no"].max()))
        marked = [(i + 1, x) for i, x in enumerate(path) if x != -1]
        offsets = [p - x for p, x in marked[:votes] if p >= x]
        best = max(dict.fromkeys(sorted(offsets)), key=offsets.count, default=None)
        if best is None or offsets.count(best) < least:
            return pd.DataFrame(columns=[c.split()[0] for c in _SEQUENCE.split(", ")])
        first = next(p for p, x in marked if p - x == best)
        out = pdf[["book_id", "page_no"]].copy()
        out["offset"], out["first_marked"], out["identified"] = best, first, True
        out["before_inferred"], out["before_marked"] = out["page_no"] < best, out["page_no"] < first
        return out

    return source.groupBy("book_id").applyInPandas(search, _SEQUENCE)


def offset_votes(pages: DataFrame) -> DataFrame:
    """Most frequent offset of page number and printed number per book: (book_id, offset, votes)."""
    votes = number_candidates(pages).groupBy("book_id", (F.col("page_no") - F.col("number")).alias("offset")).agg(F.count(F.lit(1)).alias("votes"))
    return votes.groupBy("book_id").agg(F.max(F.struct("votes", (-F.col("offset")).alias("o"))).alias("m")).select("book_id", (-F.col("m.o")).alias("offset"), F.col("m.votes").alias("votes"))


def adjacent_similarity(features: DataFrame) -> DataFrame:
    """Cosine of each page's feature values with those of the page before, each feature
    standardised over its book (constant features count nothing). A page that differs in
    nothing from its book's mean has no direction: its cosine is null."""
    over = Window.partitionBy("book_id", "feature")
    pages = features.select("book_id", "page_no").distinct()
    mean, sd = F.avg("value").over(over), F.stddev_pop("value").over(over)
    z = features.withColumn("z", F.when(sd > 0, (F.col("value") - mean) / sd)).where("z is not null").select("book_id", "page_no", "feature", "z")
    norm = z.groupBy("book_id", "page_no").agg(F.sqrt(F.sum(F.col("z") * F.col("z"))).alias("norm"))
    before = z.select("book_id", (F.col("page_no") + 1).alias("page_no"), "feature", F.col("z").alias("y"))
    dots = z.join(before, ["book_id", "page_no", "feature"]).groupBy("book_id", "page_no").agg(F.sum(F.col("z") * F.col("y")).alias("dot"))
    last = norm.select("book_id", (F.col("page_no") + 1).alias("page_no"), F.col("norm").alias("norm_before"))
    return (
        pages.join(norm, ["book_id", "page_no"]).join(last, ["book_id", "page_no"]).join(dots, ["book_id", "page_no"], "left")
        .select("book_id", "page_no", F.try_divide(F.coalesce("dot", F.lit(0.0)), F.col("norm") * F.col("norm_before")).alias("cosine"))
    )
