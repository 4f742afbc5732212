"""Sentence boundaries in many languages, from unsupervised statistics.

Per language, log-likelihood ratios over the whole collection find abbreviations
(words that keep to their period), collocations across a period and sentence
starters; every full stop is then classified with them. Exclamation and question
marks, ellipses, quotations and scripts without capitals or full stops follow
rules on their context. Counting is a map-side sum. What is learnt (abbreviations,
starters, collocations) is small beside the texts and goes to the tasks that read
them, if it is within a checked size; beyond, the places are joined with it.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import languages as lg
from quire.runtime import balanced, durable

# Verbs that end (or begin) a reporting clause where no capitals tell.
REPORTING = {
    "zh": "说 问 道 喊 答 叫 說 問 想".split(),
    "th": "กล่าว ถาม พูด ตอบ บอก ร้อง".split(),
    "hi": "कहा पूछा बोला बोली बोले चिल्लाया चिल्लाई".split(),
}
_QUOTING_TH = ("ว่า", "กล่าว", "ถาม", "พูด", "ตอบ", ":")

_CLOSE = "”’»›)]}」』】）］〉》\"'“‘«"
_SURE_CLOSE = set("”»›)]}」』】）］〉》")
_OPEN = set("“‘«‹([{「『【（［〈《„‚\"'»›¿¡”’")
_DASH = set("—–―-")
_CLUSTER = re.compile(r"(?:\.(?:\s\.){2,}|[.!?…。！？｡．।॥؟‽⁇⁈⁉]+(?:\s?[!?]+)*|(?<=\w)\s[!?]+|[—–-](?=[”\"’»'“]))")
_BREAKS = frozenset("“”„‚«»‹›\"()[]{}¿¡—–!?…,;:।。！？")
_CLAUSE_END = re.compile(r"[。！？!?।.…，、,「“『]")
_NEXT = re.compile(r"[^\W\d_]+(?:[’'-][^\W\d_]+)*|\d+")
_TOKEN = re.compile(r"(?:[^\W_]|[̀-ͯऀ-෿])+(?:[.’'-]+[^\W_]+)*\.?")
# a whole sentence's last word that the next word was printed onto
_GLUED = re.compile(r"^.*[^\W\d_]{3,}\.(?=[^\W\d_])")
_THAI = re.compile(r"[฀-๿]")
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")
_SPACES = re.compile(r"\s+")
_OPENED = re.compile(r"[.!?…“”«»\"„]")
#: Thai has no breaks between words: so many signs stand for the first word of a chunk.
_PREFIX = 4
#: A clause after a closing quote that reports the speech is no longer than so many
#: characters (without spaces, with spaces); a longer one is a sentence of its own.
REPORT_SOLID, REPORT_SPACED = 16, 60


@lru_cache(1 << 16)
def _kind(word: str) -> str:
    """Type of a word before a period: lower case; numbers by their number of digits."""
    bare = _GLUED.sub("", word.rstrip(".")).lower()
    return f"##{len(bare)}" if bare.isdigit() else bare


def _close(text: str, i: int) -> int:
    """End of the closing quotes and brackets that begin at i, maybe after one space."""
    n = len(text)
    while i < n:
        c = text[i]
        if c in _CLOSE and (c in _SURE_CLOSE or i + 1 >= n or not text[i + 1].isalnum()):
            i += 1
        elif c.isspace() and i + 1 < n and text[i + 1] in "»›" and (i + 2 >= n or not text[i + 2].isalnum()):
            i += 2
        else:
            break
    return i


def _ahead(text: str, i: int) -> tuple[int, str, bool]:
    """First letter or digit after i past spaces, openers and dashes; that sign; whether one was passed that opens."""
    opened = False
    n = len(text)
    while i < n and not text[i].isalnum():
        if text[i] in ",;:，、；：%":
            return i, text[i], opened
        if text[i] in _OPEN:
            opened = True
        elif not (text[i].isspace() or text[i] in _DASH):
            return i, "", opened
        i += 1
    return i, text[i] if i < n else "", opened


def _case(c: str) -> str:
    if not c:
        return "other"
    if c in ",;:，、；：%":
        return "comma"
    if c.isdigit():
        return "digit"
    return "upper" if c.isupper() or c.istitle() else "lower" if c.islower() else "none"


def _reports(text: str, i: int) -> bool:
    """Whether the clause that begins at i is a short reporting clause."""
    while i < len(text) and text[i].isspace():
        i += 1
    if text[i : i + 1] == "と":
        return True
    if _THAI.match(text[i : i + 1]):  # no marks: the clause ends at the next space
        space = _SPACES.search(text, i)
        return text[i : space.start() if space else len(text)].rstrip("!?").endswith(tuple(REPORTING["th"]))
    end = _CLAUSE_END.search(text, i)
    if end and end.group() in "，、,「“『":
        return False
    clause = text[i : end.start() if end else len(text)].rstrip()
    if _CJK.search(clause):
        return clause.endswith(tuple(REPORTING["zh"])) and len(clause) <= REPORT_SOLID
    return clause.endswith(tuple(REPORTING["hi"])) and len(clause) <= REPORT_SPACED


def _word_before(text: str, i: int) -> str:
    """The run of signs before i up to a space, quote, bracket or other mark."""
    begin = i
    while begin and not (text[begin - 1].isspace() or text[begin - 1] in _BREAKS):
        begin -= 1
    return text[begin:i]


def candidates(text: str) -> list[tuple[int, str, str, str, str]]:
    """Places where a sentence may end: (end, rule, type, next, case of next).

    ``rule`` is ``sure``, ``stop`` (a full stop, to be classified), ``thai`` (a space
    in Thai text, to be classified) or ``final``. Places that can't end a sentence
    are left out.
    """
    stripped = len(text.rstrip())
    if not stripped:
        return []
    out = []
    for m in _CLUSTER.finditer(text):
        begin, after_mark = m.span()
        mark = m.group().replace(" ", "")
        end = _close(text, after_mark)
        if end >= stripped:
            continue
        at, c, opened = _ahead(text, end)
        case = _case(c)
        spaced = text[end].isspace()
        closed = end > after_mark
        if case == "comma" or mark in _DASH and not closed:
            continue
        if mark in _DASH:
            if case == "upper":
                out.append((end, "sure", "", "", case))
            continue
        if mark[-1] in "。！？｡।॥":
            if not closed or not _reports(text, end):
                out.append((end, "sure", "", "", case))
            continue
        if mark == ".":
            if case == "lower":
                continue
            if begin and text[begin - 1].isdigit() and c.isdigit() and not spaced:
                continue
            glued = not spaced and not closed and not opened
            if glued and case != "upper":
                continue
            word = _word_before(text, begin)
            # no space after the full stop: only a word before and a capital after
            if glued and (len(word) < 2 or "." in word or word.isupper()):
                continue
            if not word and not closed:
                continue
            if case == "none" and closed and _reports(text, end):
                continue
            following = _NEXT.match(text, at)
            after = following.group().lower() if following else ""
            if len(after) == 1 and after.isalpha() and text[following.end() : following.end() + 1] == ".":
                after += "."  # an initial, not the word of one letter
            out.append((end, "stop", _kind(word), after, case))
            continue
        if case == "lower":
            continue
        if case == "none" and (closed and _reports(text, end) or text[at : at + 1] == "と"):
            continue
        out.append((end, "sure", "", "", case))
    if _THAI.search(text):
        taken = {x[0] for x in out}
        for m in _SPACES.finditer(text, 0, stripped):
            i, j = m.span()
            if not i or i in taken or not (_THAI.match(text[i - 1]) or text[i - 1] in _SURE_CLOSE):
                continue
            at, c, opened = _ahead(text, j)
            if not _THAI.match(c or " "):
                continue
            if text[i - 1] in "”»\"" and _reports(text, j) or opened and text.endswith(_QUOTING_TH, 0, i):
                continue
            out.append((i, "thai", "", text[at : at + _PREFIX], "none"))
    out.append((stripped, "final", "", "", ""))
    return sorted(out)


_COUNTS = "lang string, what string, a string, b string, n long"


def _tally(lang: str, text: str, counts: dict[tuple[str, str], Counter]) -> None:
    """Counts of one text: its words as printed, capitals within sentences, what follows a period."""
    words = _TOKEN.findall(text)
    counts[lang, "word"].update(words)
    gaps = _TOKEN.split(text)
    counts[lang, "inner"].update(
        _kind(w) for w, gap, last in zip(words[1:], gaps[1:], words) if w[0].isupper() and last[-1] != "." and (gap == " " or not _OPENED.search(gap))
    )
    if "." in text:
        counts[lang, "after"].update((x[2], x[3] if x[4] == "upper" else "##") for x in candidates(text) if x[1] == "stop" and x[4] in ("upper", "digit"))
    if _THAI.search(text):
        chunks = [c.lstrip("“‘«\"'(") for c in text.split()]
        for i, c in enumerate(chunks):
            if _THAI.match(c):
                counts[lang, "first" if i == 0 else "chunk"][c[:_PREFIX]] += 1


def _counted(counts: dict[tuple[str, str], Counter]) -> Iterator[tuple[str, str, str, str, int]]:
    """(lang, what, a, b, n): printed words by type, with and without period and small."""
    for (lang, what), own in counts.items():
        if what == "after":
            yield from ((lang, what, *k, n) for k, n in own.items())
        elif what != "word":
            yield from ((lang, what, k, "", n) for k, n in own.items())
        else:
            types: Counter = Counter()
            for word, n in own.items():
                kind = _kind(word)
                period = word[-1] == "."
                types["period" if period else "plain", kind] += n
                if not period and word[0].islower():
                    types["lower", kind] += n
            yield from ((lang, *k, "", n) for k, n in types.items())


def learn_counts(texts: DataFrame) -> DataFrame:
    """(lang, what, a, b, n) over all of (text, lang); tasks sum up before anything is shuffled."""

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[tuple[str, str], Counter] = defaultdict(Counter)

        def flush() -> pd.DataFrame:
            rows = list(_counted(counts))
            counts.clear()
            return pd.DataFrame(rows, columns=["lang", "what", "a", "b", "n"])

        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                _tally(lang, text, counts)
            if sum(map(len, counts.values())) > 200_000:
                yield flush()
        yield flush()

    return texts.select("lang", "text").mapInPandas(tally, _COUNTS).groupBy("lang", "what", "a", "b").agg(F.sum("n").alias("n"))


def _ll(k: F.Column, n: F.Column, p: F.Column) -> F.Column:
    """Log-likelihood of k successes in n trials of probability p."""
    p = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    return k * F.log(p) + (n - k) * F.log(1 - p)


#: Thresholds of the statistics; all but the last are those published with the method.
ABBREVIATION, COLLOCATION, STARTER, SMALL = 0.3, 7.88, 30, 0.5


def _words(counts: DataFrame) -> DataFrame:
    """(lang, word, with, without, small, abbr): every counted word; whether it is an
    abbreviation; whether it is written small in most places where no sentence begins.

    ``abbr`` compares "the period always belongs to the word" with "the period comes as
    it comes", scaled by length, inner periods and occurrences without period.
    """
    number = lambda *what: F.sum(F.when(F.col("what").isin(*what), F.col("n")).otherwise(0)).cast("double")
    words = counts.where("what in ('period', 'plain', 'lower', 'inner')").groupBy("lang", F.col("a").alias("word")).agg(
        number("period").alias("with"), number("plain").alias("without"), number("lower").alias("low"), number("lower", "inner").alias("seen")
    )
    total = words.groupBy("lang").agg(F.sum("with").alias("periods"), F.sum(F.col("with") + F.col("without")).alias("all"))
    n = F.col("with") + F.col("without")
    ratio = 2 * (_ll(F.col("with"), n, F.lit(0.99)) - _ll(F.col("with"), n, F.col("periods") / F.col("all")))
    inner = F.length(F.regexp_replace("word", "[^.]", ""))
    size = F.greatest(F.length("word") - inner, F.lit(1))
    score = ratio * F.exp(-size.cast("double")) * (inner + 1) * F.pow(size.cast("double"), -F.least(F.col("without"), F.lit(200.0)))
    # one row per language
    return words.join(F.broadcast(total), "lang").select(
        "lang",
        "word",
        "with",
        "without",
        (F.col("low") > SMALL * F.col("seen")).alias("small"),
        ((F.col("with") > 0) & ((score >= ABBREVIATION) | F.col("word").startswith("##") | (F.length("word") == 1))).alias("abbr"),
    )


class Statistics(NamedTuple):
    """``words`` as of ``_words``; ``after`` (lang, type, next, n, abbr, small, count): the words
    that follow full stops, whether the word before is an abbreviation, and, of the word after,
    whether it is usually small and how often it occurs at all."""

    words: DataFrame
    after: DataFrame


def statistics(counts: DataFrame) -> Statistics:
    words = durable(_words(counts))
    types = words.where("with > 0").select("lang", F.col("word").alias("type"), "abbr")
    following = words.select("lang", F.col("word").alias("next"), "small", (F.col("with") + F.col("without")).alias("count"))
    after = counts.where("what = 'after'").select("lang", F.col("a").alias("type"), F.col("b").alias("next"), F.col("n").cast("double").alias("n"))
    after = after.join(types, ["lang", "type"], "left").join(following, ["lang", "next"], "left")
    return Statistics(words, durable(after.select("lang", "type", "next", "n", "abbr", F.coalesce("small", F.lit(False)).alias("small"), "count")))


def abbreviations(stats: Statistics) -> DataFrame:
    """(lang, type, common, ends) of every abbreviation: whether it is printed without
    period more often than with it, and how often, among its capitalised followers, it
    ends a sentence.

    ``ends`` relates its share of followers that are usually written small to the share
    after words that are no abbreviations. Learnt starters don't count here: they may be
    names, which follow titles as well.
    """
    begun = F.sum(F.when(F.col("small"), F.col("n")).otherwise(0))
    per = stats.after.where("next <> '##'").groupBy("lang", "type", "abbr").agg(F.sum("n").alias("caps"), begun.alias("begun"))
    usual = per.where("not abbr").groupBy("lang").agg((F.sum("begun") / F.sum("caps")).alias("usual"))
    own = per.where("abbr").select("lang", "type", "caps", "begun")
    return (
        stats.words.where("abbr")
        .select("lang", F.col("word").alias("type"), (F.col("without") > F.col("with")).alias("common"))
        .join(own, ["lang", "type"], "left")
        .join(F.broadcast(usual), "lang", "left")
        .select(
            "lang",
            "type",
            "common",
            # without capitals (or without plain stops) in a language nothing tells: an abbreviation ends nothing
            F.when(F.col("caps") > 0, F.least(F.lit(1.0), F.col("begun") / F.col("caps") / F.greatest(F.coalesce("usual", F.lit(1.0)), F.lit(0.05))))
            .otherwise(0.0)
            .alias("ends"),
        )
    )


def _dependence(k: F.Column, n1: F.Column, n2: F.Column, n: F.Column) -> F.Column:
    """Log-likelihood ratio of k joint occurrences of events seen n1 and n2 times in n."""
    p, rest = n2 / n, F.greatest(n - n1, F.lit(1.0))
    return 2 * (_ll(k, n1, k / n1) + _ll(n2 - k, rest, (n2 - k) / rest) - _ll(k, n1, p) - _ll(n2 - k, rest, p))


def starters(stats: Statistics) -> DataFrame:
    """(lang, next, starter): words that follow sure sentence ends (full stops after words
    that are no abbreviations, numbers or initials) far more often than their overall
    count lets expect, by the log-likelihood ratio."""
    sure = stats.after.where("not abbr and next not in ('', '##') and count is not null").groupBy("lang", "next").agg(F.sum("n").alias("k"), F.max("count").alias("seen"))
    every = stats.after.where("not abbr and next not in ('', '##')").groupBy("lang").agg(F.sum("n").alias("n1"))
    total = stats.words.groupBy("lang").agg(F.sum(F.col("with") + F.col("without")).alias("all"))
    k, n1, n2, n = F.col("k"), F.col("n1"), F.greatest("seen", "k"), F.col("all")
    return (
        sure.join(F.broadcast(every), "lang")
        .join(F.broadcast(total), "lang")
        .select("lang", "next", ((k * n > n1 * n2) & (_dependence(k, n1, n2, n) >= STARTER)).alias("starter"))
    )


def beginnings(stats: Statistics) -> DataFrame:
    """(lang, next): of the words that follow full stops those whose capital tells of a
    sentence's begin after an abbreviation: learnt starters, and words usually written small."""
    return starters(stats).where("starter").select("lang", "next").unionByName(stats.after.where("small").select("lang", "next")).distinct()


def collocations(stats: Statistics, begins: DataFrame) -> DataFrame:
    """(lang, type, next): pairs across a period that occur together far above chance,
    one of them a number and the second no sentence starter (months after ordinals,
    numbers after "No."). ``begins`` is that of ``beginnings``."""
    after = stats.after.select("lang", "type", "next", F.col("n").alias("k"))
    both = after.groupBy("lang").agg(F.sum("k").alias("all"))
    pairs = after.where("(startswith(type, '##') or next = '##') and k > 1")
    first = after.join(pairs.select("lang", "type").distinct(), ["lang", "type"], "left_semi").groupBy("lang", "type").agg(F.sum("k").alias("n1"))
    second = after.join(pairs.select("lang", "next").distinct(), ["lang", "next"], "left_semi").groupBy("lang", "next").agg(F.sum("k").alias("n2"))
    k, n1, n2, n = F.col("k"), F.col("n1"), F.col("n2"), F.col("all")
    return (
        pairs.join(first, ["lang", "type"])
        .join(second, ["lang", "next"])
        .join(F.broadcast(both), "lang")
        .where((k * n > n1 * n2) & (_dependence(k, n1, n2, n) >= COLLOCATION))
        .join(begins, ["lang", "next"], "left_anti")
        .select("lang", "type", "next")
    )


def thai_starters(counts: DataFrame) -> DataFrame:
    """(lang, next): beginnings of chunks that also begin paragraphs about as often as the
    chunks of the language do on average."""
    chunks = counts.where("what in ('first', 'chunk')")
    per = chunks.groupBy("lang", F.col("a").alias("next")).agg(
        F.sum(F.when(F.col("what") == "first", F.col("n")).otherwise(0)).alias("first"), F.sum("n").alias("seen")
    )
    mean = per.groupBy("lang").agg((F.sum("first") / F.sum("seen")).alias("mean"))
    return per.join(F.broadcast(mean), "lang").where(F.col("first") > 0.25 * F.col("mean") * F.col("seen")).select("lang", "next")


#: A sentence that would end at an abbreviation has at least so many words, unless
#: that is a number or, before no initial, a word printed without period more often than with it.
SHORTEST = 5
#: Rows learnt (abbreviations, starters, collocations, chunk beginnings; below 100 bytes
#: each) that are sent to all tasks; more of them are joined instead, with the same result.
MAX_LEARNT = 500_000


def learnt(counts: DataFrame) -> DataFrame:
    """(what, lang, a, b, common, ends): all that the classification asks for. ``abbr`` rows
    are abbreviations, ``begins`` words that begin sentences after one, ``bound``
    collocations, ``thai`` beginnings of chunks that begin sentences."""
    stats = statistics(counts)
    begins = durable(beginnings(stats))
    asked = stats.after.where("abbr").select("lang", "next").distinct()

    def rows(what: str, table: DataFrame, a: str, b: str | None = None, common: str | None = None, ends: str | None = None) -> DataFrame:
        return table.select(
            F.lit(what).alias("what"),
            "lang",
            F.col(a).alias("a"),
            (F.col(b) if b else F.lit("")).alias("b"),
            (F.col(common) if common else F.lit(False)).alias("common"),
            (F.col(ends) if ends else F.lit(0.0)).alias("ends"),
        )

    return (
        rows("abbr", abbreviations(stats), "type", common="common", ends="ends")
        .unionByName(rows("begins", begins.join(asked, ["lang", "next"], "left_semi"), "next"))
        .unionByName(rows("bound", collocations(stats, begins), "type", "next"))
        .unionByName(rows("thai", thai_starters(counts), "next"))
    )


def _judge(place: tuple, abbr: tuple[bool, float] | None, begins: bool, bound: bool, thai: bool) -> int:
    """Words that a sentence must have to end at a place; -1 if none ends there."""
    _, rule, kind, following, case = place
    if rule == "thai":
        return 0 if thai else -1
    if rule != "stop" or abbr is None and not bound:
        return 0
    if bound:
        return -1
    common, often = abbr
    enough = 0.5 if case == "digit" else 0.05 if begins else 0.25
    if case not in ("digit", "upper") or often < enough:
        return -1
    return 0 if kind.startswith("##") or common and not following.endswith(".") else SHORTEST


def _pair(following: str, case: str) -> str:
    return "##" if case == "digit" else following


def _walk(text: str, places: list[tuple[int, int]]) -> list[int]:
    """Ends of the sentences along (end, words needed)."""
    if all(need <= 0 for _, need in places):
        return [end for end, need in places if need == 0]
    tokens = [m.end() for m in _TOKEN.finditer(text)]
    out, words = [], 0
    for end, need in places:
        before = bisect_right(tokens, end)
        if need >= 0 and before - words >= need:
            words = before
            out.append(end)
    return out


def _spans(text: str, ends: list[int]) -> Iterator[tuple[int, int, int]]:
    """(number, start, end) of the sentences of a text, 0-based, without space in front."""
    begin = 0
    for i, end in enumerate(ends):
        while begin < end and text[begin].isspace():
            begin += 1
        yield i + 1, begin, end
        begin = end


def _first_of_key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by key, the first of every key."""
    last = None
    for pdf in batches:
        key = pdf["key"]
        keep = key != key.shift()
        if len(pdf) and last is not None and key.iloc[0] == last:
            keep.iloc[0] = False
        if len(pdf):
            last = key.iloc[-1]
        yield pdf[keep].astype({c: object for c in pdf.columns if pd.api.types.is_string_dtype(pdf[c])})


def _rows(keys: list, texts: list[str], cuts: list[list[int]], with_text: bool) -> pd.DataFrame:
    rows = [(k, i, a + 1, b, t[a:b] if with_text else None) for k, t, ends in zip(keys, texts, cuts) for i, a, b in _spans(t, ends)]
    return pd.DataFrame(rows, columns=["key", "sent_no", "start_char", "end_char", "text"])


def prepare(texts: DataFrame, *more: str) -> DataFrame:
    """(key, text, more) dealt out by key and written down; of the rows of one key the
    first by its text counts. Null keys and null texts are left out."""
    rows = texts.select("key", *more, "text").where("key is not null and text is not null")
    placed = balanced(rows, "key").sortWithinPartitions("key", "text", *more)
    return durable(placed.mapInPandas(_first_of_key, placed.schema))


def split_sentences(texts: DataFrame, with_text: bool = True, max_learnt: int = MAX_LEARNT) -> DataFrame:
    """(key, sent_no, start_char, end_char, text) of every sentence of (key, text, lang).

    Offsets are code points from 1 without surrounding space. Null, empty and blank
    texts have no sentence. The statistics are those of the given texts by ``lang``;
    a null language is one of its own. Of rows with one key the least text counts.
    ``with_text=False`` leaves the text of the sentences null.
    """
    return _split(prepare(texts, "lang").withColumn("lang", F.coalesce("lang", F.lit(""))), with_text, max_learnt)


def _split(source: DataFrame, with_text: bool = True, max_learnt: int = MAX_LEARNT) -> DataFrame:
    kind = source.schema["key"].dataType.simpleString()
    schema = f"key {kind}, sent_no int, start_char int, end_char int, text string"
    known = durable(learnt(durable(learn_counts(source))))
    rows = known.limit(max_learnt + 1).collect()
    if len(rows) > max_learnt:
        return _split_by_join(source, known, schema, with_text)
    sent = source.sparkSession.sparkContext.broadcast({(r["what"], r["lang"], r["a"], r["b"]): (r["common"], r["ends"]) for r in rows})

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = sent.value
        for pdf in batches:
            texts = pdf["text"].tolist()
            cuts = []
            for lang, text in zip(pdf["lang"], texts):
                places = []
                for place in candidates(text):
                    end, rule, word, following, case = place
                    abbr, begins, bound, thai = None, False, False, False
                    if rule == "stop":
                        abbr = table.get(("abbr", lang, word, ""))
                        begins = abbr is not None and ("begins", lang, following, "") in table
                        bound = ("bound", lang, word, _pair(following, case)) in table
                    elif rule == "thai":
                        thai = ("thai", lang, following, "") in table
                    places.append((end, _judge(place, abbr, begins, bound, thai)))
                cuts.append(_walk(text, places))
            yield _rows(pdf["key"].tolist(), texts, cuts, with_text)

    return source.select("key", "lang", "text").mapInPandas(split, schema)


def _split_by_join(source: DataFrame, known: DataFrame, schema: str, with_text: bool) -> DataFrame:
    """The same, with the places joined to what is learnt instead of sending it around."""
    kind = source.schema["key"].dataType.simpleString()
    found = "key {0}, lang string, end int, rule string, type string, next string, case string, pair string".format(kind)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (k, lang, end, rule, word, following, case, _pair(following, case))
                for k, lang, text in zip(pdf["key"], pdf["lang"], pdf["text"])
                for end, rule, word, following, case in candidates(text)
            ]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in found.split(", ")])

    def those(what: str, *names: str) -> DataFrame:
        return known.where(F.col("what") == what).select("lang", *(F.col(c).alias(n) for c, n in zip("ab", names)), *(("common", "ends") if what == "abbr" else (F.lit(True).alias(what),)))

    places = source.select("key", "lang", "text").mapInPandas(find, found)
    stops = (
        places.where("rule = 'stop'")
        .join(those("abbr", "type"), ["lang", "type"], "left")
        .join(those("begins", "next"), ["lang", "next"], "left")
        .join(those("bound", "type", "pair"), ["lang", "type", "pair"], "left")
        .withColumn("thai", F.lit(None).cast("boolean"))
    )
    empty = {"common": "boolean", "ends": "double", "begins": "boolean", "bound": "boolean"}
    others = places.where("rule <> 'stop'").join(those("thai", "next"), ["lang", "next"], "left").withColumns({c: F.lit(None).cast(t) for c, t in empty.items()})
    columns = ["end", "rule", "type", "next", "case", "common", "ends", "begins", "bound", "thai"]
    listed = stops.unionByName(others).groupBy("key").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("places"))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            cuts = []
            for text, own in zip(texts, pdf["places"]):
                judged = []
                for x in own:
                    place = x["end"], x["rule"], x["type"], x["next"], x["case"]
                    abbr = None if x["ends"] is None else (x["common"], x["ends"])
                    judged.append((x["end"], _judge(place, abbr, bool(x["begins"]), bool(x["bound"]), bool(x["thai"]) and x["rule"] == "thai")))
                cuts.append(_walk(text, judged))
            yield _rows(pdf["key"].tolist(), texts, cuts, with_text)

    return source.select("key", "text").join(listed, "key").mapInPandas(split, schema)


def book_languages(paragraphs: DataFrame, books: DataFrame) -> DataFrame:
    """(book_id, lang) inferred from the words of all paragraphs of a book, with the books'
    labels only as a start of the language models."""
    labels = books.where("book_id is not null").groupBy("book_id").agg(F.max("lang").alias("lang"))
    model = lg.learn_models(paragraphs, "text", "book_id", rounds=1, labels=labels)
    votes = lg.language_words(paragraphs, "book_id", "text", model)
    return votes.groupBy(F.col("key").alias("book_id")).agg(F.max_by("lang", F.struct("words", "lang")).alias("lang"))


def paragraph_sentences(paragraphs: DataFrame, books: DataFrame, with_text: bool = True) -> DataFrame:
    """Sentences of all paragraphs, each under the language inferred for its book."""
    texts = prepare(paragraphs.select(F.col("para_id").alias("key"), "book_id", "text"), "book_id")
    langs = durable(book_languages(texts, books))
    source = texts.join(langs, "book_id", "left").select("key", F.coalesce("lang", F.lit("")).alias("lang"), "text")
    return _split(source, with_text)
