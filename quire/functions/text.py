"""Column expressions on text: cleaning, similarity, numbers. All stay in the JVM
except transliteration, which looks signs up in a table."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from quire.functions.types import LONG, STRING

# Signs and letters that go before the general transliteration.
TRANSLITERATION = {
    "’": "'", "‘": "'", "‚": "'", "“": '"', "”": '"', "„": '"', "«": '"', "»": '"', "—": "--", "–": "-", "‐": "-", "…": "...",
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "þ": "th",
    "ð": "d", " ": " ", "†": "+", "•": "*", "£": "PS", "€": "EUR",
}


def lines_of(text: Column | str) -> Column:
    """Lines without trailing white space; a last line break ends a line and begins none."""
    text = F.col(text) if isinstance(text, str) else text
    lines = F.split(F.regexp_replace(text, r"(\r\n|[\n\r\x0B\f\x85\x{2028}\x{2029}])\z", ""), r"\r\n|[\n\r\x0B\f\x85\x{2028}\x{2029}]", -1)
    return F.transform(F.when(text == "", F.array().cast("array<string>")).otherwise(lines), lambda s: F.regexp_replace(s, r"(?U)\s+$", ""))


def clean_line(text: Column | str) -> Column:
    """Letters only: everything else becomes one space, ends trimmed, lower case."""
    text = F.col(text) if isinstance(text, str) else text
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)[\W\d_]+", " ")))


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; two empty strings are equal."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)


def similar(a: Column, b: Column, ratio: float) -> Column:
    """similarity >= ratio, tested on the lengths first, since distance >= their difference."""
    longest = F.greatest(F.length(a), F.length(b))
    near = F.abs(F.length(a) - F.length(b)) <= (1 - ratio) * longest
    return F.when(near, similarity(a, b) >= ratio).otherwise(False)


def weighted_distance(a: str, b: str, insert: int = 1, delete: int = 1, replace: int = 1) -> int:
    """Least cost of turning one text into another, with a price for each kind of change."""
    row = [j * insert for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i * delete
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + delete, row[j - 1] + insert, above + (x != y) * replace)
    return row[-1]


def distance(a: Column | str, b: Column | str, insert: int = 1, delete: int = 1, replace: int = 1) -> Column:
    """Edit distance of two columns; unit prices stay in the JVM. Null with a null."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    if insert == delete == replace == 1:
        return F.levenshtein(a, b)

    @F.pandas_udf(LONG)
    def priced(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if s is None or t is None else weighted_distance(s, t, insert, delete, replace) for s, t in zip(x, y)], dtype="Int64")

    return priced(a, b)


def xml_safe(text: Column | str) -> Column:
    """Without the characters that XML 1.0 forbids."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(text, r"[^\x09\x0A\x0D\x20-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]", "")


def plain_quotes(text: Column | str) -> Column:
    """Doubled single quotes as double quotes."""
    text = F.col(text) if isinstance(text, str) else text
    return F.replace(F.replace(text, F.lit("''"), F.lit('"')), F.lit("``"), F.lit('"'))


_latin: dict[int, str] = {}


def _named(c: str) -> str:
    """Last resort for a letter: the last word of its Unicode name, else its code."""
    words = [w for w in unicodedata.name(c, "").split() if w.isascii() and w.isalpha()]
    return words[-1].lower() if words else f"u{ord(c):x}"


def latin_table(spark: SparkSession) -> dict[int, str]:
    """ASCII renderings of all other letters, marks, digits and signs of Unicode, made once by
    the transliterator that Spark brings along (pinyin, romaji, Cyrillic, Thai, Devanagari, ...)
    in one call. No letter or digit is left without a rendering; the table has the size of
    Unicode whatever the texts."""
    if _latin:
        return _latin
    signs = [chr(c) for c in range(0x80, 0x2FA20) if unicodedata.category(chr(c))[0] in "LMNPSZ"]
    icu = spark.sparkContext._jvm.com.ibm.icu.text.Transliterator
    rules = "Any-Latin; NFKD; [:Mn:] Remove; Latin-ASCII"
    # each sign on a line of its own, so that none changes its neighbour's reading
    rendered = icu.getInstance(rules).transliterate("\n".join(signs)).split("\n")
    # Russian letters behind a consonant, as they are read within words
    russian = [c for c in signs if "\u0400" <= c < "\u0530"]
    read = icu.getInstance(f"Russian-Latin/BGN; {rules}").transliterate("\n".join("т" + c for c in russian)).split("\n")
    if len(rendered) != len(signs) or len(read) != len(russian):
        raise ValueError("transliteration lost line breaks")
    readings = dict(zip(signs, rendered)) | {c: out[1:] for c, out in zip(russian, read)}
    for c, out in readings.items():
        kind = unicodedata.category(c)[0]
        flat = "".join(x for x in unicodedata.normalize("NFKD", out) if x.isascii())
        if kind in "LN" and not flat.strip():
            value = unicodedata.numeric(c, None) if kind == "N" else None
            flat = f"{value:g}" if value is not None else _named(c)
        _latin[ord(c)] = flat
    _latin.update({ord(k): v for k, v in TRANSLITERATION.items()})
    return _latin


def transliterate(text: Column | str) -> Column:
    """ASCII rendering of a text in any script, sign by sign; a Chinese character is a
    syllable with a space after it. Signs without rendering (marks, symbols) are dropped,
    letters and digits never."""
    spark = SparkSession.active()
    sent = spark.sparkContext.broadcast(latin_table(spark))

    @F.pandas_udf(STRING)
    def render(texts: pd.Series) -> pd.Series:
        table = {k: v + " " if 0x3400 <= k < 0xA000 or 0xF900 <= k < 0xFB00 or k >= 0x20000 else v for k, v in sent.value.items()}
        return texts.map(lambda t: t if t.isascii() else unicodedata.normalize("NFC", t).translate(table).encode("ascii", "ignore").decode("ascii"), na_action="ignore")

    return render(F.col(text) if isinstance(text, str) else text)


def capital_share(text: Column | str) -> Column:
    """Share of upper-case letters among letters; null without letters."""
    text = F.col(text) if isinstance(text, str) else text
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    return F.when(letters > 0, F.length(F.regexp_replace(text, r"[^\p{Lu}]", "")) / letters)


def raise_capitals(text: Column | str) -> Column:
    """Texts of more than 75 % capitals in capitals altogether."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(capital_share(text) > 0.75, F.upper(text)).otherwise(text)


def bare(text: Column | str) -> Column:
    """Without surrounding white space, then without surrounding quotes."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), "^[\"']+|[\"']+$", "")


def roman_value(text: Column | str) -> Column:
    """Value of a Roman numeral in either case; null for anything else."""
    text = F.col(text) if isinstance(text, str) else text
    upper = F.upper(text)
    signs = F.split(upper, "")
    values = F.create_map(*[F.lit(x) for pair in (("I", 1), ("V", 5), ("X", 10), ("L", 50), ("C", 100), ("D", 500), ("M", 1000)) for x in pair])
    numbers = F.transform(F.filter(signs, lambda c: c != ""), lambda c: F.try_element_at(values, c))
    total = F.aggregate(
        F.reverse(numbers),
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last")),
        lambda acc, v: F.struct(
            F.when(v < acc["last"], acc["sum"] - v).otherwise(acc["sum"] + v).alias("sum"), F.greatest(v, acc["last"]).alias("last")
        ),
        lambda acc: acc["sum"],
    )
    return F.when(upper.rlike("^[MDCLXVI]+$"), total)


_ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
_IRREGULAR = {"one": "first", "two": "second", "three": "third", "five": "fifth", "eight": "eighth", "nine": "ninth", "twelve": "twelfth"}


def cardinal(n: int) -> str:
    """English words of 0..200."""
    if n < 20:
        return _ONES[n]
    if n < 100:
        return _TENS[n // 10 - 2] + (f"-{_ONES[n % 10]}" if n % 10 else "")
    return f"{_ONES[n // 100]} hundred" + (f" and {cardinal(n % 100)}" if n % 100 else "")


def ordinal(n: int) -> str:
    words = cardinal(n)
    cut = max(words.rfind(" "), words.rfind("-")) + 1
    head, last = words[:cut], words[cut:]
    last = _IRREGULAR.get(last) or (f"{last[:-1]}ieth" if last.endswith("y") else f"{last}th")
    return head + last


NUMBER_WORDS = {cardinal(n): n for n in range(201)} | {ordinal(n): n for n in range(201)}


def number_word_value(text: Column | str) -> Column:
    """Value of a cardinal or ordinal number word 0..200 in any case; null for others."""
    text = F.col(text) if isinstance(text, str) else text
    flat = F.regexp_replace(F.regexp_replace(F.trim(F.lower(text)), r"\s*-\s*", "-"), r"\s+", " ")
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in NUMBER_WORDS.items() for x in pair]), flat)
