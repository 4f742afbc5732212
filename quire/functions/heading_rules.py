"""Grammar of chapter headings: lexical classes, their sequences, and the best match."""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import groupby, product

from quire.functions.text import NUMBER_WORDS, cardinal, ordinal

# Lexical classes.
DESCRIPTORS = "CHAPTER Chapter CHAP Chap PART Part BOOK Book STORY Story LETTER Letter VOLUME Volume VOL Vol CASE Case".split()
PATTERNS = {
    "desc": "(?:" + "|".join(DESCRIPTORS) + r")(?:[^\S\r\n]*(?:THE|The|the|NO|No|no|NO\.|No\.|no\.|NUMBER|Number|number|NUMBER\.|Number\.|number\.))*",
    "roman_upper": r"(?=[MDCLXVI])M*(?:C[MD]|D?C{0,3})(?:X[CL]|L?X{0,3})(?:I[XV]|V?I{0,3})(?![A-Za-z0-9'\"])",
    "roman_lower": r"(?=[mdxlxvi])m*(?:c[md]|d?c{0,3})(?:x[cl]|l?x{0,3})(?:i[xv]|v?i{0,3})(?![A-Za-z0-9'\"])",
    "numeral": r"[0-9]+",
    "punctuation": r"[^a-zA-Z\d\s\"']+",
    "title_upper": r"[^A-Za-z]*[A-Z][^a-z]+",
    "title_lower": r"[^A-Za-z\d]*[^\S\r\n\D]*[A-Z][^\r\n]*[^\.\?\-!:;,]",
    "whitespace": r"\s+",
    "generic_text": r".+",
}
#: Words with which the number words of headings begin.
NUMBER_PARTS = tuple(dict.fromkeys(w.replace(" ", "-").split("-")[0] for w in NUMBER_WORDS))
STYLES = ("one", "One", "ONE", "first", "First", "FIRST")
ROMAN = ("roman_upper", "roman_lower")
WORDS = tuple(f"word_number_{s}" for s in STYLES)
NUMBERS = (*ROMAN, "numeral", *WORDS)
TITLES = ("title_upper", "title_lower")
PRIORITY = (
    "desc", *ROMAN, "numeral", *(f"word_number_{s}" for s in ("first", "First", "FIRST", "one", "One", "ONE")),
    "punctuation", "whitespace", *TITLES, "generic_text",
)
GAP = ("whitespace",)
SLOTS = (
    (("desc",), GAP, ("punctuation",), GAP, NUMBERS, GAP, ("punctuation",), GAP, TITLES),
    (("word_number_First", "word_number_FIRST"), GAP, ("desc",), GAP, ("punctuation",), GAP, TITLES),
)


def _styled(word: str, style: str) -> set[str]:
    if style.isupper():
        return {word.upper()}
    if style.islower():
        return {word}
    # every word capitalised, and the same with a small "and" and a small second half
    return {word.title(), " ".join(w if w == "and" else w.capitalize() for w in word.split())}


@lru_cache
def pattern(name: str) -> str:
    if name in PATTERNS:
        return PATTERNS[name]
    style = name.rpartition("_")[2]
    spell = ordinal if style.lower() == "first" else cardinal
    words = {w for n in range(201) for w in _styled(spell(n), style)}
    longest_first = sorted(words, key=lambda w: (-len(w), w))
    return "(?:" + "|".join(re.escape(w).replace(r"\-", r"\s*-\s*").replace(r"\ ", " ") for w in longest_first) + r")(?!-| and)"


def _allowed(seq: tuple[str, ...]) -> bool:
    numbered = any(n in seq for n in NUMBERS)
    if "desc" in seq:
        i = seq.index("desc")
        if i + 1 < len(seq) and seq[i + 1] not in ("punctuation", "whitespace"):
            return False
        if not numbered:
            return False
    elif "generic_text" in seq and any(n in seq for n in NUMBERS if n not in ("word_number_ONE", "word_number_FIRST")):
        return False
    if any(seq[i : i + 3] == ("punctuation", "whitespace", "punctuation") for i in range(len(seq))):
        return False
    if seq[0] in ("word_number_one", "word_number_first"):
        return False
    if seq[0] == "punctuation":
        if seq.count("punctuation") == 1:
            return False
        if len(seq) > 3 and seq[1] in NUMBERS and seq[2] == "punctuation" and seq[3:] in (("whitespace", "generic_text"), ("generic_text",)):
            return False
    return True


@lru_cache(1)
def rules() -> tuple[tuple[str, ...], ...]:
    """All heading shapes, best first: every selection from the slots without repeats of a
    class in a row and without space at the ends, numbered titles also as free text."""
    found: dict[tuple[str, ...], None] = {}
    for slots in SLOTS:
        for choice in product(*[("", *s) for s in slots]):
            seq = [k for k, _ in groupby(c for c in choice if c)]
            while seq and seq[0] == "whitespace":
                seq.pop(0)
            while seq and seq[-1] == "whitespace":
                seq.pop()
            if seq:
                found[tuple(seq)] = None
    for seq in list(found):
        for title in TITLES:
            if title in seq and any(n in seq for n in NUMBERS):
                found[tuple("generic_text" if x == title else x for x in seq)] = None
    return tuple(sorted((s for s in found if _allowed(s)), key=lambda s: ([PRIORITY.index(x) for x in s], s)))


@lru_cache(4096)
def _compiled(seq: tuple[str, ...]) -> re.Pattern[str]:
    return re.compile("".join(f"({pattern(x)})" for x in seq))


_HINTS = {k: re.compile(pattern(k)) for k in ("desc", *NUMBERS)}


@lru_cache(4096)
def _possible(present: frozenset[str]) -> tuple[tuple[str, ...], ...]:
    return tuple(s for s in rules() if all(x in present for x in s if x in _HINTS))


def best_rule(text: str) -> tuple[str, ...] | None:
    """The first rule that matches the whole text. Only rules whose classes occur somewhere
    in the text are tried."""
    if not text:
        return None
    present = frozenset(k for k, r in _HINTS.items() if r.search(text))
    return next((s for s in _possible(present) if _compiled(s).fullmatch(text)), None)


def is_title(text: str, kinds: tuple[str, ...] = TITLES) -> bool:
    return any(_compiled((k,)).fullmatch(text) for k in kinds)


def number_value(text: str, kind: str) -> int | None:
    if kind == "numeral":
        return int(text)
    if kind in ROMAN:
        values = [dict(zip("IVXLCDM", (1, 5, 10, 50, 100, 500, 1000)))[c] for c in text.upper()]
        return sum(-v if any(w > v for w in values[i + 1 : i + 2]) else v for i, v in enumerate(values))
    return NUMBER_WORDS.get(re.sub(r"\s*-\s*", "-", " ".join(text.lower().split())))


def parts(text: str, rule: tuple[str, ...]) -> dict:
    """desc, number, number_text, number_type and title that a rule reads in a text.

    Every class takes what it can from the left, as when the rule is read word by word;
    free text is no title."""
    out = dict.fromkeys(("desc", "number", "number_text", "number_type", "title"))
    if rule == ("title_upper",):
        return out | {"title": text}
    rest = text
    for name in rule:
        if name == "whitespace":
            rest = rest.lstrip()
            continue
        m = re.match(pattern(name), rest)
        if not m:
            break
        taken, rest = m.group().strip(), rest[m.end() :]
        if name == "desc":
            out["desc"] = taken
        elif name in NUMBERS:
            out |= {"number": number_value(taken, name), "number_text": taken, "number_type": name}
        elif name in TITLES:
            out["title"] = taken
    return out
