"""Text of scanned pages: furniture, strays, broken and misread words, paragraphs.

The lines of a page (header field, body, footer field, in this order) are labelled
by a hidden Markov model as header, text, break (a heading that belongs to the
text) or footer. Its features are layout: place on the page, form of the line,
whether it recurs at the edges of the book's other pages, whether lines of its
shape stand at edges or within pages. The model starts from priors and is refitted
to all pages. Words broken at line ends are settled by how the collection prints
them elsewhere, misread words by a noisy channel whose glyph confusions are
learnt from pairs of a rare and a far more frequent spelling.

A page stays one row with its text throughout; its lines' features and labels go
along as bytes. Words are counted in the tasks before anything is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.runtime import durable, task_count

STATES = ("header", "text", "break", "footer")
_H, _B, _K, _T = range(4)

#: Lines at the top and the bottom of a body that are an edge.
EDGE = 3
#: Pages of a book, consecutive by number, among which recurrence is seen, and pages at
#: most that one task looks at together (more, as by repeated deliveries, are parted by hash).
BLOCK, CELL = 1000, 2000
#: Characters of the runs by which lines recur, and pages on which a run must stand.
RUN, PAGES = 8, 3

_NUMBER = re.compile(r"^\W*[0-9lIOoSZz]*[0-9lIO][0-9lIOoSZz]*\W*$")
_FRAMED = re.compile(r"^(?:[\[(—–-]\s*[0-9lIOS]{1,4}\s*[\])—–-]?|(?:page|seite|pag\.?|p\.|стр\.?)\s+[0-9lIOS]{1,4})$", re.I)
_ROMAN = re.compile(r"^[\[(—–-]?\s*[ivxlcdm]{1,8}\s*[\])—–-]?$")
_SIGNATURE = re.compile(r"^[A-Z]\s?\d{0,2}$")
_FOLIO = re.compile(r"^\s*[0-9lIOS]{1,4}\s{2,}\S|\S\s{2,}[0-9lIOS]{1,4}\s*$")
_ENDS = frozenset(".!?…。！？।:;,\"”’»』」)")
_FRAMES = frozenset("[(—–-pPsSсС")
_DIGITS = re.compile(r"\d+")
#: Framed numbers are no longer than that, the spaces inside them included.
_SHORT = 40


def shape(line: str) -> str:
    """A line without the digits and spaces in which its repetitions differ."""
    return " ".join(_DIGITS.sub("#", line).split())


def _ended(text: str) -> bool:
    """Whether the signs at the end of a line hold a mark that ends or parts sentences."""
    i = len(text)
    while i and not (text[i - 1].isalnum() or text[i - 1] == "_"):
        i -= 1
        if text[i] in _ENDS:
            return True
    return False


def form(line: str) -> int:
    text = line.strip()
    size = len(text)
    if size <= _SHORT:
        if text[0] in _FRAMES and _FRAMED.match(text):
            return 2
        if size <= 9 and _NUMBER.match(text):
            return 5 if text[-1] == "." else 0
        if size <= 16 and _ROMAN.match(text):
            return 1
        if size <= 5 and _SIGNATURE.match(text):
            return 3
    if ("  " in text or "\t" in text or "\u3000" in text) and _FOLIO.search(line):
        return 4
    lower = sum(map(str.islower, text))
    upper = 0 if lower > 0.25 * size and not text.istitle() else sum(map(str.isupper, text))
    if not upper and not lower:
        return 11 if size >= 12 else 13
    ended = _ended(text)
    if upper > 3 * lower:
        return 7 if ended else 6
    if size < 12:
        return 10
    if not ended:
        long = [w for w in text.split() if len(w) > 3]
        if len(long) > 1 and sum(w[0].isupper() for w in long) > 0.7 * len(long):
            return 12
    return 8 if ended else 9


def page_lines(header: str | None, body: str | None, footer: str | None) -> list[tuple[int, int, str, bool]]:
    """(zone, line number in its field, line, blank line after it) of all lines that aren't blank."""
    out = []
    for zone, field in enumerate((header, body, footer)):
        lines = field.split("\n") if field else []
        for i, line in enumerate(lines):
            if line.strip():
                out.append((zone, i + 1, line, i + 1 < len(lines) and not lines[i + 1].strip()))
    return out


def place(lines: list[tuple[int, int, str, bool]]) -> list[int]:
    n = sum(z == 1 for z, *_ in lines)
    out, body, seen = [], 0, [0, 0, 0]
    for zone, *_ in lines:
        seen[zone] += 1
        if zone == 0:
            out.append(min(seen[0], 2) - 1)
        elif zone == 2:
            out.append(7 if seen[2] == 1 else 8)
        else:
            out.append(2 if body == 0 else 6 if body == n - 1 else 3 if body == 1 else 5 if body == n - 2 else 4)
            body += 1
    return out


#: Places of a line: header field first, further; body first, second, within, last but
#: one, last; footer field first, further; anywhere on a title page. The place decides the moves between states.
PLACES = 10
#: Values of each feature: form, recurrence, usual place of the shape, blank after, length.
SIZES = (15, 3, 3, 2, 4)

# Priors as rough shares per state; the fit to all pages moves them.
_PRIOR = (
    # form: number, roman, framed, signature, folio and text, number with stop, capitals, capitals with stop, text ended,
    # text, short, no case, title, short without case, capitals or short on a page without running text
    ((6, 4, 4, 1, 20, 0.05, 30, 1, 0.3, 3, 1, 6, 14, 3, 0.3), (0.05, 0.02, 0.05, 0.05, 0.2, 1, 0.5, 2, 30, 60, 6, 8, 1, 3, 1), (0.1, 0.3, 0.1, 0.2, 0.3, 1, 8, 12, 0.5, 1, 2, 1, 2, 6, 10), (25, 12, 20, 8, 1, 0.1, 4, 4, 0.1, 0.3, 0.3, 0.3, 1, 0.3, 0.3)),
    # recurrence: none, some, much
    ((2, 6, 40), (96, 3, 1), (80, 10, 10), (60, 10, 10)),
    # usual place of the shape: unknown or both, within pages, at edges
    ((30, 0.2, 30), (80, 15, 3), (40, 30, 8), (10, 0.1, 50)),
    # blank line after
    ((30, 4), (60, 20), (1, 20), (20, 2)),
    # length against the usual line of the page: short, medium, long, longer
    ((10, 10, 5, 1), (10, 10, 60, 1), (10, 3, 1, 0.2), (25, 4, 1, 1)),
)
# moves into a line by its place: from the page's begin, header, text, break, footer (rows)
# to header, text, break, footer (columns); 0 is impossible
_AFTER_FOOTER = (0, 0, 0, 10)
_FIELD = ((93, 7, 0, 0), (85, 15, 0, 0), (0, 10, 0, 0), (0, 10, 0, 0), _AFTER_FOOTER)
_MOVES = (
    _FIELD,
    _FIELD,
    ((30, 55, 14, 1), (20, 65, 15, 0), (0, 90, 10, 0), (0, 95, 5, 0), _AFTER_FOOTER),
    ((5, 95, 5, 0), (8, 75, 17, 0), (0, 97, 3, 0), (0, 90, 10, 0), _AFTER_FOOTER),
    ((0, 95, 5, 0), (2, 93, 5, 0), (0, 97.9, 2, 0.1), (0, 90, 10, 0.1), _AFTER_FOOTER),
    ((0, 90, 5, 5), (0, 90, 5, 5), (0, 94, 2, 4), (0, 88, 8, 4), _AFTER_FOOTER),
    ((0, 60, 5, 35), (0, 60, 5, 35), (0, 59, 1, 40), (0, 60, 5, 35), _AFTER_FOOTER),
    ((0, 7, 0, 93), (0, 7, 0, 93), (0, 7, 0, 93), (0, 7, 0, 93), _AFTER_FOOTER),
    ((0, 7, 0, 93), (0, 7, 0, 93), (0, 15, 0, 85), (0, 7, 0, 93), _AFTER_FOOTER),
    ((0, 95, 5, 0), (0, 95, 5, 0), (0, 98, 2, 0), (0, 90, 10, 0), _AFTER_FOOTER),
)
_N_MOVES = PLACES * 5 * 4


def prior_counts() -> np.ndarray:
    """Flat counts: moves by place, then every feature by state and value."""
    parts = [np.asarray(_MOVES, float).reshape(-1)] + [np.asarray(t, float).reshape(-1) for t in _PRIOR]
    return np.concatenate(parts)


def log_parameters(counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    def share(a: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.log(a / a.sum(axis=-1, keepdims=True))

    moves = counts[:_N_MOVES].reshape(PLACES, 5, 4)
    moves = np.where(np.asarray(_MOVES, float) > 0, moves + 0.5, 0)  # the order of the states is fixed
    out, at = [], _N_MOVES
    for n in SIZES:
        out.append(share(counts[at : at + 4 * n].reshape(4, n) + 0.05))
        at += 4 * n
    return share(moves), out


def viterbi(pages: list[np.ndarray], parameters: tuple) -> list[np.ndarray]:
    """States of the lines of every page, many pages at a time; column 0 of the features is the place."""
    moves, emit = parameters
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(pages)
    order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: -len(pages[i]))
    while order:
        longest = len(pages[order[0]])
        some, order = order[: max(1, (1 << 16) // longest)], order[max(1, (1 << 16) // longest) :]
        sizes = np.array([len(pages[i]) for i in some])
        x = np.zeros((len(some), longest, len(SIZES) + 1), dtype=np.int64)
        for row, i in enumerate(some):
            x[row, : sizes[row]] = pages[i]
        scores = sum(e.T[x[:, :, k + 1]] for k, e in enumerate(emit))
        value = moves[x[:, 0, 0], 0] + scores[:, 0]
        back = np.zeros((longest, len(some), 4), dtype=np.int8)
        for t in range(1, longest):
            m = int(np.searchsorted(-sizes, -t))  # pages that have line t stand in front
            step = value[:m, :, None] + moves[x[:m, t, 0], 1:]
            back[t, :m] = step.argmax(axis=1)
            value[:m] = step.max(axis=1) + scores[:m, t]
        now = value.argmax(axis=1)
        path = np.zeros((len(some), longest), dtype=np.int64)
        path[np.arange(len(some)), sizes - 1] = now
        for t in range(longest - 1, 0, -1):
            m = int(np.searchsorted(-sizes, -t))
            now[:m] = back[t, np.arange(m), now[:m]]
            path[:m, t - 1] = now[:m]
        for row, i in enumerate(some):
            out[i] = path[row, : sizes[row]]
    return out


def runs_of(line: str) -> set[str]:
    """Runs of letters by which a line recurs."""
    bare = "".join(filter(str.isalpha, line.lower()))
    return {bare[j : j + RUN] for j in range(max(1, len(bare) - RUN + 1))} if bare else set()


def features(pages: list[list[tuple[int, int, str, bool]]]) -> list[np.ndarray]:
    """Feature values of the lines of pages that lie together in a book: place, form,
    recurrence at the edges of these pages, usual place (0, filled in later), blank, length."""
    runs, often = [], Counter()
    for lines in pages:
        body = [i for i, x in enumerate(lines) if x[0] == 1]
        edges = {*body[:EDGE], *body[len(body) - min(EDGE, len(body)) :]}
        own = {i: runs_of(x[2]) for i, x in enumerate(lines) if x[0] != 1 or i in edges}
        runs.append(own)
        often.update(set().union(*own.values()))
    out = []
    for lines, own in zip(pages, runs):
        x = np.zeros((len(lines), len(SIZES) + 1), dtype=np.int64)
        places = place(lines)
        sizes = sorted(len(v[2].strip()) for v in lines if v[0] == 1)
        usual_size = max(1, sizes[int(len(sizes) * 0.75)] if sizes else 40)
        forms = [form(v[2]) for v in lines]
        # a title page, if anything
        title = not any(f in (8, 9, 11) for f, v in zip(forms, lines) if v[0] == 1)
        for i, (zone, _, line, blank) in enumerate(lines):
            mine = own.get(i)
            share = sum(often[r] >= PAGES for r in mine) / len(mine) if mine else 0
            # an edge or not, little recurrence says nothing of text; only more adds to the place
            recurs = 0 if share < 0.2 else 1 if share < 0.5 else 2
            # a title page has no furniture but numbers: its lines are what headers repeat
            odd = title and zone == 1 and forms[i] in (6, 7, 10, 12, 13)
            size = len(line.strip()) / usual_size
            x[i] = 9 if odd else places[i], 14 if odd else forms[i], recurs, 0, blank, 0 if size < 0.4 else 1 if size < 0.8 else 2 if size < 1.2 else 3
        out.append(x)
    return out


def edge_lines(lines: list[tuple[int, int, str, bool]]) -> list[bool]:
    """Whether each line stands in header or footer field or at an edge of the body."""
    body = [i for i, x in enumerate(lines) if x[0] == 1]
    edges = {*body[:EDGE], *body[len(body) - min(EDGE, len(body)) :]}
    return [x[0] != 1 or i in edges for i, x in enumerate(lines)]


_PAGE = "page_id long, book_id string, page_no int, page_header string, page_body string, page_footer string"
_ANALYSED = _PAGE + ", features binary, shapes array<long>, edges array<boolean>"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _lines(pdf: pd.DataFrame) -> list[list[tuple[int, int, str, bool]]]:
    return [page_lines(*x) for x in zip(pdf["page_header"], pdf["page_body"], pdf["page_footer"])]


def _plain(pdf: pd.DataFrame) -> pd.DataFrame:
    """The same rows as plain objects, null as None, ready to be sent back."""
    out = pdf.astype(object).where(pdf.notna(), None)
    return out.astype({"page_id": "int64", "page_no": "Int32"})


def _matrix(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8).reshape(-1, len(SIZES) + 1).astype(np.int64)


def analyse(pages: DataFrame) -> DataFrame:
    """Pages with the features of their lines and the hashes of their shapes.

    Pages of a book that lie together meet in one task (``BLOCK``, ``CELL``), in which
    recurrence is counted; a page without book or number is alone. Of rows with one
    ``page_id`` the least one counts, null ids are left out.
    """
    source = pages.where("page_id is not null").select(*_names(_PAGE))
    named = "book_id is not null and page_no is not null"
    source = source.withColumn("block", F.when(F.expr(named), F.floor(F.col("page_no") / BLOCK)))
    sizes = source.where(named).groupBy("book_id", "block").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("cells"))
    placed = source.join(sizes, ["book_id", "block"], "left").withColumn(
        "cell", F.when(F.col("cells") > 1, F.pmod(F.xxhash64("page_id"), F.col("cells"))).when(F.col("cells").isNull(), F.col("page_id")).otherwise(0)
    )
    placed = placed.select(*_names(_PAGE), "block", "cell")
    dealt = placed.repartition(task_count(pages.sparkSession), "book_id", "block", "cell").sortWithinPartitions("book_id", "block", "cell", "page_id", "page_no", "page_body", "page_header", "page_footer")

    def block(rows: list[dict]) -> Iterator[tuple]:
        rows = [next(own) for _, own in groupby(rows, key=lambda r: r["page_id"])]
        lines = [page_lines(r["page_header"], r["page_body"], r["page_footer"]) for r in rows]
        for r, own, x in zip(rows, lines, features(lines)):
            shapes = [xxhash.xxh3_64_intdigest(shape(v[2])) - 2**63 for v in own]
            yield (*(r[c] for c in _names(_PAGE)), x.astype(np.uint8).tobytes(), shapes, edge_lines(own))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (dict(zip(pdf.columns, r)) for pdf in batches for r in pdf.astype(object).where(pdf.notna(), None).itertuples(index=False))
        out = []
        for _, own in groupby(rows, key=lambda r: (r["book_id"], r["block"], r["cell"])):
            out += block(list(own))
            if len(out) >= 500:
                yield pd.DataFrame(out, columns=_names(_ANALYSED))
                out = []
        yield pd.DataFrame(out, columns=_names(_ANALYSED))

    return durable(dealt.mapInPandas(run, _ANALYSED))


#: Rows learnt (shapes, misread words) that are sent to all tasks; more are joined instead.
MAX_LEARNT = 500_000


def usual_places(analysed: DataFrame) -> DataFrame:
    """(shape, usual): where the lines of a shape usually stand, 1 within pages, 2 at
    edges; shapes that are rare, or that stand in both places, are left out."""
    lines = analysed.select(F.explode(F.arrays_zip("shapes", "edges")).alias("s")).select(F.col("s.shapes").alias("shape"), F.col("s.edges").cast("int").alias("edge"))
    counted = lines.groupBy("shape").agg(F.sum("edge").alias("e"), F.count(F.lit(1)).alias("n")).where(f"n >= {PAGES}")
    usual = F.when(F.col("e") < 0.6 * F.col("n"), 1).when(F.col("e") >= 0.9 * F.col("n"), 2)
    return counted.select("shape", usual.alias("usual")).where("usual is not null")


def with_usual(analysed: DataFrame, max_learnt: int = MAX_LEARNT) -> DataFrame:
    """Pages with the usual place of each line's shape filled into the features."""
    known = durable(usual_places(analysed))
    rows = known.limit(max_learnt + 1).collect()
    if len(rows) <= max_learnt:
        order = sorted((r["shape"], r["usual"]) for r in rows)
        sent = analysed.sparkSession.sparkContext.broadcast((np.array([k for k, _ in order], dtype=np.int64), np.array([v for _, v in order], dtype=np.int64)))
        asked = analysed.withColumn("known", F.lit(None).cast("array<struct<shape:bigint,usual:int>>"))
    else:
        sent = None
        per = analysed.select("page_id", F.explode(F.array_distinct("shapes")).alias("shape")).join(known, "shape").groupBy("page_id").agg(F.collect_list(F.struct("shape", "usual")).alias("known"))
        asked = analysed.join(per, "page_id", "left")

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for data, shapes, own in zip(pdf["features"], pdf["shapes"], pdf["known"]):
                x = _matrix(data).astype(np.uint8)
                if sent is not None:
                    keys, values = sent.value
                    if len(keys) and len(x):
                        at = np.minimum(np.searchsorted(keys, shapes), len(keys) - 1)
                        x[:, 3] = np.where(keys[at] == shapes, values[at], 0)
                elif own is not None:
                    table = {r["shape"]: r["usual"] for r in own}
                    x[:, 3] = [table.get(k, 0) for k in shapes]
                out.append(x.tobytes())
            filled = _plain(pdf[_names(_PAGE)])
            filled["features"] = out
            yield filled

    return durable(asked.drop("edges").mapInPandas(fill, _FILLED))


_FILLED = _PAGE + ", features binary"


def fit(filled: DataFrame, rounds: int = 2, strength: float = 5.0) -> np.ndarray:
    """Parameters refitted to the most probable labels of all pages, ``rounds`` times.

    Tasks add up their own counts; the result has a fixed number of entries.
    """
    counts = prior_counts()
    for _ in range(rounds):
        parameters = log_parameters(counts)

        def tally(batches: Iterator[pd.DataFrame], parameters=parameters) -> Iterator[pd.DataFrame]:
            own = np.zeros(len(prior_counts()))
            for pdf in batches:
                pages = [_matrix(data) for data in pdf["features"] if len(data)]
                if not pages:
                    continue
                paths = viterbi(pages, parameters)
                x, path = np.concatenate(pages), np.concatenate(paths)
                before = np.concatenate([np.concatenate(([-1], y[:-1])) for y in paths])
                own[:_N_MOVES] += np.bincount(x[:, 0] * 20 + (before + 1) * 4 + path, minlength=_N_MOVES)
                at = _N_MOVES
                for k, n in enumerate(SIZES):
                    own[at : at + 4 * n] += np.bincount(path * n + x[:, k + 1], minlength=4 * n)
                    at += 4 * n
            yield pd.DataFrame({"at": np.arange(len(own)), "n": own})

        summed = filled.select("features").mapInPandas(tally, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
        counts = prior_counts() * strength
        counts[summed["at"].to_numpy()] += summed["n"].to_numpy()
    return counts


_HYPHEN_SIGNS = "-‐‑¬\xad"
_FIRST = re.compile(r"^\W*([^\W\d_]+)")
_TRIM = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”„‚‘’«»‹›…—–¡¿‐¬­•·"
_PIECES = re.compile(r"[^\s'’—–…“”\"«»]+")
_WORDS = re.compile(r"\w+(?:[-‐‑]\w+)*")
_PRINTED = re.compile(r"[^\W\d_]+(?:[-‐‑][^\W\d_]+)*")
_TO_HYPHEN = str.maketrans("‐‑", "--")


def words_of(line: str) -> list[str]:
    """Lower-case words as printed, misread signs inside them included. Words of two signs
    count if one of them is no letter, single signs don't."""
    out = []
    for raw in _PIECES.findall(line):
        w = raw.strip(_TRIM)
        if w.islower() and (len(w) > 2 or len(w) == 2 and not w.isalpha()):
            out.append(w)
    return out


def printed(line: str) -> list[str]:
    """Words of letters as printed in lower case, hyphens inside them included."""
    low = line.lower()
    if "‐" in low or "‑" in low:
        low = low.translate(_TO_HYPHEN)
    out = []
    for w in _WORDS.findall(low):
        if w.isalpha():
            out.append(w)
        else:
            out += _PRINTED.findall(w)
    return out


def half_word(line: str) -> tuple[str, str, int] | None:
    """First half of a word with a hyphen at the end of a line, the sign, where the half begins."""
    bare = line.rstrip()
    if not bare or bare[-1] not in _HYPHEN_SIGNS:
        return None
    begin = len(bare) - 1
    while begin and bare[begin - 1].isalpha():
        begin -= 1
    return (bare[begin:-1], bare[-1], begin) if begin < len(bare) - 1 else None


class TextLine(NamedTuple):
    """A line labelled as text: its index, whether it begins a paragraph, the part of it
    that holds whole words, a broken word's half and sign at its end, the second half in
    this page, the index of the line that has it, and whether it begins with a second half."""

    at: int
    starts: bool
    whole: str
    half: str | None
    mark: str | None
    rest: str | None
    next: int | None
    carried: bool


def text_lines(lines: list[tuple[int, int, str, bool]], path: np.ndarray) -> list[TextLine]:
    """The text lines of a page in order. A word goes on where a line begins with letters,
    not at a number taken for text."""
    text = [i for i, s in enumerate(path) if s in (_B, _K)]
    worded = [i for i in text if _FIRST.match(lines[i][2])]
    indents = [len(lines[i][2]) - len(lines[i][2].lstrip()) for i in text]
    usual = sorted(indents)[len(indents) // 4] if len(indents) > 1 else 0
    out, target, blank, own = [], -1, False, iter(worded)
    upcoming = next(own, None)
    for i, indent in zip(text, indents):
        while upcoming is not None and upcoming <= i:
            upcoming = next(own, None)
        line = lines[i][2]
        whole, carried = line, i == target
        half = mark = rest = following = None
        if carried:
            whole = _FIRST.sub("", whole, count=1)
        if path[i] == _B and (found := half_word(line)):
            half, mark, begin = found
            whole = whole[: max(0, len(whole) - (len(line) - begin))]
            if (following := upcoming) is not None:
                rest = _FIRST.match(lines[following][2]).group(1)
                target = following
        out.append(TextLine(i, bool(path[i] == _K or blank or indent > usual + 1), whole, half, mark, rest, following, carried))
        blank = lines[i][3] or path[i] == _K
    return out


_LABELLED = _PAGE + ", labels binary, first string, token string, hyphens array<struct<seq:int,half:string,mark:string,rest:string>>"


def label_pages(pages: DataFrame, max_learnt: int = MAX_LEARNT) -> DataFrame:
    """Pages with the label of each line that isn't blank, the words broken at line ends
    (``seq`` is the line's number from 1), and the first word of the page's text."""
    filled = with_usual(analyse(pages), max_learnt)
    counts = fit(filled)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parameters = log_parameters(counts)
        for pdf in batches:
            rows = []
            paths = viterbi([_matrix(data) for data in pdf["features"]], parameters)
            for row, lines, path in zip(pdf[_names(_PAGE)].itertuples(index=False), _lines(pdf), paths):
                first = token = None
                hyphens = []
                for x in text_lines(lines, path):
                    if first is None and (m := _FIRST.match(lines[x.at][2])):
                        first, token = m.group(1), _PRINTED.search(lines[x.at][2]).group().lower().translate(_TO_HYPHEN)
                    if x.half is not None:
                        hyphens.append((x.at + 1, x.half, x.mark, x.rest))
                rows.append((*row, path.astype(np.uint8).tobytes(), first, token, hyphens))
            out = pd.DataFrame(rows, columns=_names(_LABELLED))
            out["page_no"] = out["page_no"].astype("Int32")
            yield out

    return durable(filled.mapInPandas(label, _LABELLED))


def _path(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8)


def vocabulary(labelled: DataFrame) -> DataFrame:
    """(w, n, free, seen) of the words in text lines: how often a word, hyphens inside it
    included, is printed (``n``), how often not at a break (``free``), and how often as
    a lower-case word with whatever signs are in it (``seen``)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, cut, seen = Counter(), Counter(), Counter()

        def flush() -> pd.DataFrame:
            keys = list({**n, **seen})
            out = pd.DataFrame([(k, n[k], n[k] - cut[k], seen[k]) for k in keys], columns=["w", "n", "free", "seen"])
            for c in (n, cut, seen):
                c.clear()
            return out

        for pdf in batches:
            for lines, data in zip(_lines(pdf), pdf["labels"]):
                for x in text_lines(lines, _path(data)):
                    tokens = printed(lines[x.at][2].rstrip().rstrip(_HYPHEN_SIGNS))
                    n.update(tokens)
                    if tokens and (x.carried or x.half is not None):
                        ends = ({0} if x.carried else set()) | ({len(tokens) - 1} if x.half is not None else set())
                        cut.update(tokens[i] for i in ends)
                    seen.update(words_of(x.whole))
            if len(n) + len(seen) > 300_000:
                yield flush()
        yield flush()

    parts = labelled.select("page_header", "page_body", "page_footer", "labels").mapInPandas(count, "w string, n long, free long, seen long")
    return parts.groupBy("w").agg(F.sum("n").alias("n"), F.sum("free").alias("free"), F.sum("seen").alias("seen"))


def next_words(labelled: DataFrame) -> DataFrame:
    """(book_id, page_no, over): first word of the text of the next page of the book that has
    text, by number. Numbers are looked at in blocks, so that no book needs one task."""
    pages = labelled.where("first is not null and book_id is not null and page_no is not null").groupBy("book_id", "page_no").agg(F.min_by(F.struct("first", "token"), "page_id").alias("begin"))
    pages = pages.withColumn("block", F.floor(F.col("page_no") / BLOCK))
    heads = pages.groupBy("book_id", "block").agg(F.min_by("begin", "page_no").alias("head"))
    heads = heads.select("book_id", "block", F.lead("head").over(Window.partitionBy("book_id").orderBy("block")).alias("beyond"))
    inside = pages.select("book_id", "block", "page_no", F.lead("begin").over(Window.partitionBy("book_id", "block").orderBy("page_no")).alias("over"))
    return inside.join(heads, ["book_id", "block"]).select("book_id", "page_no", F.coalesce("over", "beyond").alias("over"))


def broken_words(labelled: DataFrame, words: DataFrame) -> DataFrame:
    """(page_id, seq, half, mark, rest, broken): words with a hyphen at a line's end.

    The second half comes from the next line or, at the end of a page, from the next
    page of the book that has text. ``broken`` is false for a compound: a word that the
    collection prints with its hyphen within lines more often than without. Where none
    follows (end of the book, page without number) ``rest`` is null and the half alone decides: it is broken at a soft hyphen or not
    sign, or if the collection prints it nowhere as a whole word. ``words`` is that of ``vocabulary``.
    """
    ends = labelled.select("page_id", "book_id", "page_no", F.inline("hyphens")).join(next_words(labelled), ["book_id", "page_no"], "left")
    # second halves on a next page are no whole words either
    second = ends.where("rest is null and over.first is not null").groupBy(F.col("over.token").alias("w")).agg(F.count(F.lit(1)).alias("taken"))
    ends = ends.select("page_id", "seq", "half", "mark", F.coalesce("rest", "over.first").alias("rest"))
    # without a second half the half itself is looked up
    ends = ends.withColumn("joined", F.lower(F.concat("half", F.coalesce("rest", F.lit(""))))).withColumn("compound", F.lower(F.concat("half", F.lit("-"), "rest")))
    printed = words.join(second, "w", "left").select("w", "n", (F.col("free") - F.coalesce("taken", F.lit(0))).alias("free"))
    return (
        ends.join(printed.select(F.col("w").alias("joined"), F.col("n").alias("whole"), "free"), "joined", "left")
        .join(words.select(F.col("w").alias("compound"), F.col("n").alias("parted")), "compound", "left")
        .select(
            "page_id",
            "seq",
            "half",
            "mark",
            "rest",
            (
                F.col("mark").isin("¬", "­")
                | F.when(F.col("rest").isNull(), F.coalesce("free", F.lit(0)) <= 0).otherwise(F.coalesce("parted", F.lit(0)) <= F.coalesce("whole", F.lit(0)))
            ).alias("broken"),
        )
    )


#: A misread spelling is at least so many times rarer than the right one, and a glyph
#: confusion is believed when so many different words show it.
RARER, SUPPORT = 12, 3
#: Misprints of a word over those that the rate in other words lets expect.
EXCESS = 10


def misreadings(words: DataFrame) -> DataFrame:
    """(word, meant, at) of the misread spellings in a table (word, n) of different words:
    the correction, and the place of the wrong glyph.

    Pairs differ by one glyph for one, one for two, two for one, or by a sign that is no
    letter. Inside a word a sign that is no letter is wrong if the pair is more frequent.
    Other confusions count if the word is ``RARER`` times rarer than its pair and not far
    more frequent than the rate of the confusion in other words lets expect, so "this" is
    no misread "the", nor "n°" a "no"; those of letters, if ``SUPPORT`` different words
    show them. A glyph that only gained or lost a letter (plurals) is none.
    """
    _PATTERNS = "pattern string, word string, n long, at int, glyph string, right boolean"

    def patterns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for w, n in zip(pdf["word"], pdf["n"]):
                # what is right has letters only, and is printed more than once
                right = n > 1 and _LETTERS.fullmatch(w) is not None
                for i in range(len(w)):
                    rows.append((f"{w[:i]}\0{w[i + 1 :]}", w, n, i, w[i], right))
                    if i + 1 < len(w):
                        rows.append((f"{w[:i]}\0{w[i + 2 :]}", w, n, i, w[i : i + 2], right))
                    if not w[i].isalpha():
                        rows.append((f"{w[:i]}{w[i + 1 :]}", w, n, i, w[i], right))
                rows.append((w, w, n, 0, "", right))
            yield pd.DataFrame(rows, columns=_names(_PATTERNS))

    table = durable(words.select("word", "n").mapInPandas(patterns, _PATTERNS))
    wrong = table.where("glyph <> ''").select("pattern", F.col("word").alias("bad"), F.col("n").alias("few"), F.col("glyph").alias("printed"), F.col("at").alias("place"))
    right = table.where("right").select("pattern", "word", "n", "glyph")
    odd = F.col("printed").rlike(r"[^\p{L}\p{M}-]")
    # a sign at an end may belong there ("n°")
    inside = odd & (F.col("place") > 0) & (F.col("place") < F.length("bad") - 1)
    pairs = (
        wrong.join(right, "pattern")
        .where(F.when(inside, F.col("n") > F.col("few")).otherwise(F.col("n") >= RARER * F.col("few")))
        .where("bad <> word and (length(printed) < 2 or length(glyph) < 2)")
        .where("glyph <> '' or not rlike(printed, '\\\\p{L}')")
        .where(odd | ~(F.contains("printed", "glyph") | F.contains("glyph", "printed")))
    )
    pairs = durable(pairs)
    exposed = right.where("glyph <> ''").groupBy("glyph").agg(F.sum("n").alias("exposed"))
    support = pairs.groupBy("printed", "glyph").agg(F.countDistinct("bad").alias("seen"), F.sum("few").alias("all"))
    others = (F.col("all") - F.col("few")) / F.greatest(F.col("exposed") - F.col("n"), F.lit(1))
    believed = (
        pairs.join(support, ["printed", "glyph"])
        .join(exposed, "glyph", "left")
        .where(inside | ((odd | (F.col("seen") >= SUPPORT)) & (F.col("few") <= EXCESS * (1 + others * F.col("n")))))
    )
    return believed.groupBy(F.col("bad").alias("word")).agg(F.max_by(F.struct(F.col("word").alias("meant"), F.col("place").alias("at")), F.struct("n", "word")).alias("b")).select("word", "b.meant", "b.at")


_LETTERS = re.compile(r"(?:[^\W\d_]|[\u0300-\u036f\u0900-\u0dff-])+")
_DECIDED = "seq int, half string, rest string, broken boolean"


def repair(pages: DataFrame, max_learnt: int = MAX_LEARNT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(labelled, broken, misread): pages with labels; broken words; (word, meant, at) of
    every misread spelling."""
    labelled = label_pages(pages, max_learnt)
    words = durable(vocabulary(labelled))
    broken = durable(broken_words(labelled, words))
    joined = broken.where("broken and rest is not null").select(F.concat("half", "rest").alias("w")).where("w = lower(w) and length(w) > 2")
    every = words.where("seen > 0").select("w", "seen").unionByName(joined.select("w", F.lit(1).cast("long").alias("seen")))
    misread = durable(misreadings(every.groupBy(F.col("w").alias("word")).agg(F.sum("seen").alias("n"))))
    return labelled, broken, misread


def _decided(labelled: DataFrame, broken: DataFrame, misread: DataFrame, max_learnt: int) -> tuple[DataFrame, object]:
    """Labelled pages with their broken words, and with the misread spellings that they hold
    where these are too many to be sent to all tasks (else sent, in the second result)."""
    per = broken.groupBy("page_id").agg(F.collect_list(F.struct("seq", "half", "rest", "broken")).alias("decided"))
    pages = labelled.select(*_names(_PAGE), "labels").join(per, "page_id", "left")
    rows = misread.limit(max_learnt + 1).collect()
    if len(rows) <= max_learnt:
        sent = labelled.sparkSession.sparkContext.broadcast({r["word"]: (r["meant"], r["at"]) for r in rows})
        return pages.withColumn("own", F.lit(None).cast("array<struct<word:string,meant:string,at:int>>")), sent

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for page, lines, data in zip(pdf["page_id"], _lines(pdf), pdf["labels"]):
                rows += [(page, w) for w in {w for x in text_lines(lines, _path(data)) for w in words_of(x.whole)}]
            yield pd.DataFrame(rows, columns=["page_id", "word"])

    on_page = labelled.select("page_id", "page_header", "page_body", "page_footer", "labels").mapInPandas(words, "page_id long, word string")
    over = broken.where("broken and rest is not null").select("page_id", F.concat("half", "rest").alias("word"))
    held = on_page.unionByName(over).distinct().join(misread, "word").groupBy("page_id").agg(F.collect_list(F.struct("word", "meant", "at")).alias("own"))
    return pages.join(held, "page_id", "left"), None


def _wrong(own, sent) -> dict[str, tuple[str, int]]:
    return sent.value if sent is not None else {r["word"]: (r["meant"], r["at"]) for r in own} if own is not None else {}


_FINDING = "page_id long, line_no int, kind string"


def findings(pages: DataFrame, max_learnt: int = MAX_LEARNT) -> DataFrame:
    """(page_id, line_no, kind): hyphen, furniture and glyph lines of the body, and stray
    lines of header and footer. Null and blank fields have no lines."""
    decided, sent = _decided(*repair(pages, max_learnt), max_learnt)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for page, lines, data, decisions, own in zip(pdf["page_id"], _lines(pdf), pdf["labels"], pdf["decided"], pdf["own"]):
                path, wrong = _path(data), _wrong(own, sent)
                broken = {d["seq"] - 1: d for d in decisions if d["broken"]} if decisions is not None else {}
                kinds: list[tuple[int, str]] = []
                for i, (zone, *_) in enumerate(lines):
                    text = path[i] in (_B, _K)
                    if text != (zone == 1):
                        kinds.append((i, ("stray_header", "furniture", "stray_footer")[zone]))
                for x in text_lines(lines, path):
                    if any(w in wrong for w in words_of(x.whole)):
                        kinds.append((x.at, "glyph"))
                    if d := broken.get(x.at):
                        kinds.append((x.at, "hyphen"))
                        found = wrong.get(d["half"] + d["rest"]) if d["rest"] is not None else None
                        # the wrong glyph may stand in the second half, on the line that has it
                        at = x.at if found and found[1] < len(d["half"]) else x.next if found else None
                        if at is not None:
                            kinds.append((at, "glyph"))
                for i, kind in dict.fromkeys(kinds):
                    if kind.startswith("stray") or lines[i][0] == 1:
                        rows.append((page, lines[i][1], kind))
            yield pd.DataFrame(rows, columns=_names(_FINDING))

    return decided.mapInPandas(find, _FINDING)


_FRAGMENT = "page_id long, book_id string, page_no int, first_line int, starts boolean, lines int, text string"


def fragments(pages: DataFrame, max_learnt: int = MAX_LEARNT) -> DataFrame:
    """Paragraphs, or parts of them, of each page: broken words rejoined, misread words put
    right, furniture left out. A part that ends with a broken word ends with its half."""
    decided, sent = _decided(*repair(pages, max_learnt), max_learnt)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for page, book, no, lines, data, decisions, own in zip(pdf["page_id"], pdf["book_id"], pdf["page_no"], _lines(pdf), pdf["labels"], pdf["decided"], pdf["own"]):
                wrong = _wrong(own, sent)
                by_line = {d["seq"] - 1: d for d in decisions} if decisions is not None else {}

                def right(m: re.Match, wrong=wrong) -> str:
                    core = m.group().strip(_TRIM)
                    return m.group().replace(core, wrong[core][0], 1) if core in wrong else m.group()

                parts: list[list] = []
                for x in text_lines(lines, _path(data)):
                    line = lines[x.at][2].strip()
                    d = by_line.get(x.at)
                    if d is not None and d["broken"]:
                        line = line[:-1] + ("" if d["rest"] is not None else " ")
                    elif d is None:
                        line += " "
                    if x.starts or not parts:
                        parts.append([x.at + 1, x.starts, 0, ""])
                    parts[-1][2] += 1
                    parts[-1][3] += line
                for first, starts, n, text in parts:
                    rows.append((page, book, no, first, starts, n, _PIECES.sub(right, text)))
            out = pd.DataFrame(rows, columns=_names(_FRAGMENT))
            out["page_no"] = out["page_no"].astype("Int32")
            yield out

    return decided.mapInPandas(build, _FRAGMENT)


def paragraphs(pages: DataFrame, max_learnt: int = MAX_LEARNT) -> DataFrame:
    """(book_id, page_id, first_line, lines, text, copy_of): continuous paragraphs under the
    page on which they begin.

    A paragraph runs on over the page's end unless the next page begins one. Of a page
    that was delivered more than once (same book and number) the delivery with the least
    id is read; the others give one row each without text, ``copy_of`` that id. A page
    without book or number is a text of its own.
    """
    parts = durable(fragments(pages, max_learnt))
    ids = parts.select("page_id", "book_id", "page_no").distinct()
    numbered = ids.where("book_id is not null and page_no is not null")
    kept = numbered.groupBy("book_id", "page_no").agg(F.min("page_id").alias("copy_of"))
    copies = numbered.join(kept, ["book_id", "page_no"]).where("page_id <> copy_of").select("page_id", "copy_of")
    parts = parts.join(copies.select("page_id"), "page_id", "left_anti")
    alone = parts.where("book_id is null or page_no is null").select("book_id", "page_id", "first_line", "lines", "text", F.lit(None).cast("long").alias("copy_of"))
    # whether the text of a page goes on from an earlier one is settled between pages, in blocks of numbers
    place = F.struct("page_no", "page_id", "first_line")
    named = parts.where("book_id is not null and page_no is not null")
    begin = named.groupBy("book_id").agg(F.min(place).alias("begin"))
    named = named.join(begin, "book_id").withColumn("starts", F.col("starts") | (place == F.col("begin"))).drop("begin")
    last = named.where("starts").groupBy("book_id", "page_no").agg(F.max(place).alias("last"))
    heads = named.where("not starts").select("book_id", "page_no")
    both = heads.join(last, ["book_id", "page_no"], "full").withColumn("block", F.floor(F.col("page_no") / BLOCK))
    before = Window.partitionBy("book_id", "block").orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("book_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = both.groupBy("book_id", "block").agg(F.max("last").alias("top"))
    blocks = blocks.select("book_id", "block", F.max("top").over(earlier).alias("carry"))
    owners = both.withColumn("own", F.max("last").over(before)).join(blocks, ["book_id", "block"]).select("book_id", "page_no", F.coalesce("own", "carry").alias("owner"))
    owned = named.join(owners, ["book_id", "page_no"]).withColumn("owner", F.when(F.col("starts"), place).otherwise(F.col("owner")))
    built = owned.groupBy("book_id", "owner").agg(F.array_sort(F.collect_list(F.struct("page_no", "page_id", "first_line", "lines", "text"))).alias("parts"))
    whole = built.select(
        "book_id",
        F.col("owner.page_id").alias("page_id"),
        F.col("owner.first_line").alias("first_line"),
        F.aggregate("parts", F.lit(0), lambda acc, x: acc + x["lines"]).alias("lines"),
        F.trim(F.array_join(F.col("parts.text"), "")).alias("text"),
        F.lit(None).cast("long").alias("copy_of"),
    )
    again = ids.join(copies, "page_id").select("book_id", "page_id", F.lit(None).cast("int").alias("first_line"), F.lit(0).alias("lines"), F.lit(None).cast("string").alias("text"), "copy_of")
    return whole.unionByName(alone.withColumn("text", F.trim("text"))).unionByName(again)
