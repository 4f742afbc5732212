"""Splitting oversized texts at natural boundaries by agglomerative merging."""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Boundaries, strongest first. A text is opened only as deep as the limit asks:
# every weaker boundary inside a segment that fits would be merged anyway,
# because the weakest boundaries merge first.
_LEVELS: list[tuple[int, re.Pattern[str]]] = [
    (5, re.compile(r"(?:\r\n|\r|\n)[^\S\r\n]*(?:(?:\r\n|\r|\n)[^\S\r\n]*)+")),
    (4, re.compile(r"(?:[.!?…]+[\"'”’»)\]]*\s+|[。！？｡।]+[」』”’)]*\s*)")),
    (3, re.compile(r"(?:\r\n|\r|\n)")),
    (2, re.compile(r"(?:[,;:—–]\s+|[，、；：])")),
    (1, re.compile(r"\s+")),
]


def utf8_len(text: str) -> int:
    return len(text.encode("utf-8", "surrogatepass"))


def _cut_hard(text: str, at: int, size: Callable[[str], int], cap: int) -> Iterator[tuple[int, int]]:
    """Runs of signs without any boundary: as many code points as fit, at least one."""
    start = 0
    while start < len(text):
        low, high = 1, min(len(text) - start, max(1, cap))
        while low < high:
            middle = (low + high + 1) // 2
            if size(text[start : start + middle]) <= cap:
                low = middle
            else:
                high = middle - 1
        yield at + start, at + start + low
        start += low


def atoms(text: str, cap: int, size: Callable[[str], int] = utf8_len) -> list[tuple[int, int, int, int]]:
    """Segments (start, end, size, strength of the boundary after it), all within cap."""
    out: list[tuple[int, int, int, int]] = []

    def open_(start: int, end: int, level: int, strength: int) -> None:
        piece = text[start:end]
        n = size(piece)
        if n <= cap:
            out.append((start, end, n, strength))
            return
        if level == len(_LEVELS):
            spans = list(_cut_hard(piece, start, size, cap))
            for i, (a, b) in enumerate(spans):
                out.append((a, b, size(text[a:b]), strength if i == len(spans) - 1 else 0))
            return
        own, pattern = _LEVELS[level]
        ends = [start + m.end() for m in pattern.finditer(piece)]
        if not ends or ends[-1] != end:
            ends.append(end)
        before = start
        for i, e in enumerate(ends):
            open_(before, e, level + 1, strength if i == len(ends) - 1 else own)
            before = e

    if text:
        open_(0, len(text), 0, 6)
    return out


def merge(segments: list[tuple[int, int, int, int]], cap: int) -> list[tuple[int, int, int, int]]:
    """Merge neighbours over the weakest boundary first while both together fit."""
    n = len(segments)
    start = [s[0] for s in segments]
    end = [s[1] for s in segments]
    size = [s[2] for s in segments]
    after = [s[3] for s in segments]
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    alive = [True] * n
    version = [0] * n
    heap = [(after[i], size[i] + size[i + 1], i, 0, 0) for i in range(n - 1) if size[i] + size[i + 1] <= cap]
    heapq.heapify(heap)
    while heap:
        _, _, i, mine, other = heapq.heappop(heap)
        j = right[i] if alive[i] else n
        if j >= n or version[i] != mine or version[j] != other:
            continue
        end[i], size[i], after[i], right[i] = end[j], size[i] + size[j], after[j], right[j]
        alive[j] = False
        version[i] += 1
        if right[i] < n:
            left[right[i]] = i
        for a, b in ((left[i], i), (i, right[i])):
            if a >= 0 and b < n and size[a] + size[b] <= cap:
                heapq.heappush(heap, (after[a], size[a] + size[b], a, version[a], version[b]))
    return [(start[i], end[i], size[i], after[i]) for i in range(n) if alive[i]]


def split_text(
    text: str, limit: int, overlap: int, size: Callable[[str], int] = utf8_len
) -> list[tuple[int, int, int, int]]:
    """Pieces (first content char, start incl. overlap, end, strength after) as 0-based offsets.

    Content and overlap together never exceed the limit. The overlap is the longest
    run of whole code points before the content whose size is at most ``overlap``; a
    negative one is none. Where limit and overlap leave no room for some code point of the
    text nothing can be cut: that is a ValueError.
    """
    overlap = max(0, overlap)
    cap = limit - overlap
    if cap < 1:
        raise ValueError(f"an overlap of {overlap} leaves no room within {limit}")
    segments = atoms(text, cap, size)
    if any(n > cap for _, _, n, _ in segments):
        raise ValueError(f"{limit} with an overlap of {overlap} leaves no room for one character")
    out = []
    for first, end, _, strength in merge(segments, cap):
        begin = first
        if first and overlap:
            low, high = max(0, first - overlap), first
            while low < high:  # the smallest begin whose overlap fits
                middle = (low + high) // 2
                if size(text[middle:first]) <= overlap:
                    high = middle
                else:
                    low = middle + 1
            begin = low
        out.append((first, begin, end, strength))
    return out


_PIECES = (
    "doc_id long, source string, piece_no int, n_pieces int, start_char int, content_char int, "
    "end_char int, n_tokens int, boundary int, piece string, error string"
)


def limits_of(limits: DataFrame) -> DataFrame:
    """One limit per source: the smallest where a source is listed twice."""
    return (
        limits.where("max_tokens is not null")
        .groupBy(F.col("source").alias("_source"))
        .agg(
            F.min("max_tokens").cast("int").alias("_max"),
            F.min(F.coalesce("overlap_tokens", F.lit(0))).cast("int").alias("_overlap"),
        )
    )


def with_limit(docs: DataFrame, limits: DataFrame) -> DataFrame:
    """documents with the ``_max`` and ``_overlap`` that apply; without any row for the
    source and without a ``default`` row both are null and the text is never cut."""
    own = limits_of(limits)
    default = own.where("_source = 'default'").select(
        F.col("_max").alias("_dmax"), F.col("_overlap").alias("_doverlap")
    )
    return (
        docs.select("doc_id", "source", "text")
        .join(own.where("_source <> 'default'"), F.col("source") == F.col("_source"), "left")
        .join(F.broadcast(default), how="left")  # at most one row
        .select(
            "doc_id",
            "source",
            "text",
            F.coalesce("_max", "_dmax").alias("_max"),
            F.when(F.col("_max").isNotNull(), F.col("_overlap")).otherwise(F.col("_doverlap")).alias("_overlap"),
        )
    )


def split_oversized(
    docs: DataFrame, limits: DataFrame, size: Callable[[str], int] | None = None
) -> DataFrame:
    """Pieces of every document whose size exceeds the limit of its source.

    Offsets are code points from 1; ``start_char`` counts the overlap in,
    ``content_char`` is the first character that is new. The new parts of all
    pieces, concatenated, give the text back. Null and empty texts and texts
    within the limit give no row. A document whose limit and overlap leave no room for a
    character gives one row with ``piece_no`` 0 that says so in ``error``. ``size`` counts tokens, by default UTF-8 bytes
    (ByT5); any other count must not exceed the sum over parts.
    """
    measured = size or utf8_len
    sized = with_limit(docs, limits).where("text is not null and _max is not null")
    if size is None:  # cheap test in the JVM before anything reaches Python
        sized = sized.where(F.octet_length("text") > F.col("_max"))

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, source, text, limit, overlap in zip(
                pdf["doc_id"], pdf["source"], pdf["text"], pdf["_max"], pdf["_overlap"]
            ):
                if size is not None and measured(text) <= limit:
                    continue
                try:
                    cuts = split_text(text, int(limit), int(overlap), measured)
                except ValueError as e:
                    rows.append((doc, source, 0, 0, None, None, None, measured(text), None, None, str(e)))
                    continue
                for i, (first, begin, end, strength) in enumerate(cuts):
                    part = text[begin:end]
                    rows.append((doc, source, i + 1, len(cuts), begin + 1, first + 1, end, measured(part), strength, part, None))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in _PIECES.split(", ")])
            yield out.astype({c: "Int32" for c in ("start_char", "content_char", "end_char", "boundary")})

    return sized.mapInPandas(pieces, _PIECES)
