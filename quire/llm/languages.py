"""Language of pages and of their stretches: multilingual mixture inference.

A page is a mixture of languages. Every word has a likelihood under every
language's character n-gram model; expectation-maximisation estimates the page's
proportions, a penalised likelihood selects its set of languages, and a Viterbi
pass over the selected languages parts the text into stretches.

The n-gram models are fitted to a bounded sample of the pages: first by their
(unreliable) labels, then again by the languages inferred for every word. A model is
an array of fixed size, so what is sent to the workers doesn't grow with the data.
Every page is then read whole, once. Texts are scored many at a time.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.runtime import balanced, durable

LANGUAGES: tuple[str, ...] = ("en", "fr", "de", "es", "it", "ru", "zh", "ja", "th", "hi")

# How labels spell the languages.
SPELLINGS = {
    "en": "en eng english anglais englisch",
    "fr": "fr fre fra french français francais französisch",
    "de": "de ger deu german deutsch allemand",
    "es": "es spa esp spanish español espanol castellano",
    "it": "it ita italian italiano",
    "ru": "ru rus russian русский",
    "zh": "zh chi zho cmn chinese mandarin 中文 汉语 漢語",
    "ja": "ja jpn jp japanese 日本語",
    "th": "th tha thai ไทย ภาษาไทย",
    "hi": "hi hin hindi हिन्दी हिंदी",
}
_BY_SPELLING = {s: lang for lang, spellings in SPELLINGS.items() for s in spellings.split()}

# Frequent words, which start the models where labels are missing.
COMMON_WORDS = {
    "en": "the of and to in that was his her with for had not but which they from were this have",
    "fr": "le la les de des et du un une dans que qui pour sur pas avec son ses ce cette notre mais car",
    "de": "der die das und ein eine den dem des im in zu mit von auf nicht war aber denn hinter vor",
    "es": "el la los las de y un una en que por con del al no su pero para como desde hasta sobre",
    "it": "il lo la gli le di e un una in che per con del della non suo sua ma nel sul come fino",
    "ru": "и в не на что он она с как его но за под после когда пока вот уже",
    "zh": "的 了 在 是 他 她 我 不 这 那 着 把 和 里 上 到",
    "ja": "は が を に の で と た し て い る から です ます",
    "th": "และ ที่ ใน ของ เป็น ไม่ ให้ มา ได้ แต่ เพราะ",
    "hi": "और के में की ने को से का है पर यह वह एक था",
}

BUCKETS = 1 << 15
ORDERS = (1, 2, 3, 4)
_MIXERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)
#: Nats that a change of language costs, and that a further language of a page must gain.
SWITCH, PENALTY = 7.0, 6.0
#: Words (or, at 2.5 to a word, characters of scripts without spaces) of a stretch that counts.
MIN_WORDS, CHARS_PER_WORD = 8, 2.5
_LETTER, _SOLO = 1, 2


def label_language(label: str | None) -> str | None:
    """Two-letter code that a label names, in any spelling and with any region; else None."""
    if not label:
        return None
    bare = label.strip().casefold().replace("_", "-")
    return _BY_SPELLING.get(bare) or _BY_SPELLING.get(bare.split("-")[0].strip())


@lru_cache(1)
def _classes() -> np.ndarray:
    """Per code point: 0 no letter, 1 letter or mark, 2 letter of a script without spaces."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x32000):
        if unicodedata.category(chr(c))[0] in "LM":
            out[c] = _LETTER
    for a, b in ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3134F)):
        out[a : b + 1] = np.where(out[a : b + 1] > 0, _SOLO, 0)
    out[0x3005] = _SOLO
    return out


class Units:
    """Words of some texts (single characters in scripts without spaces) and their n-gram buckets.

    All texts are taken at once; ``owner`` bounds the units of each text.
    """

    def __init__(self, *texts: str):
        low = "\n".join(texts)
        size = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        begin = np.concatenate(([0], np.cumsum(size)))
        lowered = low.lower()
        if len(lowered) != len(low):  # some capitals lower to two code points
            lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in low)
        codes = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = _classes()[codes]
        letter = kind > 0
        at = np.flatnonzero(letter)
        # a unit begins at a letter after no letter, and at every solo letter and mark of its kind
        fresh = letter & (np.concatenate(([True], ~letter[:-1])) | (kind == _SOLO) | np.concatenate(([False], kind[:-1] == _SOLO)))
        n = len(codes)
        padded = np.full(n + 3, 32, dtype=np.uint64)
        padded[3:][letter] = codes[letter]
        inside = np.concatenate((np.zeros(3, dtype=bool), letter))
        parts = [padded[at + 3 - j] for j in range(max(ORDERS))]
        within = [inside[at + 3 - j] for j in range(max(ORDERS))]
        self.grams = []
        for k in ORDERS:
            h = np.full(len(at), _MIXERS[k - 1], dtype=np.uint64)
            ok = np.ones(len(at), dtype=bool)
            for j in range(k):
                h ^= parts[j]
                h *= _MIXERS[(k + j) % 4]
                h ^= h >> np.uint64(31)
                if 0 < j < k - 1:  # a space may only stand in front
                    ok &= within[j]
            g = (h >> np.uint64(49)).astype(np.int64)
            g[~ok] = BUCKETS  # no gram: a bucket of its own
            self.grams.append(g)
        self.starts = np.flatnonzero(fresh[at])
        ends = np.concatenate((self.starts[1:], [len(at)])).astype(np.int64) if len(at) else np.zeros(0, dtype=np.int64)
        self.first = at[self.starts]
        self.last = at[ends - 1] + 1 if len(at) else np.zeros(0, dtype=np.int64)
        self.weight = np.where(kind[self.first] == _SOLO, round(10 / CHARS_PER_WORD), 10) if len(at) else np.zeros(0, dtype=np.int64)  # in tenths of a word
        self.unit_of = np.repeat(np.arange(len(self.starts)), ends - self.starts)
        self.begin = begin[:-1]
        self.owner = np.searchsorted(self.first, begin)

    def __len__(self) -> int:
        return len(self.starts)

    def scores(self, model: np.ndarray) -> np.ndarray:
        """Log-likelihood of every unit under every language: geometric mean over the orders."""
        if not len(self):
            return np.zeros((0, model.shape[2]), dtype=np.float32)
        total = np.take(model[0], self.grams[0], axis=0)
        for k in range(1, len(ORDERS)):
            total += np.take(model[k], self.grams[k], axis=0)
        return np.add.reduceat(total, self.starts, axis=0) / len(ORDERS)

    def count(self, language: np.ndarray, counts: np.ndarray) -> None:
        """Add the n-grams of every unit to its language's counts (-1: to none)."""
        own = language[self.unit_of]
        width = counts.shape[2]
        for k, g in enumerate(self.grams):
            ok = (g < BUCKETS) & (own >= 0)
            counts[k] += np.bincount(g[ok] * width + own[ok], minlength=BUCKETS * width).reshape(BUCKETS, width)


#: Characters that are scored at once; a longer text is scored alone.
CHUNK = 1 << 17


def chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(index of the first text, texts) of at most ``CHUNK`` characters in all, or one longer text."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > CHUNK:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if texts:
        yield begin, texts[begin:]


def _seed_counts(languages: tuple[str, ...]) -> np.ndarray:
    counts = np.zeros((len(ORDERS), BUCKETS, len(languages)))
    for i, lang in enumerate(languages):
        units = Units(COMMON_WORDS.get(lang, ""))
        units.count(np.full(len(units), i), counts)
    return counts


def _log_model(counts: np.ndarray) -> np.ndarray:
    """Log-probabilities; the last bucket is that of no gram and says nothing."""
    smooth = 0.05
    model = np.log((counts + smooth) / (counts.sum(axis=1, keepdims=True) + smooth * BUCKETS))
    return np.concatenate((model, np.zeros((len(ORDERS), 1, counts.shape[2]))), axis=1).astype(np.float32)


#: EM has converged when no other proportions could gain more nats than that.
CONVERGED = 0.01


def mixture(scores: np.ndarray, allowed: list[int], worth: float = -np.inf) -> tuple[np.ndarray, float]:
    """Proportions of the allowed languages by EM, and the log-likelihood.

    The likelihood is concave in the proportions, so the steepest direction bounds what
    is still to gain: EM goes on until that is below ``CONVERGED``, or until the bound
    shows that ``worth`` cannot be reached.
    """
    own = scores[:, allowed].astype(np.float64)
    top = own.max(axis=1, keepdims=True)
    like = np.exp(own - top)
    base = float(top.sum())
    share = np.full(len(allowed), 1 / len(allowed))
    while True:
        whole = like @ share
        reached = float(np.log(whole).sum()) + base
        slope = (like / whole[:, None]).mean(axis=0)
        more = len(own) * (slope.max() - 1)
        if more <= CONVERGED or reached + more <= worth:
            return share, reached
        share = share * slope


def _needed(n: np.ndarray | int) -> np.ndarray:
    """Nats that a further language of a text of n units must gain."""
    return PENALTY + 0.5 * np.log(n)


def select_languages(scores: np.ndarray, chosen: list[int], best: float) -> list[int]:
    """Languages of a text beyond those chosen: added one by one, the one of the largest
    likelihood first, while the penalised likelihood grows. Every language whose bound
    of gain passes the penalty is tried."""
    chosen = list(chosen)
    need = float(_needed(len(scores)))
    while len(chosen) < scores.shape[1]:
        # what a further language could gain at most, without the cost of mixing
        gain = np.maximum(scores - scores[:, chosen].max(axis=1, keepdims=True), 0).sum(axis=0)
        gain[chosen] = -1
        found = None
        for lang in np.argsort(-gain):
            if gain[lang] <= need:
                break
            _, like = mixture(scores, [*chosen, int(lang)], worth=best + need)
            if like - best > need and (found is None or like > found[0]):
                found = like, int(lang)
        if found is None:
            break
        best = found[0]
        chosen.append(found[1])
    return chosen


def _second(scores: np.ndarray, owner: np.ndarray, main: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Gain in log-likelihood of a second language beside the main one, by EM, for all
    (text, language) pairs of a chunk at once; what cannot pass the penalty is given up."""
    text, lang = pairs[:, 0], pairs[:, 1]
    n = owner[text + 1] - owner[text]
    need = _needed(n)
    cuts = np.concatenate(([0], np.cumsum(n)))
    unit = np.repeat(owner[text] - cuts[:-1], n) + np.arange(cuts[-1])
    ratio = np.exp(np.minimum(scores[unit, np.repeat(lang, n)].astype(np.float64) - scores[unit, np.repeat(main[text], n)], 300.0))
    share = np.full(len(pairs), 0.5)
    out = np.zeros(len(pairs))
    left = np.arange(len(pairs))
    while len(left):
        whole = 1 + np.repeat(share, n) * (ratio - 1)
        gain = np.add.reduceat(np.log(whole), cuts[:-1])
        slope = np.add.reduceat(ratio / whole, cuts[:-1]) / n
        other = (1 - share * slope) / np.maximum(1 - share, 1e-300)
        more = n * (np.maximum(slope, other) - 1)
        over = (more <= CONVERGED) | (gain + more <= need)
        out[left[over]] = gain[over]
        keep = ~over
        share = (share * slope)[keep]
        ratio = ratio[np.repeat(keep, n)]
        left, n, need = left[keep], n[keep], need[keep]
        cuts = np.concatenate(([0], np.cumsum(n)))
    return out


def languages_of(scores: np.ndarray, owner: np.ndarray) -> list[list[int]]:
    """Chosen languages of every text of a chunk (none for a text without units)."""
    filled = np.flatnonzero(owner[1:] > owner[:-1])
    out: list[list[int]] = [[] for _ in range(len(owner) - 1)]
    if not len(filled):
        return out
    at = owner[filled]
    sums = np.add.reduceat(scores, at, axis=0)
    first = sums.argmax(axis=1)
    main = np.zeros(len(out), dtype=np.int64)
    main[filled] = first
    n = owner[filled + 1] - at
    mine = scores[np.arange(len(scores)), np.repeat(first, n)]
    gain = np.add.reduceat(np.maximum(scores - mine[:, None], 0), at, axis=0)
    gain[np.arange(len(filled)), first] = -1
    rows, langs = np.nonzero(gain > _needed(n)[:, None])
    for t, lang in zip(filled, first):
        out[t] = [int(lang)]
    if not len(rows):
        return out
    gained = _second(scores, owner, main, np.stack((filled[rows], langs), axis=1))
    passed = gained > _needed(n[rows])
    best: dict[int, tuple[float, int]] = {}
    for r, lang, g in zip(rows[passed], langs[passed], gained[passed]):
        best[r] = max(best.get(r, (0.0, 0)), (float(g), int(lang)))
    for r, (g, lang) in best.items():
        t = filled[r]
        own = scores[owner[t] : owner[t + 1]]
        out[t] = select_languages(own, [int(first[r]), lang], float(sums[r, first[r]]) + g)
    return out


def decode(scores: np.ndarray, chosen: list[int]) -> np.ndarray:
    """Language of every unit: Viterbi with a cost for each change of language."""
    if len(chosen) == 1:
        return np.full(len(scores), chosen[0])
    own = scores[:, chosen].tolist()
    value = own[0]
    width = range(len(chosen))
    back = []
    for row in own[1:]:
        high = max(value)
        top = value.index(high)
        high -= SWITCH
        back.append([i if value[i] >= high else top for i in width])
        value = [(v if v >= high else high) + x for v, x in zip(value, row)]
    at = value.index(max(value))
    path = [at]
    for b in reversed(back):
        at = b[at]
        path.append(at)
    return np.asarray(chosen)[path[::-1]]


def _proportions(scores: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Proportions of all languages in every text of a chunk, by EM until no text moves by
    more than a thousandth; a text that stands still is left out of further rounds."""
    width = scores.shape[1]
    out = np.full((len(owner) - 1, width), 1 / width)
    left = np.flatnonzero(owner[1:] > owner[:-1])
    like = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
    n = owner[left + 1] - owner[left]
    while len(left):
        share = out[left]
        joint = like * np.repeat(share, n, axis=0)
        joint /= joint.sum(axis=1, keepdims=True)
        cuts = np.concatenate(([0], np.cumsum(n)))
        new = np.add.reduceat(joint, cuts[:-1], axis=0) / n[:, None]
        out[left] = new
        keep = np.abs(new - share).max(axis=1) > 1e-3
        like = like[np.repeat(keep, n)]
        left, n = left[keep], n[keep]
    return out


def paths(texts: list[str], model: np.ndarray) -> Iterator[tuple[int, Units, np.ndarray, np.ndarray]]:
    """(index of the first text, units, scores, language per unit) chunk by chunk."""
    for begin, some in chunks(texts):
        units = Units(*some)
        scores = units.scores(model)
        path = np.zeros(len(units), dtype=np.int64)
        for chosen, a, b in zip(languages_of(scores, units.owner), units.owner[:-1], units.owner[1:]):
            if b > a:
                path[a:b] = decode(scores[a:b], chosen)
        yield begin, units, scores, path


def analyse(texts: list[str], model: np.ndarray) -> Iterator[tuple[int, int, int, int, float, float]]:
    """Stretches (text, start, end, language, confidence, length in words) of texts.

    The confidence is the mean posterior of the stretch's language over its words,
    with the page's proportions as prior.
    """
    for begin, units, scores, path in paths(texts, model):
        if not len(units):
            continue
        text = np.repeat(np.arange(len(units.owner) - 1), np.diff(units.owner))
        share = _proportions(scores, units.owner)
        joint = np.exp(scores - scores.max(axis=1, keepdims=True)) * (0.9 * share + 0.1 / share.shape[1])[text]
        sure = joint[np.arange(len(path)), path] / joint.sum(axis=1)
        cuts = np.flatnonzero(np.concatenate(([True], (path[1:] != path[:-1]) | (text[1:] != text[:-1]))))
        ends = np.concatenate((cuts[1:], [len(path)]))
        confidence = np.add.reduceat(sure, cuts) / (ends - cuts)
        words = np.add.reduceat(units.weight, cuts) / 10
        offset = units.begin[text[cuts]]
        yield from zip(
            (begin + text[cuts]).tolist(),
            (units.first[cuts] - offset).tolist(),
            (units.last[ends - 1] - offset).tolist(),
            path[cuts].tolist(),
            confidence.astype(float).tolist(),
            words.tolist(),
        )


#: Characters of the sample to which the n-gram models are fitted, as expected from the
#: share of rows that is taken.
SAMPLE_CHARS = 4_000_000


def fitting_sample(texts: DataFrame, text: str, label: str, most: int = SAMPLE_CHARS) -> DataFrame:
    """(t, l): a seeded share of the rows that holds about ``most`` characters, all rows
    where there are no more. Chosen by a hash of the row, so it is the same every time."""
    rows = texts.select(F.col(text).alias("t"), F.col(label).alias("l")).where("t is not null")
    whole = rows.agg(F.sum(F.length("t").cast("long"))).first()[0] or 0
    if whole <= most:
        return rows
    grains = 1 << 20
    return rows.where(F.pmod(F.xxhash64(F.lit("fit"), "t", "l"), F.lit(grains)) < int(grains * most / whole))


def learn_models(texts: DataFrame, text: str, label: str, languages: tuple[str, ...] = LANGUAGES, rounds: int = 2, sample_chars: int = SAMPLE_CHARS, labels: DataFrame | None = None) -> np.ndarray:
    """N-gram models (order, bucket, language) as log-probabilities, fitted to a bounded
    sample of the texts (``fitting_sample``).

    Round 0 counts every text under the language its label names (texts without
    one count nothing); each further round counts every word under the language
    inferred for it. Partitions count for themselves and send sums, and the result
    has at most ``len(ORDERS) * BUCKETS * len(languages)`` numbers. With ``labels``
    (label, lang) the column ``label`` is a key of that table.
    """
    source = fitting_sample(texts, text, label, sample_chars)
    if labels is not None:
        source = source.join(labels.withColumnRenamed(label, "l"), "l", "left").select("t", F.col("lang").alias("l"))
    source = durable(balanced(source))
    seeds = _seed_counts(languages)
    counts = seeds.copy()
    for number in range(rounds + 1):
        sent = None if number == 0 else source.sparkSession.sparkContext.broadcast(_log_model(counts))

        def tally(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            own = np.zeros((len(ORDERS), BUCKETS, len(languages)), dtype=np.int64)
            for pdf in batches:
                if sent is not None:
                    for _, units, _, path in paths(pdf["t"].tolist(), sent.value):
                        units.count(path, own)
                    continue
                named = [label_language(name if isinstance(name, str) else None) for name in pdf["l"]]
                which = [languages.index(x) if x in languages else -1 for x in named]
                for begin, some in chunks(pdf["t"].tolist()):
                    units = Units(*some)
                    units.count(np.repeat(which[begin : begin + len(some)], np.diff(units.owner)).astype(np.int64), own)
            flat = own.reshape(-1)
            at = np.flatnonzero(flat)
            yield pd.DataFrame({"at": at, "n": flat[at]})

        summed = source.mapInPandas(tally, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
        counts = seeds * 2.0
        counts.reshape(-1)[summed["at"].to_numpy(dtype=np.int64)] += summed["n"].to_numpy(dtype=np.float64)
    return _log_model(counts)


def language_words(rows: DataFrame, key: str, text: str, model: np.ndarray, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """(key, lang, words): words of each language in all texts of a key, summed in the tasks
    before anything is shuffled. The rows are taken in the partitions in which they come.
    Null keys and texts without letters count nothing."""
    kind = rows.schema[key].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes, keys = pd.factorize(pdf["k"])
            own = np.zeros((len(keys), len(languages)))
            for begin, units, _, path in paths(pdf["t"].tolist(), sent.value):
                text = np.repeat(np.arange(len(units.owner) - 1), np.diff(units.owner))
                np.add.at(own, (codes[begin + text], path), units.weight / 10)
            k, lang = np.nonzero(own)
            yield pd.DataFrame({"key": keys[k], "lang": np.asarray(languages, dtype=object)[lang], "words": own[k, lang]})

    source = rows.select(F.col(key).alias("k"), F.col(text).alias("t")).where("k is not null and t is not null")
    found = source.mapInPandas(count, f"key {kind}, lang string, words double")
    return found.groupBy("key", "lang").agg(F.sum("words").alias("words"))


def segment_languages(rows: DataFrame, key: str, text: str, label: str, languages: tuple[str, ...] = LANGUAGES, model: np.ndarray | None = None) -> DataFrame:
    """One row per stretch: (key, segment_no, start_char, end_char, lang, confidence, words, label_lang).

    Offsets are code points from 1. Texts without any letter, and null texts, give
    no row; ``label_lang`` is the language that the label names, null if none.
    """
    if model is None:
        model = learn_models(rows, text, label, languages)
    kind = rows.schema[key].dataType.simpleString()
    schema = f"key {kind}, segment_no int, start_char int, end_char int, lang string, confidence double, words double, label_lang string"
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = pdf["k"].tolist()
            named = [label_language(name if isinstance(name, str) else None) for name in pdf["l"]]
            out, last, number = [], -1, 0
            for i, a, b, lang, sure, words in analyse(pdf["t"].tolist(), sent.value):
                number = number + 1 if i == last else 1
                last = i
                out.append((keys[i], number, a + 1, b, languages[lang], sure, words, named[i]))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    source = rows.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(label).alias("l")).where("k is not null and t is not null")
    return balanced(source).mapInPandas(part, schema)


def page_languages(segments: DataFrame) -> DataFrame:
    """Main language of every text with its share of the words and its confidence."""
    per = segments.groupBy("key", "lang").agg(F.sum("words").alias("words"), (F.sum(F.col("confidence") * F.col("words")) / F.sum("words")).alias("confidence"))
    return (
        per.groupBy("key")
        .agg(F.max(F.struct("words", "confidence", "lang")).alias("m"), F.sum("words").alias("all"))
        .select("key", F.col("m.lang").alias("lang"), F.col("m.confidence").alias("confidence"), (F.col("m.words") / F.col("all")).alias("share"))
    )


def unnamed_languages(segments: DataFrame, min_words: float = MIN_WORDS) -> DataFrame:
    """(key, lang): languages of a stretch of at least ``min_words`` which the label doesn't name."""
    return (
        segments.where(F.col("words") >= min_words)
        .where(F.col("label_lang").isNull() | (F.col("label_lang") != F.col("lang")))
        .select("key", "lang")
        .distinct()
    )
