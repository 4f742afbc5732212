"""Front, body and back of a volume from labels of its pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.page_features import context_features, long_features
from quire.operators.windows import islands
from quire.runtime import durable


def rule_labels(pages: DataFrame) -> DataFrame:
    """Default labeller (book_id, page_no, label) from key words and position, for use where
    no trained model is given."""
    wide = long_features(pages).groupBy("book_id", "page_no").agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("m"))
    has = lambda *names: F.coalesce(F.greatest(F.lit(0.0), *[F.coalesce(F.try_element_at("m", F.lit(n)), F.lit(0.0)) for n in names]), F.lit(0.0)) > 0
    early, late = has("position:first10"), has("position:last10")
    label = (
        F.when(has("word:blank_page"), "blank")
        .when(early & has("word:header_contents"), "toc")
        .when(early & has("word:copyright", "word:copyrighted", "word:published"), "pubinfo")
        .when(early & has("word:header_dedicated", "word:dedicated"), "dedication")
        .when(early & has("word:header_preface", "word:header_introduction", "word:header_foreword"), "preface")
        .when(late & has("word:header_index"), "index")
        .when(late & has("word:header_appendix"), "appendix")
        .when(has("word:header_advertisement", "word:header_advertisements"), "ad")
        .when(early & has("word:words_under_5"), "title")
        .otherwise("content")
    )
    return wide.select("book_id", "page_no", label.alias("label"))


def predict_labels(vectors: DataFrame, model: Callable[[pd.DataFrame], list[str]]) -> DataFrame:
    """Labels by a model of one's own: it gets the pages of a book in order (page_no, vector)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("page_no")
        return pd.DataFrame({"book_id": pdf["book_id"], "page_no": pdf["page_no"], "label": model(pdf)})

    return vectors.groupBy("book_id").applyInPandas(run, "book_id string, page_no int, label string")


def label_runs(labels: DataFrame) -> DataFrame:
    """(book_id, start, end, label, pages): runs of equal labels; a run ends where the next
    begins, the last one behind its last page. Null labels form runs of their own."""
    w = Window.partitionBy("book_id").orderBy("page_no")
    changed = ~F.col("label").eqNullSafe(F.lag("label").over(w)) | F.lag("page_no").over(w).isNull()
    per = islands(labels, ["book_id"], ["page_no"], changed, "run").groupBy("book_id", "run").agg(
        F.min("page_no").alias("start"), F.max("page_no").alias("last"), F.first("label").alias("label"), F.count(F.lit(1)).alias("pages")
    )
    following = F.lead("start").over(Window.partitionBy("book_id").orderBy("run"))
    return per.select("book_id", "start", F.coalesce(following, F.col("last") + 1).alias("end"), "label", "pages")


def body_run(runs: DataFrame, content: str = "content") -> DataFrame:
    """(book_id, start, end): the longest run of content, the first of equally long ones;
    without any, the last run of the book."""
    size = F.col("end") - F.col("start")
    best = runs.withColumn("rank", F.when(F.col("label") == content, F.struct(F.lit(1).alias("c"), size.alias("n"), (-F.col("start")).alias("s"))).otherwise(F.struct(F.lit(0).alias("c"), F.lit(0).alias("n"), F.col("start").alias("s"))))
    return best.groupBy("book_id").agg(F.max_by(F.struct("start", "end"), "rank").alias("b")).select("book_id", "b.start", "b.end")


def sections(labels: DataFrame) -> DataFrame:
    """(book_id, page_no, label, section): front, body or back."""
    body = body_run(label_runs(labels)).select("book_id", F.col("start").alias("_a"), F.col("end").alias("_b"))
    where = F.when(F.col("page_no") < F.col("_a"), "front").when(F.col("page_no") >= F.col("_b"), "back").otherwise("body")
    return labels.join(body, "book_id").select("book_id", "page_no", "label", where.alias("section"))


# a trained labeller ----------------------------------------------------------------


class PageModel(NamedTuple):
    """Softmax over the features of a page: classes, feature names in order, their means and
    deviations, and weights (class, feature + 1), the last of which is the bias."""

    classes: tuple[str, ...]
    features: tuple[str, ...]
    means: np.ndarray
    deviations: np.ndarray
    weights: np.ndarray

    def save(self, path: str) -> None:
        np.savez(path, classes=np.array(self.classes), features=np.array(self.features), means=self.means, deviations=self.deviations, weights=self.weights)

    @staticmethod
    def load(path: str) -> PageModel:
        data = np.load(path, allow_pickle=False)
        return PageModel(tuple(data["classes"].tolist()), tuple(data["features"].tolist()), data["means"], data["deviations"], data["weights"])


#: Labelled pages to which a model is fitted at most, features it uses at most, and the
#: pull of its weights towards 0.
MOST_PAGES, MOST_FEATURES, PULL = 20_000, 1500, 1e-3


def _by_page(features: DataFrame) -> DataFrame:
    return features.groupBy("book_id", "page_no").agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("m"))


def fit_labels(features: DataFrame, labels: DataFrame, most: int = MOST_PAGES, steps: int = 300) -> PageModel:
    """Fit a labeller to (book_id, page_no, label), with features (book_id, page_no, feature,
    value), those of neighbouring pages among them (``context_features``).

    Classes weigh alike however rare. At most ``most`` labelled pages (the first by a hash)
    and the ``MOST_FEATURES`` most frequent features reach the driver. Without any labelled
    page there is nothing to learn: ValueError.
    """
    chosen = labels.where("label is not null").orderBy(F.xxhash64("book_id", "page_no"), "book_id", "page_no").limit(most)
    chosen = durable(chosen.select("book_id", "page_no", "label"))
    own = features.join(chosen.select("book_id", "page_no"), ["book_id", "page_no"], "left_semi").where("value is not null")
    used = own.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "feature").limit(MOST_FEATURES)
    names = tuple(sorted(r.feature for r in used.collect()))
    rows = chosen.join(_by_page(own), ["book_id", "page_no"], "left").select("label", "m").toPandas()
    if not len(rows):
        raise ValueError("no labelled page")
    x = _dense(rows["m"], names)
    means, deviations = x.mean(axis=0), x.std(axis=0)
    deviations[deviations == 0] = 1.0
    x = np.concatenate(((x - means) / deviations, np.ones((len(x), 1))), axis=1)
    classes = tuple(sorted(set(rows["label"])))
    at = np.array([classes.index(v) for v in rows["label"]])
    truth = np.eye(len(classes))[at]
    weight = (1 / np.bincount(at, minlength=len(classes)))[at, None] / len(classes)
    w, speed = np.zeros((len(classes), x.shape[1])), np.zeros((len(classes), x.shape[1]))
    for _ in range(steps):
        slope = ((_softmax(x @ w.T) - truth) * weight).T @ x + PULL * w
        speed = 0.9 * speed - 0.5 * slope
        w += speed
    return PageModel(classes, names, means, deviations, w)


def _dense(maps: pd.Series, names: tuple[str, ...]) -> np.ndarray:
    at = {n: i for i, n in enumerate(names)}
    out = np.zeros((len(maps), len(names)))
    for row, m in enumerate(maps):
        for name, value in m.items() if isinstance(m, dict) else m if m is not None else ():
            if name in at:
                out[row, at[name]] = value
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def model_labels(features: DataFrame, model: PageModel) -> DataFrame:
    """(book_id, page_no, label, confidence) of every page that has features, page by page."""
    sent = features.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for pdf in batches:
            x = (_dense(pdf["m"], m.features) - m.means) / m.deviations
            p = _softmax(np.concatenate((x, np.ones((len(x), 1))), axis=1) @ m.weights.T)
            best = p.argmax(axis=1)
            yield pd.DataFrame({"book_id": pdf["book_id"].astype(object), "page_no": pdf["page_no"], "label": pd.Series([m.classes[i] for i in best], dtype=object), "confidence": p[np.arange(len(p)), best]})

    return _by_page(features.where("value is not null")).mapInPandas(label, "book_id string, page_no int, label string, confidence double")


def segment_volumes(pages: DataFrame, model: PageModel | None = None) -> DataFrame:
    """Labels and sections of whole volumes, by a trained model or else by rule."""
    labels = rule_labels(pages) if model is None else model_labels(context_features(long_features(pages)), model).drop("confidence")
    return sections(labels)
