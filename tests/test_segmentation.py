"""A page model fitted and applied, from Python and from the command line."""

import random

import pytest

from quire.__main__ import main
from quire.operators import page_features as pf
from quire.operators import segmentation as sg
from quire.operators import volumes as vo

KINDS = {"toc": "CONTENTS\nchapter {n} page {m}\nchapter {m} page {n}", "content": "the keeper walked to the mill and met a widow there\nshe had seen {n} lanterns by the river", "index": "INDEX\nmill {n} {m}\nriver {m} {n}"}


def pages(seed, books):
    rng = random.Random(seed)
    out = []
    for b in range(books):
        kinds = ["toc"] + ["content"] * 8 + ["index"] * 2
        out += [(f"{seed}.{b}", no, no, KINDS[k].format(n=rng.randrange(99), m=rng.randrange(99)), k) for no, k in enumerate(kinds, 1)]
    return out


SCHEMA = "book_id string, page_no int, page_id int, text string, label string"


def test_held_out_pages_get_their_labels(spark, tmp_path):
    train, held = (spark.createDataFrame(pages(s, n), SCHEMA) for s, n in ((1, 12), (2, 4)))
    features = lambda df: pf.context_features(pf.long_features(vo.volume(df, "text")))
    model = sg.fit_labels(features(train), train.select("book_id", "page_no", "label"))
    got = {(r.book_id, r.page_no): (r.label, r.confidence) for r in sg.model_labels(features(held), model).collect()}
    truth = {(b, no): k for b, no, _, _, k in pages(2, 4)}
    assert sum(got[x][0] == k for x, k in truth.items()) >= 0.95 * len(truth) and all(0 < c <= 1 for _, c in got.values())
    with pytest.raises(ValueError):
        sg.fit_labels(features(train), train.select("book_id", "page_no", "label").limit(0))
    assert sg.model_labels(features(held).limit(0), model).count() == 0


def test_command_line(spark, tmp_path):
    spark.createDataFrame(pages(1, 6), SCHEMA).write.parquet(str(tmp_path / "pages"))
    assert main(["fit", str(tmp_path / "pages"), str(tmp_path / "model.npz")]) == 0
    assert main(["segment", str(tmp_path / "pages"), str(tmp_path / "out"), str(tmp_path / "model.npz")]) == 0
    where = {r.page_no: r.section for r in spark.read.parquet(str(tmp_path / "out")).where("book_id = '1.0'").collect()}
    assert where[1] == "front" and where[5] == "body" and where[11] == "back"
    assert main([]) == 2
