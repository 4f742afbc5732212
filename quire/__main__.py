"""Runs from the command line, under ``spark-submit`` or ``python -m quire``.

    texts    FOLDER OUTPUT           text files as books: notices split off, paragraphs, headings
    volumes  FOLDER OUTPUT           zipped page files as pages with their numbers
    segment  PAGES  OUTPUT [MODEL]   sections of volumes (parquet of book_id, page_no, page_id, text)
    fit      PAGES  MODEL            a page model from the column ``label`` of such pages
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from quire.operators import headings, markup, page_features, segmentation, volumes
from quire.runtime import durable, ship
from quire.sources import books


def main(arguments: list[str]) -> int:
    if len(arguments) < 3 or arguments[0] not in ("texts", "volumes", "segment", "fit"):
        print(__doc__)
        return 2
    what, source, output, *more = arguments
    spark = SparkSession.builder.getOrCreate()
    ship(spark)
    if what == "texts":
        parts = markup.split_notices(books.read_texts(spark, source))
        paras = markup.paragraphs(parts, "body")
        paras.write.parquet(f"{output}/paragraphs")
        headings.headings(paras.where("not star")).write.parquet(f"{output}/headings")
    elif what == "volumes":
        read = books.read_volumes(spark, source)
        read.where("error is not null").write.parquet(f"{output}/errors")
        books.page_numbers(read.where("error is null")).write.parquet(f"{output}/pages")
    else:
        pages = spark.read.parquet(source)
        lines = volumes.volume(pages, "text")
        if what == "segment":
            model = segmentation.PageModel.load(more[0]) if more else None
            segmentation.segment_volumes(lines, model).write.parquet(output)
        else:
            features = durable(page_features.context_features(page_features.long_features(lines)))
            segmentation.fit_labels(features, pages.select("book_id", "page_no", "label")).save(output)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
