"""Main text of web pages: a recurrent network labels every block, reading the whole page.

Each page becomes the sequence of its blocks of text (``html_blocks``). A bidirectional LSTM
(``block_labeller``) reads path and word vectors of the whole sequence, so a paragraph of a reader's
comment and one of the article are told apart by what stands around them. It is fitted here, on the
driver, on ``sample`` pages at most (those of up to ``most_chars`` characters, by smallest hash),
labelled by their own markup where that marks an article, and on ``laid_out`` pages in other
layouts around the same texts (``page_layouts``). Applying it is one pass over the pages; a batch
takes pages of a few megabytes at once.

Defined results: a null or empty page, and one without any article block, give an empty text.
Comments, scripts, styles and drawings have no text; the title is not part of the article, its
headline is. A line break inside a block is white space. Unclosed elements and references end where
a browser would end them. Rows are kept as they are, repeated ones too; ids and urls may be null;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.block_labeller import Labeller, features
from feedlake.llm.html_blocks import blocks
from feedlake.llm.common import narrow
from feedlake.llm.page_layouts import by_markup, training_pages

#: Characters of pages labelled at once; a longer page is labelled alone.
AT_ONCE = 1 << 21


def train(pages: DataFrame, sample: int = 300, most_chars: int = 20_000, laid_out: int = 2_000) -> Labeller:
    """A labeller for the kind of ``pages``; the same for the same pages."""
    short = pages.select("html", F.xxhash64("page_id", "html").alias("h")).where(F.length("html").between(1, most_chars))
    # Copies count once, and only the chosen pages come to the driver.
    least = short.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    chosen = short.where(F.col("h") <= F.lit(least)).dropDuplicates(["h"]).orderBy("h").take(sample)
    crawled = [blocks(row.html) for row in chosen]
    known, labels = [], []
    for page in crawled:
        marked = by_markup(page)
        if marked is not None:
            known += [page] * 2  # as many as one in four
            labels += [marked] * 2
    for markup, truth in zip(*training_pages(crawled, laid_out), strict=True):
        page = blocks(markup)
        if [b.text for b in page] == [t for t, _ in truth]:
            known.append(page)
            labels.append([mine for _, mine in truth])
    return Labeller().fit(known, labels)


def main_texts(labeller: Labeller, pages: list[str | None]) -> list[str]:
    """The article of each page, its blocks joined by newlines."""
    out: list[str] = []
    held, size = [], 0

    def label() -> None:
        found = iter(labeller.logits(features(held)) > 0)
        out.extend("\n".join([b.text for b in page if next(found)]) for page in held)
        held.clear()

    for page in pages:
        held.append(blocks(page))
        size += len(page or "")
        if size >= AT_ONCE:
            label()
            size = 0
    label()
    return out


def extract(pages: DataFrame, labeller: Labeller) -> DataFrame:
    """Per row: (page_id, url, text, n_chars)."""
    pages = narrow(pages, "page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = main_texts(labeller, batch.column(2).to_pylist())
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
