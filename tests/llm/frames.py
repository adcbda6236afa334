from __future__ import annotations

import pytest

TESTDATA = "/root/testdata"


@pytest.fixture
def frame(spark):
    """Rows as a DataFrame of the columns of documents, with a column that clashes."""

    def make(texts, ids=None, partitions=3):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "src0", len(t or ""), 7) for i, t in zip(ids, texts, strict=True)]
        schema = "doc_id long, text string, lang string, source string, n_chars long, start int"
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make
