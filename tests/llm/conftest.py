import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
@pytest.fixture
def rng():
    return np.random.default_rng(11)


@pytest.fixture
def docs(spark):
    """Makes a documents table from texts (ids 0, 1, ...) or (id, text) pairs."""
    def make(texts, extra=False):
        rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
        df = spark.createDataFrame([(i, t, "en", "src", len(t) if t is not None else None) for i, t in rows], DOCS)
        if extra:  # names that operators use themselves
            for c in ("score", "n_lines", "_id", "_key", "_rest", "_row", "window", "lang_pred", "found", "root"):
                df = df.withColumn(c, F.lit("x"))
        return df
    return make


@pytest.fixture
def awkward():
    """Texts with every odd case: null, empty, blank, one word, repeated rows, a very long text, odd characters."""
    return [None, "", " \n\t ", "word", "same text twice " * 4, "same text twice " * 4, "lorem ipsum " * 60_000,
            "x" * 70_000, "ÄÖ É ü   İ ǅ 𝒳 \x1c \x85 end", "12 34 ### !!!", "\n\n\n", "naïve façade\r\nnext\tline"]
