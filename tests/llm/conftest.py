import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, d long, key string, id string, digest string, copies int"


@pytest.fixture
def docs_of(spark):
    """DataFrame of documents from (id, text[, lang, source]) rows, with extra columns of clashing names."""
    def make(rows):
        full = [(*r, *("en", "src1")[len(r) - 2:], len(r[1] or ""), 7, "k", None, "x", 3) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)
    return make


@pytest.fixture
def rng():
    return random.Random(11)
