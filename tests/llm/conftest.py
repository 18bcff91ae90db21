import os

import pytest
from pyspark.sql import Row

# As in the conftest above: whichever pytest loads last is the module that tests import.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TEXT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use inside."""

    def build(*rows):
        full = [(i, t, "en", "s", None if t is None else len(t), "x", 1, None) for i, t in rows]
        return spark.createDataFrame(full, f"{TEXT}, row string, fp int, mark string")

    return build


@pytest.fixture
def odd_docs(docs):
    """Null, empty, blank, very long, repeated and id-less rows."""
    words = " ".join(f"word{k % 977}" for k in range(30_000))
    return docs((1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, words), (5, "same text here"), (5, "same text here"), (None, "no id"), (6, "a\x00b 語𝄞 é"))
