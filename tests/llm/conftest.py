"""Small tables for the training-data operators, with the rows real ones may hold."""

import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
# Tests of the folder above take this from whichever of the two files of this name was loaded last.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCUMENT = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
     T.StructField("n_chars", T.LongType())]
)


@pytest.fixture
def docs(spark):
    """Builds documents from (id, text[, lang[, source]])."""

    def build(*rows):
        full = [(*r, *[None, None, None][len(r) - 2 :]) for r in rows]
        full = [(i, t, lang, source, len(t or "")) for i, t, lang, source, *_ in full]
        return spark.createDataFrame(full, DOCUMENT)

    return build


@pytest.fixture
def odd(docs):
    """NULLs in every column, empty and blank texts, ties and repeats, a very long text."""
    return docs(
        (1, None, None, None), (2, "", "en", "a"), (3, " \n\t", "en", "a"), (4, "the cat sat on the mat", "en", "a"),
        (4, "the cat sat on the mat", "en", "a"), (None, "the cat sat on the mat", None, "b"),
        (5, "le chat est sur le tapis", "fr", None), (6, "word " * 60_000, "en", "a"), (7, "x" * 200_000, "en", "a"),
        (8, "12345 !!! é", "fr", "b"), (None, None, None, None),
    )
