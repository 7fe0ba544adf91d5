import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

SF = "/root/testdata/sf0.001"

ODD_TEXTS = [None, "", "   \n\t", "one", "one two", "One TWO three", "à la carte Ünïcödé ﬁ ſ İstanbul 東京 テスト", "a b\x1cc",
             "x " * 50, "line one here\nline one here\nline two there\n\nline one here", "w" * 5000,
             " ".join(f"word{i}" for i in range(6000)), "<|endoftext|> don't stop we're 12 34", "%%% *** $$$ &&& ### |||"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra clashing columns."""
    rows = [(i, t, ["en", None, "fr"][i % 3], ["s1", None, "s2"][i % 3], "x", 1, 2.0) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (5, "another text under one id " * 4, "en", "s1", "y", 1, 2.0), (None, "text without an id " * 5, None, None, None, None, None),
             (None, None, None, None, None, None, None), (2**60 + 7, "a large id keeps its last digits", "de", "s3", "z", 3, 4.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row string, fp long, size double")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (1, 0, 1), (1, 0, 1), (3, None, None), (None, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
