import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark, docs_schema):
    """Nulls in every column, empty, blank and very long texts, ties, repeated
    rows, and extra columns whose names the operators use themselves."""
    long = "wide river town " * 20_000
    rows = [(1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 5),
            (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 5),
            (2, None, "en", "a", None), (3, "", None, None, 0), (4, " \n\t ", "de", "b", 3), (None, "no id here at all", "en", "a", 1),
            (5, long, "en", "b", 9), (6, long, "en", "b", 9), (7, "12 34 ?!", None, "b", 1), (None, None, None, None, None),
            (8, "der hund und die katze sind im garten mit dem ball und der sonne", "de", "b", 4)]
    extra = "h long, score double, label int, row long, words string, fp long, __id long, kept boolean, toxic int, id long"
    return spark.createDataFrame([(*r, 1, 0.5, 1, 7, "x", 3, 9, True, 1, 2) for r in rows], f"{docs_schema}, {extra}")
