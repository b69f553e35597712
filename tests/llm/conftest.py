import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
pytest.importorskip("inkwell.llm.queries")

DOCS = "doc_id long, text string, lang string, fingerprint string, kept boolean, name long, h long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and repeated rows, columns with clashing names."""
    rows = [
        (1, "a b c d e f g", None, "x", True, 1, 1), (1, "a b c d e f g", None, "x", True, 1, 1),
        (2, "a  b\tc d\ne f g", "en", None, None, None, None), (3, None, None, None, None, None, None),
        (4, "", "en", "y", False, 2, 2), (None, "a b c d e f g", None, None, None, None, None),
        (None, None, None, None, None, None, None), (5, " \n ", "de", "z", True, 3, 3),
        (6, "lone words", "fr", "z", True, 3, 3), (7, "word " * 30000, "en", "z", True, 3, 3),
        (8, "You are a stupid worthless idiot.", "en", "z", True, 3, 3),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
