import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])


@pytest.fixture(autouse=True)
def workers(spark):
    """Python workers find the package wherever the tests were started."""
    sys.path[:0] = [] if ROOT in sys.path else [ROOT]
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeats, and clashing extra columns."""
    rows = [
        (1, "alpha beta gamma delta", "en", 1, 0.5),
        (1, "alpha beta gamma delta", "en", 1, 0.5),
        (2, "", None, None, None),
        (3, None, None, None, None),
        (None, "alpha beta gamma delta", None, 2, 0.1),
        (None, None, None, None, None),
        (4, " \n\t ", "x", 3, 0.2),
        (5, "word next. " * 30_000, "en", 4, 0.3),
        (6, "é中🙂 <|endoftext|> 's", "zz", 5, 0.4),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, n_words long, score double")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
