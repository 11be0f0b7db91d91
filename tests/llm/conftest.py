import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from texts import prose  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, piece string, fp long"

@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, repeated rows, repeated and negative ids."""
    long = " ".join(prose(k, 400) for k in range(50))
    texts = [None, "", " ", "  \n\t ", "one", "Two  words\n", long, prose(1, 40), prose(1, 40), prose(2, 40), "ünï cödé  ß", "x" * 5000]
    rows = [(k, t, "en", "s", 1, 0.5, "p", 7) for k, t in enumerate(texts)]
    rows += [rows[7], rows[7], (7, prose(3, 30), None, None, None, None, None, None), (None, prose(4, 30), None, None, None, None, None, None)]
    return [*rows, (None, None, None, None, None, None, None, None), (-20, prose(5, 60), "de", "s", 2, 0.1, "q", 8)]


@pytest.fixture
def odd(spark, odd_rows):
    """The same as a table, with columns whose names the operators use for their own."""
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
