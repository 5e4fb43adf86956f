import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))
SF = "/root/testdata/sf0.001"

TEXTS = [
    None, "", "   \n\t", "!!! ???", "one", "Vier Wörter sind wenige.", "日本語のテキスト", "a" * 3000,
    "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 400,
]


@pytest.fixture(scope="session")
def session(spark):
    from sozmill.llm.common import ship

    ship(spark)
    return spark


@pytest.fixture(scope="session")
def documents(session):
    return session.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(session):
    """Null, empty and long texts, ties, repeated rows, null ids and metadata."""
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(TEXTS)]
    rows += [(3, TEXTS[3], "en", "s", 1), (None, "one", None, None, None), (None, None, None, None, None)]
    return session.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
