import os

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(autouse=True, scope="session")
def importable(spark):
    """Python workers find the package whatever folder the tests run in."""
    spark.sparkContext.environment["PYTHONPATH"] = REPO


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with the columns of the table and some that clash with the operators' own."""

    def make(rows):
        clashing = "spans string, found string, ids string, n string, set_id string, component string, lang_pred string, id string"
        width = clashing.count(",") + 1
        full = [(i, t, lang, "src", len(t) if t is not None else None, *["x"] * width) for i, t, lang in rows]
        return spark.createDataFrame(full, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {clashing}")

    return make
