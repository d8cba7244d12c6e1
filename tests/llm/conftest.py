from __future__ import annotations

import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from periodbook.llm.queries import ship

    ship(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows, with a column whose name clashes with the operators' own."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, rep string")

    return make
