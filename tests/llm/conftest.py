from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with the table's other columns and an extra one that clashes."""
    from cohortcraft.llm.workers import ship_package

    ship_package(spark)

    def make(pairs):
        rows = [(i, t, None if k % 5 == 4 else "en", f"src{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(rows, DOCS)

    return make
