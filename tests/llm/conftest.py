from __future__ import annotations

import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session", autouse=True)
def found_by_workers(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with further columns of troublesome names."""

    def make(*pairs):
        rows = [(i, t, "en", f"s{n}", len(t or ""), n, "x", 1.5) for n, (i, t) in enumerate(pairs)]
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, "
            "row long, _key string, key double"
        )
        return spark.createDataFrame(rows, schema).repartition(3)

    return make
