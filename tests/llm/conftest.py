from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use themselves."""
    def make(rows, **more):
        full = [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), 7, "x") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long,"
                                           " size long, keys string")
    return make


@pytest.fixture(scope="session")
def corpus(sf_dir):
    """(doc_id, text) of the small driver table."""
    import pyarrow.parquet as pq

    t = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(t.column(0).to_pylist(), t.column(1).to_pylist()))
