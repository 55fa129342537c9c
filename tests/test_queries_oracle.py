"""Every query of the reference's operators against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from cohortlab.plans.queries import QUERIES
from oracle_sql import ORACLE
from tools.oracle_check import TABLES, _rows


@pytest.fixture(scope="module")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(got) == len(want)
    assert _rows(cols, got) == _rows(ocols, want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "summary_key" in df.columns
