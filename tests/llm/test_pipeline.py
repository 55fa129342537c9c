"""The pipeline against its stages done by hand, and the registry against DuckDB."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cohortlab.llm.registry import ORACLE, QUERIES
from tools.oracle_check import TABLES, _rows


@pytest.fixture(scope="module")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cur = duck.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(names, cur.fetchall())


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def test_stages_by_hand(spark, sf_dir):
    import hashlib

    import public_tokenizers
    from test_set_operators import components_by_hand
    from test_text_operators import encode_alone, features_by_hand, lines_by_hand

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], sf_dir).cache())
    given, good, lines, near, mix, last = ([tuple(r) for r in f.collect()] for f in frames)
    text, number = names.index("text"), names.index("doc_id")
    assert all(f.columns == names for f in frames[:-1])

    # quality: at this size no cutoff can be certified, so the base rules decide
    counts = {r[number]: features_by_hand(r[text]) for r in given}
    keep = {i for i, c in counts.items() if c["n_words"] >= 10 and 100 * c["n_repeat_words"] <= 20 * c["n_words"]}
    assert {r[number] for r in good} == keep
    # lines
    want = {i: t for i, t, _, _ in lines_by_hand([(r[number], r[text]) for r in good])}
    assert {r[number]: r[text] for r in lines} == want
    assert all(r[names.index("n_chars")] == len(r[text]) for r in lines)
    # near duplicates
    homes, _ = components_by_hand([(r[number], r[text]) for r in lines], corpus_pipeline.NEAR_PERCENT)
    assert {r[number] for r in near} == {i for i, home in homes.items() if i == home}
    # mixture: whole documents, at most three times each
    rows = {r[number]: r for r in near}
    assert all(rows[r[number]] == r for r in mix)
    assert max((sum(1 for r in mix if r[number] == i) for i in rows), default=0) <= 3
    # encoding
    assert len(last) == len(mix)
    by_id = {r[number]: r[text] for r in mix}
    for i, n, ids, back in last:
        coded = encode_alone(by_id[i])
        import numpy as np
        assert n == len(coded) and ids == hashlib.sha256(np.array(coded, "<u4").tobytes()).hexdigest()
        assert back == hashlib.sha256(by_id[i].encode()).hexdigest()
    assert public_tokenizers.PATTERN


def test_stages_on_edges(spark, sf_dir):
    """Nulls in every column, empty texts, a group of copies of a third of the rows, repeated rows, extra columns."""
    good = "A sentence of more than ten words that says a little about nothing much, number {}."
    rows = [(None, None, None, None, None), (1, None, "en", "s", None), (2, "", None, None, 0), (3, good.format(3), None, None, None)]
    rows += [(100 + i, "Copies hold this short line here.\nAnd another short line as well.\nThen a third one to end it all.", "en", "hot", 1) for i in range(40)]
    rows += [(200 + i, f"{good.format(i)}\nA line of at least forty characters that many share.\n{i} {i * 7} {i * 31} end", "en", f"s{i % 3}", 2)
             for i in range(40)]
    rows += [(300, good.format("again"), "fr", "s", 3)] * 2 + [(None, good.format("without id"), "en", "s", 4)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, keys string, size long")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == names, name
    kept = [r.doc_id for r in docs.collect()]
    assert set(kept) <= {r[0] for r in rows} and 100 in kept and not {101, 1, 2} & set(kept)
    assert not any("many share" in (r.text or "") for r in docs.collect() if r.doc_id != 239)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert sorted(r.doc_id or 0 for r in last) == sorted(i or 0 for i in kept)


def test_stages_on_no_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
