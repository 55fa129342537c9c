"""Periodic runs against brute force over all periods; edge cases; the query on the driver table."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlab.llm import runs

EMPTY = hashlib.sha256(b"").hexdigest()


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(words[i] == words[i + q] for i in range(len(words) - q)))


def runs_by_hand(words, min_length=24, times=3):
    found, n = [], len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_length, times * q) and smallest_period(words[i:i + length]) == q:
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def looped_by_hand(key, words):
    n, h = len(words), zlib.crc32(str(key).encode())
    if key is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def row_by_hand(key, text):
    words = looped_by_hand(key, (text or "").encode().split())
    found = runs_by_hand(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return (key, len(found), *best, best[1] * 1000 // best[2] if found else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=1), max_size=60), st.integers(2, 9), st.integers(2, 4))
def test_runs_of_small_alphabets(words, least, times):
    words = [w.encode() for w in words]
    assert runs.runs_of([words], least, times) == [runs_by_hand(words, least, times)]


def test_nested_and_overlapping_runs_in_one_slice():
    rng = random.Random(3)
    texts = []
    for _ in range(120):
        words = [b"%d" % rng.randrange(50) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 3)):
            unit = [b"%d" % rng.randrange(4) for _ in range(rng.randrange(1, 20))]
            words += unit * rng.randrange(1, 12) + unit[:rng.randrange(len(unit) + 1)]
            if rng.random() < 0.4:
                words = words * rng.randrange(1, 4)
        texts.append(words[:600])
    assert runs.runs_of(texts) == [runs_by_hand(t) for t in texts]
    assert sum(map(len, runs.runs_of(texts))) > 60


@pytest.mark.parametrize("words", [[b"w"] * 30_000, [b"a", b"b", b"c"] * 9_000, [b"x"] * 23, [b"x"] * 24])
def test_long_repetitions(words):
    period = len(set(words))
    assert runs.runs_of([words]) == [[(0, len(words), period)] if len(words) >= 24 else []]


def test_positions_keep_their_order():
    rng = random.Random(5)
    values = rng.sample(range(100_000), 6_000)
    held = runs.Positions(values[0])
    seen = {values[0]}
    for x in values[1:]:
        left = max((v for v in seen if v < x), default=-1) if len(seen) < 200 else None
        if left is not None:
            assert held.around(x) == (left, min((v for v in seen if v > x), default=-1))
        held.add(x)
        seen.add(x)
    assert list(held) == sorted(seen) and len(held.blocks) > 1


def test_query_equals_brute_force(spark, sf_dir, corpus):
    got = {r[0]: tuple(r) for r in runs.op12_periodic_runs(spark, sf_dir).collect()}
    assert got == {i: row_by_hand(i, t) for i, t in corpus}
    assert sum(r[1] for r in got.values()) > 10


def test_edges(spark, docs_of):
    loop = "one two three " * 20
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, loop), (5, loop), (None, loop), (6, "tie " * 30 + "x " + "tie " * 30)]
    found = runs.find_runs(docs_of(rows)).collect()
    assert len(found) == len(rows)
    assert all(r.runs == [] and r.collapsed == ("a" if r.id == 4 else "") for r in found if r.id in (1, 2, 3, 4))
    assert [(tuple(r.runs[0]), r.collapsed) for r in found if r.id in (5, None)] == [((0, 60, 3), "one two three")] * 3
    six = next(r for r in found if r.id == 6)
    assert [tuple(r) for r in six.runs] == [(0, 30, 1), (31, 30, 1)] and six.collapsed == "tie x tie"
    assert runs.find_runs(docs_of([])).count() == 0
    strings = spark.createDataFrame([("k", loop, 1)], "doc_id string, text string, runs int")
    assert runs.find_runs(strings).columns == ["id", "runs", "collapsed"] and runs.find_runs(strings).first().id == "k"
    assert runs.looped(None, [b"a"] * 9) == [b"a"] * 9
