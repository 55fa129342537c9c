"""The n-gram Jaccard join against all pairs; the proofs of exclusion; edge cases."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlab.llm import sigtree


def grams(text, words=3):
    ws = (text or "").encode().lower().split()
    if not ws:
        return frozenset()
    if len(ws) < words:
        return frozenset([tuple(ws)])
    return frozenset(tuple(ws[i:i + words]) for i in range(len(ws) - words + 1))


def by_hand(rows, percent=90):
    """Counter of (id, n_shingles, component) by comparing all pairs that share a shingle."""
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    common = Counter()
    for own in holders.values():
        own = own if len(own) < 400 else own
        for k, b in enumerate(own):
            for a in own[:k]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[find(b)] = find(a)
    first = {}
    for i, (key, _) in enumerate(rows):
        if key is not None and sets[i]:
            parent[find(i)] = find(first.setdefault(key, i))
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None and sets[i]:
            least[find(i)] = min(key, least.get(find(i), key))
    return Counter((key, len(sets[i]), least.get(find(i), key) if sets[i] else key) for i, (key, _) in enumerate(rows))


def found(spark, rows, kind="long", **more):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], f"doc_id {kind}, text string, tree string, members int")
    return Counter(tuple(r) for r in sigtree.jaccard_components(df, **more).collect())


def linked_pair(rng, n, percent):
    """Two sets of random hashes at or just above the threshold."""
    universe = rng.choice(1 << 62, 3 * n + 10, replace=False).astype(np.uint64) * np.uint64(2)
    a = n
    while True:
        b = int(rng.integers(-(-a * percent // 100), a * 100 // percent + 1))
        common = -(-percent * (a + b) // (100 + percent))
        if common <= min(a, b):
            break
    x, y = universe[:a], np.concatenate([universe[:common], universe[a:a + b - common]])
    return np.sort(x), np.sort(y)


@pytest.mark.parametrize("percent", [60, 80, 90, 95])
def test_linked_sets_share_a_tree(percent):
    ladder, rng = sigtree.Ladder(percent), np.random.default_rng(percent)
    for n in [*range(1, 60), 100, 333, 1000, 2500] * 4:
        x, y = linked_pair(rng, n, percent)
        if len(x) == len(y) and (x == y).all():
            continue
        keys, ends = sigtree.tree_keys([x, y], ladder)
        assert set(keys[:ends[0]].tolist()) & set(keys[ends[0]:].tolist()), (n, len(y))


def test_sets_whose_filled_parts_all_differ_meet_in_an_empty_one():
    ladder = sigtree.Ladder(90)
    n, parts = 10, int(ladder.parts[ladder.levels(np.asarray([10]))[0][0]])
    base = (np.arange(1, n + 1, dtype=np.uint64)) << np.uint64(8)  # all in the first part of several
    other = np.sort(np.concatenate([base[:-1], base[-1:] + np.uint64(7)]))
    assert parts > 1
    keys, ends = sigtree.tree_keys([base, np.sort(np.concatenate([base, other[-1:]]))], ladder)
    assert set(keys[:ends[0]].tolist()) & set(keys[ends[0]:].tolist())


def test_few_trees_per_set():
    rng = np.random.default_rng(1)
    sets = [np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (50, 200, 500, 2000)]
    _, ends = sigtree.tree_keys(sets, sigtree.Ladder(90))
    assert all(k <= 0.4 * len(s) + 4 for k, s in zip(np.diff(np.concatenate([[0], ends])), sets))


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 1 << 30), st.integers(2, 120), st.integers(1, 40), st.sampled_from([70, 90]))
def test_nodes_never_exclude_a_link(seed, n, nodes, percent):
    rng = np.random.default_rng(seed)
    x, y = linked_pair(rng, n, percent)
    bits = [sigtree.bitmap(s) for s in (x, y)]
    assert sigtree.may_link(np.array([len(x)]), bits[0][None], np.array([len(y)]), bits[1][None], percent).all()
    leaves = []
    for k in range(nodes + 2):
        s = x if k == 0 else y if k == nodes + 1 else np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = sigtree.bitmap(s)
        leaves.append(sigtree.Node(len(s), len(s), len(s) - int(sigtree.count(b)), b, str(k), leaf=k))
    assert (0, nodes + 1) in {tuple(sorted(p)) for p in sigtree.dual(sigtree.over(leaves), percent)}


def test_dual_traversal_leaves_out_one_component():
    b = sigtree.bitmap(np.arange(40, dtype=np.uint64))
    leaves = [sigtree.Node(40, 40, 0, b, "one" if k < 39 else "two", leaf=k) for k in range(40)]
    pairs = {tuple(sorted(p)) for p in sigtree.dual(sigtree.over(leaves), 90)}
    assert pairs == {(k, 39) for k in range(39)}


def corpus_with_families(corpus):
    rng = random.Random(8)
    rows = [(i + 100_000, t) for i, t in corpus]
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    chain = base
    for i in range(60):  # a chain: each is near the one before, the ends are not alike
        chain = chain[:]
        chain[rng.randrange(150)] = f"n{i}"
        rows.append((1000 + i, " ".join(chain)))
    for i in range(150):  # a family below the threshold with one another, and at it with some
        own = base[:]
        for _ in range(rng.choice([1, 2, 2, 3, 4])):
            own[rng.randrange(150)] = f"f{i}_{rng.randrange(9)}"
        rows.append((2000 + i, " ".join(own)))
    for i in range(60):  # a shared passage that does not make documents near
        rows.append((3000 + i, " ".join(base[:40] + [f"q{i}_{j}" for j in range(80)])))
    for i, n in enumerate([*range(1, 40)] * 2):  # short texts that grow word by word
        rows.append((4000 + i, " ".join(base[:n])))
    return rows


@pytest.mark.parametrize("leaf,piece", [(64, 4096), (3, 7)])
def test_components_equal_all_pairs(spark, corpus, leaf, piece):
    rows = corpus_with_families(corpus)
    got = found(spark, rows, leaf=leaf, piece=piece)
    assert got == by_hand(rows)
    assert len({c for _, _, c in got}) < len(got)


def test_lower_threshold(spark, corpus):
    rows = corpus_with_families(corpus[:40])
    assert found(spark, rows, percent=70, leaf=5) == by_hand(rows, 70)


def test_query_equals_all_pairs(spark, sf_dir, corpus):
    got = Counter(tuple(r) for r in sigtree.op13_signature_trees(spark, sf_dir).collect())
    assert got == by_hand(corpus)


def test_edges(spark):
    long = " ".join(f"a{i}" for i in range(200))
    near = long + " more"
    rows = [(5, long), (5, long), (9, long.upper()), (7, near), (None, long), (None, None), (None, "own words only"), (11, ""), (12, " \n\t"),
            (13, "two words"), (14, "Two  words"), (15, "one"), (16, None), (20, long + " x"), (20, "another text of the same id"),
            (21, "another text of the same id"), (30, "word " * 20_000)]
    assert found(spark, rows) == by_hand(rows)
    assert found(spark, [], leaf=2) == Counter()
    strings = [(f"k{i % 7}" if i % 5 else None, t) for i, (_, t) in enumerate(rows)]
    assert found(spark, strings, "string") == by_hand(strings)


def test_a_large_family_costs_no_pairs_of_all(spark, monkeypatch):
    """Near copies of one text: pairs along edges only."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(400):
        own = base[:]
        own[rng.randrange(300)] = f"c{i}"
        rows.append((i, " ".join(own)))
    counts = {}
    real = sigtree.written

    def counting(df, what):
        out = real(df, what)
        counts[what] = out.count()
        return out

    monkeypatch.setattr(sigtree, "written", counting)
    assert len({c for _, _, c in found(spark, rows)}) == 1
    assert counts["tree-edges"] < 40 * len(rows) and counts["more-links"] == 0 and counts["open-trees"] == 0
