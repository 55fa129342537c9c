"""Language model, sharding, mixing, near dedup and neighbours against brute force; edge cases."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortlab.llm import ann, lm, minhash, mixing, sharding

EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "word " * 30_000), (6, "same text"), (7, "same text"), (None, "no id")]


# ------------------------------------------------------------ language model
def test_base_scores_and_gain_on_held_out(docs_of, corpus):
    rows = EDGES + [(i + 100, t) for i, t in corpus]
    got = lm.score_documents(docs_of(rows)).collect()
    words = {i: (t or "").encode().lower().split() + [None] for i, t in rows}
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i in words}
    c = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    total, distinct = sum(c.values()), len(c)
    for r in got:
        ws = words[r.id]
        base = sum(np.log10((c[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        assert r.base_score == pytest.approx(base, abs=1e-6 * len(ws))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.id], len(ws), sum(c[w] > 0 for w in ws), total)
    new = [r for r in got if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in new) > sum(r.base_score for r in new)


def test_class_probabilities_sum_to_one():
    shape = lm.Shape(frequent=20, buckets=5, dimension=4)
    model = lm.Model(shape, np.full(shape.classes, 1 / shape.classes))
    model.learn(np.array([1, 2, 3]), np.array([0, 1, 2]), np.array([4, 5, 6]), np.random.default_rng(0))
    w = np.arange(shape.classes)
    p = 10 ** model.log10_classes(np.full(len(w), 3), np.full(len(w), shape.classes), w)
    assert p.sum() == pytest.approx(1)


def test_training_learns_a_grammar():
    shape = lm.Shape(frequent=6, buckets=1, dimension=6, noise=8, batch=64)
    model = lm.Model(shape, np.full(shape.classes, 1 / shape.classes))
    seqs = [np.array([1, 2, 3, 1, 2, 3, 1, 2, 3, 0])] * 400
    a, b, w = lm.contexts(seqs, shape.classes)
    rng = np.random.default_rng(1)
    for s in range(0, len(w), shape.batch):
        model.learn(a[s:s + shape.batch], b[s:s + shape.batch], w[s:s + shape.batch], rng)
    assert model.log10_classes(np.array([1]), np.array([3]), np.array([2]))[0] > np.log10(0.7)


def test_model_without_training_rows(docs_of):
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = lm.score_documents(docs_of([(held, "some words")])).first()
    assert r.held_out and r.n_known == 0 and r.train_tokens == 0 and np.isfinite(r.score)
    assert lm.score_documents(docs_of([])).count() == 0


# ------------------------------------------------------------ sharding
def first_best_fit(items, capacity):
    """Best fit decreasing with a plain scan."""
    left, place = [], {}
    for key, size in sorted(items, key=lambda x: (-x[1], x[0])):
        fits = [(r, b) for b, r in enumerate(left) if r >= size and r > 0]
        if fits:
            r, b = min(fits)
        else:
            b = len(left)
            left.append(capacity)
        left[b] -= size
        place[key] = b
    return place


def test_packing_equals_a_plain_scan():
    rng = random.Random(2)
    for _ in range(40):
        items = [(f"k{i}", rng.randrange(1, 60)) for i in range(rng.randrange(0, 80))]
        place, fill = sharding.best_fit_decreasing(items, 100)
        assert place == first_best_fit(items, 100)
        assert all(f <= 100 for f in fill)


def test_shards_are_even_whole_and_gapless(docs_of, corpus):
    rows = EDGES + [(i + 100, t) for i, t in corpus] + [(5000 + i, "copied text") for i in range(300)]
    got = sharding.shard_documents(docs_of(rows), shards=6).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    by = defaultdict(list)
    home = defaultdict(set)
    for r in got:
        by[r.shard].append(r)
        home[r.text or ""].add(r.shard)
        assert r.size == len((r.text or "").encode()) + 8
    assert all(len(s) == 1 for s in home.values())
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    total = sum(r.size for r in got)
    biggest = max(sum(r.size for r in got if (r.text or "") == t) for t in home)
    assert max(sum(r.size for r in v) for v in by.values()) <= max(biggest, 1.02 * total / 6)
    again = sharding.shard_documents(docs_of(rows), shards=6).collect()
    assert sorted((str(r.doc_id), r.shard, r.slot) for r in got) == sorted((str(r.doc_id), r.shard, r.slot) for r in again)


def test_small_groups_in_parcels_stay_even(docs_of):
    rows = [(i, "x" * (i % 50)  + str(i)) for i in range(3000)]
    got = sharding.shard_documents(docs_of(rows), shards=4, grain=8).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    assert max(sizes.values()) <= 1.1 * sum(sizes.values()) / 4
    assert sharding.shard_documents(docs_of([]), shards=4).count() == 0


@pytest.mark.parametrize("copies,long", [(1500, 0), (400, 0), (1500, 40)])
def test_oversized_groups_leave_the_other_shards_even(docs_of, copies, long):
    rows = [(i, f"own text {i:06d} " * 4) for i in range(3000)] + [(10_000 + i, "one copied text of some length " * 3) for i in range(copies)]
    rows += [(20_000 + i, "x" * 1000) for i in range(long)]  # a second group above the share that the first leaves
    got = sharding.shard_documents(docs_of(rows), shards=24).collect()
    assert len(got) == len(rows)
    sizes, texts = Counter(), defaultdict(set)
    for r in got:
        sizes[r.shard] += r.size
        texts[r.shard].add(r.text)
    assert set(sizes) == set(range(24))
    alone = {s for s, t in texts.items() if len(t) == 1}
    assert len(alone) == 1 + (long > 0)
    others = [v for s, v in sizes.items() if s not in alone]
    assert max(others) <= 1.03 * min(others)


def test_items_equal_or_fewer_than_the_bins_are_spread():
    assert sorted(sharding.pack_into([("a", 5), ("b", 5), ("c", 5)], 5).values()) == [0, 1, 2]
    assert sharding.pack_into([("a", 9)], 1) == {"a": 0}
    assert sharding.pack_into([], 3) == {}


# ------------------------------------------------------------ mixing
def targets_by_hand(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while True:
        rest = total - sum(target.values())
        w = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / w > 3 * sizes[s]] if w else []
        if not over:
            return {**target, **{s: rest * weight[s] / w for s in free}}
        for s in over:
            target[s] = 3.0 * sizes[s]
            free.discard(s)


def test_targets_are_the_resharing_fixed_point(spark):
    rng = random.Random(4)
    for _ in range(6):
        sizes = {s: rng.choice([0, 3, 50, 1000, 20_000]) for s in ["b", "a", "é", "Z", None, "c"]}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        want = targets_by_hand(sizes)
        assert got == pytest.approx(want)


def test_mixture_counts(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randrange(0, 40), None if i % 7 == 0 else ("hot" if i % 3 else f"s{i % 5}")) for i in range(3000)]
    rows += [(10_000, None, "hot"), (None, "a b", "hot"), (5, "dup row", "hot"), (5, "dup row", "hot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.plan_copies(docs).collect()
    assert len(got) == len(rows) and all(0 <= r.copies <= 3 for r in got)
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.copies * r["size"]
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= max(90, 0.02 * t) for s, t in target.items())
    again = mixing.plan_copies(docs.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.copies, r["size"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    mixture = mixing.mixed(docs)
    assert mixture.columns == docs.columns and mixture.count() == sum(r.copies for r in got)
    assert mixing.plan_copies(docs.limit(0)).count() == 0


def test_mixing_hides_clashing_columns(docs_of):
    out = mixing.mixed(docs_of([(1, "a b c"), (2, "d e")]))
    assert "size" not in out.columns or out.where("size = 7").count() == out.count()


# ------------------------------------------------------------ near dedup
def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components_by_hand(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            both = len(x & y)
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}, sets


def test_components_against_brute_force(docs_of, corpus):
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = [(i, t) for i, t in EDGES if i is not None] + [(i + 100, t) for i, t in corpus[:120]]
    for i in range(60):  # a chain: each is near the one before, the ends are not alike
        base = base[:]
        base[rng.randrange(120)] = f"n{i}"
        rows.append((1000 + i, " ".join(base)))
    for i in range(40):  # a shared passage that does not make documents near
        rows.append((2000 + i, " ".join(["shared passage of words here and there"] * 1 + [f"q{i}_{j}" for j in range(30)])))
    want, sets = components_by_hand(rows)
    got = {r.id: (r.n_shingles, r.component_id) for r in minhash.near_components(docs_of(rows)).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_near_dedup_edges(docs_of):
    rows = [(5, "one two three four five six"), (5, "one two three four five six"), (9, "One TWO three four five six"),
            (None, "one two three four five six"), (None, None), (11, ""), (12, "")]
    found = Counter((r.id, r.component_id) for r in minhash.near_components(docs_of(rows)).collect())
    assert found == Counter({(5, 5): 2, (9, 5): 1, (None, 5): 1, (None, None): 1, (11, 11): 1, (12, 12): 1})
    kept = minhash.near_dedup(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({5: 2, None: 2, 11: 1, 12: 1})
    assert minhash.near_components(docs_of([])).count() == 0
    from pyspark.sql import functions as F
    clash = docs_of(rows).withColumns({c: F.lit(c) for c in ("id", "gone_id", "component_id", "gone", "docs")})
    assert Counter(r.doc_id for r in minhash.near_dedup(clash).collect()) == Counter({5: 2, None: 2, 11: 1, 12: 1})
    assert minhash.near_dedup(clash).columns == clash.columns


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 2, 7, 400)]
    filled = minhash.sketch(sets)
    assert (filled != minhash.EMPTY).all()
    a = np.unique(rng.integers(0, 1 << 63, 1000).astype(np.uint64))
    b = np.concatenate([a[:850], np.unique(rng.integers(0, 1 << 63, 40).astype(np.uint64))])
    x, y = minhash.sketch([a, np.sort(b)])
    true = 850 / (len(a) + len(b) - 850)
    assert abs((x == y).mean() - true) < 0.06


def test_short_coordinates_count_differences(spark):
    rng = np.random.default_rng(4)
    docs = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 60)) for _ in range(6)]
    docs += [docs[0] + " more", docs[1].replace("w1", "v1")]
    filled = minhash.sketch(minhash.shingle_sets([d.encode() for d in docs]))
    rows = minhash.sketched(spark.createDataFrame(list(enumerate(docs)), "id long, text string"))
    words = rows.selectExpr("id", *[f"bits[{i}] AS w{i}" for i in range(minhash.LONGS)])
    x, y = words.alias("x"), words.alias("y")
    from pyspark.sql import functions as F
    for a, b, n in x.join(y).select(F.col("x.id"), F.col("y.id"), minhash.differing("x", "y")).collect():
        assert n == int(((filled[a] ^ filled[b]) & np.uint64(15) != 0).sum())
    assert minhash.most_differing(85) < 0.25 * minhash.COORDINATES


def test_contraction_of_a_long_chain(spark):
    n = 400
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "a long, b long")
    roots = defaultdict(set)
    for r in minhash.components(edges).collect():
        roots[r.root].add(r.id)
    assert sorted(map(len, roots.values())) == [2, n + 1]


# ------------------------------------------------------------ neighbours
def nearest_by_hand(ids, v, q, k=5):
    s = (v * v[q]).sum(axis=1) / (np.linalg.norm(v, axis=1) * np.linalg.norm(v[q]))
    other = [i for i in range(len(ids)) if ids[i] != ids[q]]
    return sorted(other, key=lambda i: (-s[i], ids[i]))[:k], s


def test_recall_and_scores(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, v = [r.vec_id for r in table], np.array([r.embedding for r in table], float)
    found = defaultdict(list)
    for r in ann.op10_multi_index(spark, sf_dir).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    hit = total = 0
    for q in (i for i, x in enumerate(ids) if x % 50 == 0):
        want, s = nearest_by_hand(ids, v, q)
        got = sorted(found[ids[q]])
        assert [g[0] for g in got] == [1, 2, 3, 4, 5]
        assert all(abs(g[2] - s[ids.index(g[1])]) < 1e-12 for g in got)
        hit += len({g[1] for g in got} & {ids[i] for i in want})
        total += 5
    assert hit >= 0.9 * total


def test_vectors_that_take_no_part_and_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    rows[10] = (10, rows[0][1])
    rows[20] = (20, rows[0][1])
    rows += [(100, None), (150, [0.0] * 8), (200, [float("nan")] * 8), (250, [1.0, None] + [0.0] * 6), (300, [1.0] * 3), (350, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.nearest(df, lambda i: i % 50 == 0).collect():
        got[r.query_id].append((r.rank, r.vec_id))
    assert set(got) == {0, 50}
    assert [v for _, v in sorted(got[0])][:2] == [10, 20]  # equal vectors: the smaller id first
    assert all(len(v) == 5 for v in got.values())


def test_fewer_candidates_than_wanted(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [(r.rank, r.vec_id) for r in ann.nearest(df, lambda i: i == 0).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert ann.nearest(df.limit(0), lambda i: i == 0).count() == 0
    assert ann.nearest(df.where("vec_id = 0"), lambda i: i == 0).count() == 0


def test_probing_finds_every_code_within_the_radius(spark):
    rng = np.random.default_rng(9)
    v = rng.normal(size=(300, 64))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    rotation = ann.learn_rotation(v)
    index = ann.coded(df, rotation)
    code = ann._codes(v, rotation)
    for radius in (1, 4):
        got = {(r.query_id, r.vec_id) for r in ann.search(index, index.where("id < 5"), 300, radius, 300, part_rows=64).collect()}
        want = {(q, i) for q in range(5) for i in range(300) if i != q
                and np.bitwise_count(code[q] ^ code[i]) <= 4 * radius + 3}
        assert got == want
