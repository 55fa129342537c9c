"""N-gram Jaccard join by signature trees (operator 13).

Links documents whose sets of word shingles reach 100 * common >= percent * union, and
names their connected components. No link is lost: every step below is a proof of
exclusion, not an estimate.

**Roots.** Sets that may link differ in at most (a + b)(100 - percent) / (100 + percent)
shingles. Sizes fall into a ladder of ranges; a set stands in the forest of its own range
and, if it may link with larger sets of the next range, in that one too. In a range whose
sets may differ in k shingles, the hash space is cut into more than k parts: two sets that
link agree in some part entirely. So each tree of the forest holds the sets of one range with
one content of one part, and all its members are candidates of each other only.
An empty part counts as a content only for the rare sets with no more filled parts than
they may have differing shingles; for others a filled part must agree as well. Trees
with the same members are kept once, told by count, smallest id and two digests.

**Nodes.** A leaf holds up to 64 members with their bitmaps (4 to 8 bits per shingle), the OR of these,
the size range and the largest number of shingles that share a bit; inner nodes combine 16.
Shingles common to two members lie on common bits, so common bits plus shared bits, and the
sizes, bound the overlap of any pair below two nodes.

**Traversal.** First along the edges: in each leaf its most central member against the
others, and the leaves' central members among each other: at most one pair per member, so a
thousand near copies cost a thousand pairs. They are verified exactly and give components.
Then the dual traversal: pairs of nodes, from the roots down, are left where all
members are of one component, or sizes or the possible overlap exclude a link;
leaf pairs that remain compare members, and what remains there is verified exactly.

Large trees are split: members are dealt by hash into pieces of about 512, leaves are cut from
the pieces, only leaf summaries (a 64th of the rows) of one tree meet in a task, and
remaining leaf pairs spread over all tasks. Sets are 64-bit hashes, and only those in a shared
tree are built again and moved; they are stored by document, and pairs come to them. Joins of
sides that grow with the corpus are merge joins at every size.

Defined cases: null, empty or blank texts have an empty set and are linked with nothing;
fewer words than a shingle are one shingle; rows that repeat an id are one document, with
all its texts; a document without id is its own component unless an equal set has an id; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import binary_list, mix64, scratch_name, slices, table, written
from cohortlab.llm.minhash import components, shingle_sets
from cohortlab.session import checkpoint_dir

WORDS, PERCENT = 3, 90
LEAF, FAN, PIECE = 64, 16, 512
_ODD = np.uint64(0x9E3779B97F4A7C15)
_EMPTY_PART = np.uint64(0xD1B54A32D192ED03)


# ------------------------------------------------------------ roots
class Ladder:
    """Size ranges, the shingles that two sets of a range may differ in, and the parts."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        low = [1]
        while low[-1] < 1 << 40:
            low.append(max(low[-1] + 1, -(-low[-1] * 3 // 2), -(-low[-1] * 100 // percent)))
        self.low = np.asarray(low, np.int64)
        differ = self.differ(2 * (self.low[1:] - 1))
        # a few parts more than needed, so that sets whose filled parts might all differ are rare
        self.parts = np.where(differ > 0, differ + 2 + differ // 64, 0)

    def differ(self, both: np.ndarray) -> np.ndarray:
        """The most shingles in one of two linked sets only, by the sum of their sizes."""
        return both * (100 - self.percent) // (100 + self.percent)

    def levels(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own range, whether the next range is reached, and the most differing shingles."""
        own = np.searchsorted(self.low, sizes, side="right") - 1
        largest = sizes * 100 // self.percent
        return own, largest >= self.low[own + 1], self.differ(sizes + largest)


def tree_keys(sets: list[np.ndarray], ladder: Ladder) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the trees of all sets (sorted hashes), and the end of each set's keys."""
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    own, up, may = ladder.levels(np.maximum(sizes, 1))
    keys, owners = [], []
    for shift in (0, 1):
        level = own + shift
        parts = ladder.parts[level]
        takes = (sizes > 0) & (parts > 0) & (up if shift else True)
        at = np.nonzero(takes)[0]
        if not len(at):
            continue
        x = np.concatenate([sets[i] for i in at])
        doc = np.repeat(at, sizes[at])
        part = ((x >> np.uint64(32)) * parts[doc].astype(np.uint64)) >> np.uint64(32)
        new = np.ones(len(x), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (part[1:] != part[:-1])
        starts = np.nonzero(new)[0]
        place = mix64((level[doc[starts]].astype(np.uint64) << np.uint64(40)) | part[starts])
        keys.append(mix64(np.add.reduceat(mix64(x), starts) * _ODD ^ place))
        owners.append(doc[starts])
        filled = np.bincount(doc[starts], minlength=n)
        for i in at[filled[at] <= may[at]]:
            missing = np.setdiff1d(np.arange(parts[i], dtype=np.uint64), part[starts][doc[starts] == i])
            keys.append(mix64(mix64((np.uint64(level[i]) << np.uint64(40)) | missing) ^ _EMPTY_PART))
            owners.append(np.full(len(missing), i))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(keys)[order], np.cumsum(np.bincount(owner, minlength=n))


def rooted(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """id, n_shingles, digest, keys of every row of (id, text)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ladder = Ladder(percent)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(binary_list(part.column(1)), words)
                keys, ends = tree_keys(sets, ladder)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets], pa.binary()),
                    pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), keys.view(np.int64))],
                    names=["id", "n_shingles", "digest", "keys"])

    return docs.select("id", "text").mapInArrow(run, f"id {kind}, n_shingles long, digest binary, keys array<long>")


# ------------------------------------------------------------ bitmaps
def bitmap(x: np.ndarray) -> np.ndarray:
    """Bits of a set's hashes as 64-bit words; the width follows the size."""
    width = 64
    while width < 4 * len(x):
        width *= 2
    bits = np.zeros(width, np.uint8)
    bits[(x & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """The same set's bitmap in fewer words (last axis)."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def count(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=-1, dtype=np.int64)


def built_sets(docs: DataFrame, words: int) -> DataFrame:
    """id, n, set (sorted hashes) and bits of every row of (id, text)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(binary_list(part.column(1)), words)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([x.tobytes() for x in sets], pa.binary()),
                     pa.array([bitmap(x).tobytes() for x in sets], pa.binary())], names=["id", "n", "set", "bits"])

    return docs.select("id", "text").mapInArrow(run, f"id {kind}, n long, set binary, bits binary")


def stored_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """The sets of the ``wanted`` documents, in the shared folder, bucketed by id.

    Whatever is joined to them later by id comes to them; they don't move again.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = docs.repartition(n, "id").join(wanted.repartition(n, "id").hint("merge"), "id", "left_semi")
    name = scratch_name("llm_sets")
    (built_sets(asked.dropDuplicates(["id", "text"]), words).write.format("parquet").bucketBy(n, "id")
     .option("path", f"{checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name))
    return spark.table(name)


# ------------------------------------------------------------ nodes
def may_link(n1: np.ndarray, bits1: np.ndarray, n2: np.ndarray, bits2: np.ndarray, percent: int) -> np.ndarray:
    """Which members of one leaf may link with which of the other, shape (len(n1), len(n2))."""
    words = min(bits1.shape[1], bits2.shape[1])
    x, y = fold(bits1, words), fold(bits2, words)
    out = np.zeros((len(n1), len(n2)), bool)
    for i in range(len(n1)):
        common = count(x[i] & y)
        # bits of one set only hold at least one shingle that the other lacks
        overlap = np.minimum(n1[i] - (count(x[i]) - common), n2 - (count(y) - common))
        out[i] = overlap * (100 + percent) >= percent * (n1[i] + n2)
    return out


def leaves(members: DataFrame, percent: int, leaf: int = LEAF) -> DataFrame:
    """Leaves of (tree, piece, id, n, bits) rows, with the pairs along their edges.

    tree, leaf, lo, hi, slack, joined (OR of the bitmaps), ids, ns, bits, pivot (place
    of the central member), edges (places that may link with it).
    """
    kind = members.schema["id"].dataType.simpleString()
    dealt = members.repartition("tree", "piece").sortWithinPartitions("tree", "piece", "n", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None
        names = ["tree", "leaf", "lo", "hi", "slack", "joined", "ids", "ns", "bits", "pivot", "edges"]
        done: list[tuple] = []

        def close(tree: int, piece: int, number: int, ids: list, ns: list[int], blobs: list[bytes]) -> None:
            words = min(len(b) for b in blobs) // 8
            bits = np.stack([fold(np.frombuffer(b, np.uint64), words) for b in blobs])
            n = np.asarray(ns, np.int64)
            pivot = 0
            if len(ids) > 2:
                flat = np.unpackbits(bits.view(np.uint8), axis=1).astype(bool)
                central = np.packbits(2 * flat.sum(axis=0) > len(ids)).view(np.uint64)
                pivot = int(np.argmax(2 * count(bits & central) - count(bits)))
            near = may_link(n[[pivot]], bits[[pivot]], n, bits, percent)[0]
            near[pivot] = False
            done.append((tree, (piece << 32) | number, int(n.min()), int(n.max()), int((n - count(bits)).max()),
                         np.bitwise_or.reduce(bits, axis=0).tobytes(), ids, ns, bits.tobytes(), pivot,
                         np.nonzero(near)[0].tolist()))

        def batch_of() -> pa.RecordBatch:
            types = [pa.int64()] * 5 + [pa.binary(), pa.list_(id_type), pa.list_(pa.int64()), pa.binary(), pa.int32(), pa.list_(pa.int32())]
            made = pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(types)], names=names)
            done.clear()
            return made

        at, number, held = None, 0, ([], [], [])
        for batch in batches:
            id_type = batch.schema.field("id").type
            for tree, piece, key, n, bits in zip(*(batch.column(c).to_pylist() for c in ("tree", "piece", "id", "n", "bits"))):
                if at != (tree, piece) or len(held[0]) == leaf:
                    if held[0]:
                        close(*at, number, *held)
                    number = number + 1 if at == (tree, piece) else 0
                    at, held = (tree, piece), ([], [], [])
                held[0].append(key)
                held[1].append(n)
                held[2].append(bits)
            if done:
                yield batch_of()
        if held[0]:
            close(*at, number, *held)
            yield batch_of()

    return dealt.select("tree", "piece", "id", "n", "bits").mapInArrow(
        run, f"tree long, leaf long, lo long, hi long, slack long, joined binary, ids array<{kind}>, ns array<long>,"
             " bits binary, pivot int, edges array<int>")


class Node:
    """A node over leaf summaries: size range, shared bits, OR of bitmaps, component if there is one only."""

    __slots__ = ("lo", "hi", "slack", "joined", "root", "below", "leaf")

    def __init__(self, lo, hi, slack, joined, root, below=(), leaf=None):
        self.lo, self.hi, self.slack, self.joined, self.root = lo, hi, slack, joined, root
        self.below, self.leaf = below, leaf


def folded_to(node: Node, words: int) -> tuple[int, np.ndarray]:
    """Slack and bitmap in fewer words: bits that fall together count as shared by shingles."""
    bits = fold(node.joined, words)
    return node.slack + int(count(node.joined) - count(bits)), bits


def over(nodes: list[Node]) -> Node:
    """The root over leaf nodes, by ``FAN``."""
    while len(nodes) > 1:
        upper = []
        for i in range(0, len(nodes), FAN):
            part = nodes[i:i + FAN]
            words = min(len(x.joined) for x in part)
            roots = {x.root for x in part}
            narrow = [folded_to(x, words) for x in part]
            upper.append(Node(min(x.lo for x in part), max(x.hi for x in part), max(slack for slack, _ in narrow),
                              np.bitwise_or.reduce([bits for _, bits in narrow], axis=0),
                              roots.pop() if len(roots) == 1 else None, part))
        nodes = upper
    return nodes[0]


def excluded(x: Node, y: Node, percent: int) -> bool:
    if x.root is not None and x.root == y.root:
        return True
    if x.hi * 100 < percent * y.lo or y.hi * 100 < percent * x.lo:
        return True
    words = min(len(x.joined), len(y.joined))
    (s1, a), (s2, b) = folded_to(x, words), folded_to(y, words)
    overlap = min(int(count(a & b)) + min(s1, s2), x.hi, y.hi)
    return overlap * (100 + percent) < percent * (x.lo + y.lo)


def dual(root: Node, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of different leaves below ``root`` that may hold a link between components."""
    todo = [(root, root)]
    while todo:
        x, y = todo.pop()
        if x is y:
            # a node with itself: its children among each other; one component has no pair to find
            if x.root is None:
                todo += [(p, q) for i, p in enumerate(x.below) for q in x.below[i:] if p is not q or p.below]
            continue
        if excluded(x, y, percent):
            continue
        if not x.below and not y.below:
            yield x.leaf, y.leaf
        elif x.below and (not y.below or x.hi >= y.hi):
            todo += [(p, y) for p in x.below]
        else:
            todo += [(x, q) for q in y.below]


def leaf_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """(tree, x, y): pairs of leaves that the dual traversal leaves.

    ``nodes``: tree, leaf, lo, hi, slack, joined, root (a text; null: several).
    """
    dealt = nodes.repartition("tree").sortWithinPartitions("tree", "leaf")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, held = None, []

        def found() -> Iterator[pa.RecordBatch]:
            out = []
            for pair in dual(over(held), percent) if len(held) > 1 else ():
                out.append(pair)
                if len(out) == 65_536:
                    yield pairs_of(out)
                    out = []
            if out:
                yield pairs_of(out)

        def pairs_of(out) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([tree] * len(out), pa.int64()), pa.array([p[0] for p in out], pa.int64()),
                                               pa.array([p[1] for p in out], pa.int64())], names=["tree", "x", "y"])

        for batch in batches:
            for r in batch.to_pylist():
                if r["tree"] != tree:
                    yield from found()
                    tree, held = r["tree"], []
                held.append(Node(r["lo"], r["hi"], r["slack"], np.frombuffer(r["joined"], np.uint64), r["root"], leaf=r["leaf"]))
        yield from found()

    return dealt.select("tree", "leaf", "lo", "hi", "slack", "joined", "root").mapInArrow(run, "tree long, x long, y long")


def member_pairs(both: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of members of different components that may link.

    ``both``: ids, ns, bits, roots of one leaf and ids2, ns2, bits2, roots2 of another
    (null: the leaf with itself).
    """
    kind = both.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            id_type = batch.schema.field("ids").type.value_type
            for r in batch.to_pylist():
                same = r["ids2"] is None
                ids, ns, roots = r["ids"], np.asarray(r["ns"], np.int64), r["roots"]
                bits = np.frombuffer(r["bits"], np.uint64).reshape(len(ids), -1)
                ids2, ns2, roots2 = (ids, ns, roots) if same else (r["ids2"], np.asarray(r["ns2"], np.int64), r["roots2"])
                bits2 = bits if same else np.frombuffer(r["bits2"], np.uint64).reshape(len(ids2), -1)
                code = {x: i for i, x in enumerate(dict.fromkeys(roots + roots2))}
                may = may_link(ns, bits, ns2, bits2, percent)
                may &= np.asarray([code[x] for x in roots])[:, None] != np.asarray([code[x] for x in roots2])[None, :]
                if same:
                    may = np.triu(may, 1)
                for i, j in zip(*np.nonzero(may)):
                    x, y = ids[i], ids2[j]
                    a.append(min(x, y))
                    b.append(max(x, y))
            yield pa.RecordBatch.from_arrays([pa.array(a, id_type), pa.array(b, id_type)], names=["a", "b"])

    return both.select("ids", "ns", "bits", "roots", "ids2", "ns2", "bits2", "roots2").mapInArrow(run, f"a {kind}, b {kind}")


# ------------------------------------------------------------ join
def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets link.

    The set of b, which differs from row to row, is attached first: where one a has very many
    partners its rows are wide when they meet a's set, so a skewed partition shows and is split.
    """
    kind = pairs.schema["a"].dataType.simpleString()
    of = lambda end: sets.select(F.col("id").alias(end), F.col("set").alias(f"set_{end}")).hint("merge")
    both = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "set_a", "set_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for p, q in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, f"a {kind}, b {kind}")


def same_document(every: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of different texts under one id."""
    own = every.where(F.col("id").isNotNull() & F.col("digest").isNotNull()).select("id", "digest")
    several = own.groupBy("id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select("id", "lo")
    pairs = own.join(several, "id").where("digest <> lo").select("lo", "digest").distinct()
    reps = classes.select("digest", "rep")
    return (pairs.join(reps.select(F.col("digest").alias("lo"), F.col("rep").alias("a")), "lo")
            .join(reps.withColumnRenamed("rep", "b"), "digest").select("a", "b"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS,
                       percent: int = PERCENT, leaf: int = LEAF, piece: int = PIECE) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    every = written(rooted(docs, words, percent), "rooted")
    classes = every.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("id").alias("rep"), F.first("keys").alias("keys"))
    classes = written(classes.where(F.col("rep").isNotNull()), "classes")
    held = classes.select(F.col("rep").alias("id"), F.explode("keys").alias("tree"))
    shared = held.groupBy("tree").agg(F.count("*").alias("members"), F.min("id").alias("least"),
                                      F.bit_xor(F.xxhash64("id")).alias("d1"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("d2"))
    trees = written(shared.where("members > 1").groupBy("members", "least", "d1", "d2").agg(F.min("tree").alias("tree"))
                    .select("tree", "members"), "trees")
    members = written(held.join(trees.hint("merge"), "tree").select(
        "tree", "id", F.expr(f"pmod(xxhash64(id, 2), 1 + (members - 1) div {piece})").alias("piece")), "members")
    wanted = members.select("id").distinct()
    sets = stored_sets(docs, wanted, words)
    wide = members.join(sets.select("id", "n", "bits").hint("merge"), "id")
    nodes = written(leaves(wide, percent, leaf), "leaves")

    # along the edges
    spokes = nodes.select(F.expr("ids[pivot]").alias("a"), F.explode("edges").alias("e"), "ids").select("a", F.expr("ids[e]").alias("b"))
    pivots = nodes.select("tree", "leaf", F.expr("ids[pivot]").alias("b"))
    firsts = pivots.groupBy("tree").agg(F.min(F.struct("leaf", "b")).alias("top"), F.count("*").alias("n_leaves"))
    firsts = written(firsts.where("n_leaves > 1").select("tree", F.col("top.b").alias("a"), F.col("top.leaf").alias("top")), "large")
    rim = pivots.join(firsts, "tree").where(F.col("leaf") != F.col("top")).select("a", "b")
    edges = written(spokes.unionByName(rim).distinct(), "tree-edges")
    links = written(confirmed(edges, sets, percent).unionByName(same_document(every, classes)), "links")

    # between components
    names = components(links).select(F.col("id").alias("node"), F.col("root").cast("string").alias("root"))
    placed = nodes.select("tree", "leaf", F.posexplode("ids").alias("place", "id"))
    named = placed.join(names, F.col("id") == F.col("node"), "left").select(
        "tree", "leaf", "place", F.coalesce("root", F.col("id").cast("string")).alias("root"))
    inside = written(named.groupBy("tree", "leaf").agg(
        F.array_sort(F.collect_list(F.struct("place", "root"))).alias("p"), F.min("root").alias("r1"), F.max("root").alias("r2"))
        .select("tree", "leaf", F.transform("p", lambda x: x["root"]).alias("roots"), "r1", "r2"), "named")
    opened = inside.groupBy("tree").agg(F.min("r1").alias("t1"), F.max("r2").alias("t2"), F.sum(F.size("roots")).alias("m"),
                                          F.count("*").alias("n_leaves"))
    # the only pair of a tree of two has been looked at
    opened = written(opened.where("t1 <> t2 AND m > 2").select("tree", "n_leaves"), "open-trees")
    rest = nodes.join(inside.join(opened, "tree"), ["tree", "leaf"]).select(
        "tree", "leaf", "lo", "hi", "slack", "joined", "ids", "ns", "bits", "roots", "n_leaves",
        F.expr("CASE WHEN r1 = r2 THEN r1 END").alias("root"))
    rest = written(rest, "open-leaves")
    between = written(leaf_pairs(rest.where("n_leaves > 1").select("tree", "leaf", "lo", "hi", "slack", "joined", "root"), percent), "leaf-pairs")
    side = ["ids", "ns", "bits", "roots"]
    left = rest.select("tree", F.col("leaf").alias("x"), *side)
    right = rest.select("tree", F.col("leaf").alias("y"), *[F.col(c).alias(f"{c}2") for c in side])
    apart = between.join(left, ["tree", "x"]).join(right, ["tree", "y"]).select(*side, *[f"{c}2" for c in side])
    alone = rest.where("root IS NULL").select(*side, *[F.lit(None).cast(rest.schema[c].dataType).alias(f"{c}2") for c in side])
    pairs = member_pairs(alone.unionByName(apart), percent).distinct()
    seen = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = written(confirmed(pairs.join(seen, ["a", "b"], "left_anti"), sets, percent), "more-links")

    final = components(links.unionByName(more))
    smallest = final.groupBy("root").agg(F.min("id").alias("component"))
    ends = final.join(smallest, "root").select(F.col("id").alias("node"), "component")
    homes = (classes.select("digest", "rep").join(ends, F.col("rep") == F.col("node"), "left")
             .select(F.col("digest").alias("home"), F.coalesce("component", "rep").alias("component_id")))
    return (every.join(homes, F.col("digest") == F.col("home"), "left")
            .select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id")))


def op13_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
