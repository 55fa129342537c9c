"""MinHash near-dedup with fast similarity sketching (operator 9).

1. Each document's set of word shingles gets a digest (equal sets are one class,
   represented by its smallest id), a fast similarity sketch, and from it 32 band
   keys of 5 coordinates and four bits of each of its 512 coordinates.
2. Star round: in each band bucket every class is paired with the bucket's
   smallest only. The pairs are verified exactly on full sets, and the verified
   links give components.
3. Rest: buckets whose members lie in several components still hide links.
   Only pairs of different components are considered there, and the join itself
   keeps a pair only if sizes and the short coordinates allow the threshold; these are
   verified as well. So a group of thousands of near copies costs one pair per
   member, and no pair inside a component is ever formed.
4. Links of both rounds give the final components by repeated contraction.

Chance of missing a link at the threshold: (1 - 0.85^5)^32, below one in 100
million for the bands (3 in a million at 0.8), and the short coordinates are cut five standard deviations below.

Sets are hashes of 64 bits; texts are read whole. Sets are built again only for
the classes that share a bucket, and only those texts move.

Defined cases: null, empty or blank texts have an empty set and are linked with
nothing; fewer words than a shingle are one shingle; rows that repeat an id are
one document; a document without id is its own component unless an equal set has
an id; an empty table gives an empty result; extra columns are ignored, and kept by
``near_dedup``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import binary_list, mix64, slices, table, written

WORDS = 5
# the bands use 160 of them; four bits of each tell unlike sets apart
COORDINATES = 512
LONGS = COORDINATES // 16
LOW_BITS = 0x1111111111111111
BANDS, ROWS = 32, 5
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    Fewer words than ``words``: the whole sequence is one shingle; no words: none.
    """
    known: dict[bytes, int] = {}
    code = known.setdefault
    split = [t.lower().split() for t in texts]
    flat = np.fromiter((code(w, len(known)) for ws in split for w in ws), np.int64)
    value = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known), np.uint64, len(known))
    h = value[flat] if len(flat) else np.zeros(0, np.uint64)
    n = len(h) - words + 1
    grams = np.zeros(0, np.uint64)
    if n > 0:
        grams = np.full(n, words, np.uint64)
        for j in range(words):
            grams = mix64(grams * _ODD ^ h[j:j + n])
    out, at = [], 0
    for ws in split:
        k = len(ws)
        if k >= words:
            out.append(np.unique(grams[at:at + k - words + 1]))
        elif k:
            one = np.full(1, k, np.uint64)
            for j in range(k):
                one = mix64(one * _ODD ^ h[at + j:at + j + 1])
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
        at += k
    return out


def sketch(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketching: ``t`` coordinates per set, shape (sets, t).

    Round i < t throws every element into a random bin and keeps the smallest
    (round, value) per bin; round t + j puts all elements into bin j. A set stops
    after the round that fills its last bin, so every coordinate of a set that
    is not empty is filled, most sets need one to three rounds, and two sets
    agree in a coordinate with probability of their Jaccard similarity, with
    Chernoff-type concentration over the coordinates.
    """
    n = len(sets)
    out = np.full(n * t, EMPTY, np.uint64)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    x = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(n), sizes)
    for i in range(2 * t):
        if not len(x):
            break
        y = mix64(x + mix64(np.full(1, i + 1, np.uint64))[0])
        bins = (y & np.uint64(0xFFFF)).astype(np.int64) % t if i < t else np.full(len(x), i - t)
        np.minimum.at(out, doc * t + bins, (np.uint64(i) << np.uint64(48)) | (y >> np.uint64(16)))
        open_sets = (out.reshape(n, t) == EMPTY).any(axis=1)
        stay = open_sets[doc]
        if not stay.all():
            x, doc = x[stay], doc[stay]
    return out.reshape(n, t)


def band_keys(sketches: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, shape (sets, bands)."""
    keys = np.empty((len(sketches), bands), np.uint64)
    for b in range(bands):
        k = np.full(len(sketches), b + 1, np.uint64)
        for c in range(b * rows, (b + 1) * rows):
            k = mix64(k * _ODD ^ sketches[:, c])
        keys[:, b] = k
    return keys


def sketched(docs: DataFrame) -> DataFrame:
    """id, n_shingles, digest, bands, bits of every row of (id, text)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(binary_list(part.column(1)))
                filled = sketch(sets)
                keys = band_keys(filled).view(np.int64)
                n = len(sets)
                places = np.uint64(4) * np.arange(16, dtype=np.uint64)
                bits = np.bitwise_or.reduce((filled & np.uint64(15)).reshape(n, LONGS, 16) << places, axis=2).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32), keys.ravel()),
                    pa.ListArray.from_arrays(np.arange(0, n * LONGS + 1, LONGS, dtype=np.int32), bits.ravel())],
                    names=["id", "n_shingles", "digest", "bands", "bits"])

    return docs.select("id", "text").mapInArrow(
        run, f"id {kind}, n_shingles long, digest binary, bands array<long>, bits array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """id, set (sorted 64-bit hashes as bytes) of every row of (id, text)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(binary_list(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x.tobytes() for x in sets], pa.binary())], names=["id", "set"])

    return docs.select("id", "text").mapInArrow(run, f"id {kind}, set binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach 100 * common >= percent * union.

    The sets of b come first: where one a leads many pairs, its rows are wide when they
    meet a's set, so a skewed partition shows by its size and is split.
    """
    kind = pairs.schema["a"].dataType.simpleString()
    both = (pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
            .join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
            .select("a", "b", "set_a", "set_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(2)[i].as_py(), np.uint64)
                y = np.frombuffer(batch.column(3)[i].as_py(), np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, f"a {kind}, b {kind}")


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node of the edges (a, b); a root per component.

    Every node is renamed to the neighbour (or itself) of smallest hash, the
    edges follow, and edges within a name vanish; hashes make the expected number
    of rounds logarithmic, also for long chains.
    """
    edges = written(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    names = written(edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
                    .select("id", F.col("id").alias("root")), "names")
    step = 0
    while not edges.isEmpty():
        step += 1
        ends = edges.select("a", "b").union(edges.select("b", "a"))
        to = (ends.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", F.lit(step)), "b")).alias("near"))
              .select(F.col("a").alias("old"), F.least(F.struct(F.xxhash64("a", F.lit(step)).alias("h"), F.col("a").alias("x")),
                      F.struct(F.col("near.col1").alias("h"), F.col("near.b").alias("x")))["x"].alias("new")))
        to = written(to, "renamed")
        names = written(names.join(to, names.root == to.old, "left").select("id", F.coalesce("new", "root").alias("root")), "names")
        left = edges.join(to, edges.a == to.old).select(F.col("new").alias("a"), "b")
        edges = written(left.join(to, left.b == to.old).select("a", F.col("new").alias("b"))
                        .where(F.col("a") != F.col("b")).distinct(), "edges")
    return names


def differing(x: str, y: str) -> Column:
    """The number of coordinates whose four bits differ, between rows ``x`` and ``y``."""
    out = F.lit(0)
    for i in range(LONGS):
        z = F.col(f"{x}.w{i}").bitwiseXOR(F.col(f"{y}.w{i}"))
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        out = out + F.bit_count(z.bitwiseOR(F.shiftrightunsigned(z, 2)).bitwiseAND(F.lit(LOW_BITS)))
    return out


def most_differing(percent: int, coordinates: int = COORDINATES, deviations: float = 5.0) -> int:
    """The most differing short coordinates that a pair at the threshold shows, but for 5 deviations."""
    p = (1 - percent / 100) * 15 / 16
    return int(np.ceil(coordinates * p + deviations * np.sqrt(coordinates * p * (1 - p))))


def near_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    all_of = written(sketched(docs), "sketches")
    classes = all_of.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = written(classes.where(F.col("rep").isNotNull()), "classes")
    held = classes.select(F.col("rep").alias("id"), "n", F.posexplode("bands").alias("band", "bucket"))
    # written, so that the join below has its own exchanges, whose skewed partitions can be split
    shared = written(held.groupBy("bucket").agg(F.min("id").alias("leader"), F.count("*").alias("members"))
                     .where(F.col("members") > 1), "shared")
    members = written(held.join(shared, "bucket").select("bucket", "band", "id", "n", "leader"), "members")
    star = members.where(F.col("id") != F.col("leader")).select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    wanted = members.select("id").distinct()
    sets = written(full_sets(docs.join(wanted, "id", "left_semi")), "sets")
    links = written(verified(star, sets, percent), "links")

    # buckets that still join several components
    names = components(links)
    named = members.join(names.withColumnRenamed("id", "node"), F.col("id") == F.col("node"), "left").select(
        "bucket", "band", "id", "n", F.coalesce("root", "id").alias("root"))
    # one member per component is enough to see that a bucket has several
    open_buckets = named.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket")
    bits = all_of.select(F.col("id").alias("bit_id"), "bits", "bands").where(F.col("bit_id").isNotNull())
    rest = named.join(open_buckets, "bucket")
    ids = rest.select("id").distinct()
    bits = bits.join(ids, F.col("bit_id") == F.col("id"), "left_semi")
    rest = written(rest.join(bits, F.col("id") == F.col("bit_id")).select(
        "bucket", "band", "id", "n", "root", "bands", *[F.col("bits")[i].alias(f"w{i}") for i in range(LONGS)]), "rest")
    x, y = rest.alias("x"), rest.alias("y")
    # a pair that shares several buckets is formed in the first of them only
    first = F.array_position(F.zip_with("x.bands", "y.bands", lambda p, q: p == q), True)
    pairs = (x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.id") < F.col("y.id"))
                    & (F.col("x.root") != F.col("y.root"))
                    & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent)
                    & (differing("x", "y") <= most_differing(percent)) & (first == F.col("x.band") + 1))
             .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())
    more = verified(pairs.join(star, ["a", "b"], "left_anti"), sets, percent)
    final = components(links.unionByName(more))
    smallest = final.groupBy("root").agg(F.min("id").alias("component_id"))
    ends = final.join(smallest, "root").select(F.col("id").alias("node"), F.col("component_id").alias("component"))
    homes = (classes.select("digest", "rep").join(ends, F.col("rep") == F.col("node"), "left")
             .select(F.col("digest").alias("home"), F.coalesce("component", "rep").alias("component_id")))
    return (all_of.join(homes, F.col("digest") == F.col("home"), "left")
            .select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """One document of each component: the one with the smallest id; also those without id and component."""
    found = near_components(docs, id_col, text, percent)
    gone = found.where(~F.col("id").eqNullSafe(F.col("component_id")) & F.col("id").isNotNull()).select("id").distinct()
    return docs.alias("docs").join(gone.alias("gone"), F.col(f"docs.`{id_col}`") == F.col("gone.id"), "left_anti")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_components(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
