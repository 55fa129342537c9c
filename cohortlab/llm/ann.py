"""Approximate nearest neighbours by multi-index hashing (operator 10).

Codes: a rotation learned on a bounded sample (principal axes, then iterative
quantisation) turns each unit vector into 64 signs. The code is cut into four
substrings of 16 bits and every vector is indexed under each of them.

Search: two codes within Hamming radius R = 4 r + 3 have a substring within r
(pigeonhole). A query is sent to the index parts whose substring prefix lies
within r of its own; in a part it probes the substring values within r, keeps
the codes within R, and reranks them by the exact cosine of the original
vectors. A pair that several substrings find is kept under the first only, so
each is reranked once. Parts emit their best k per query, and these are merged.

Radius: the distances of true neighbours are measured for a bounded sample of
queries against all rows, and r is the smallest that covers ``recall`` of them.
Queries that found fewer than k vectors are searched again with twice the radius,
at last with one that covers everything, so they return all there are.

Sizes: the prefix length follows the number of rows, a part that still holds
more than ``part_rows`` is salted, and queries go in blocks, so a group never
grows with the input; the counts of parts are at most 4 * 2^16 rows. A value
shared by a third of all codes is spread over its salts.

Defined cases: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part (as query or candidate); fewer
candidates than k: all; ties go to the smaller id; rows that repeat an id are
separate candidates except for a query of that id; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlab.llm.common import table, written

BITS, PARTS, WIDTH = 64, 4, 16
SAMPLE_ROWS = 20_000
SAMPLE_QUERIES = 256
QUERY_BLOCK = 32_768
POP16 = np.bitwise_count(np.arange(1 << WIDTH, dtype=np.uint32)).astype(np.uint8)


def usable(vectors: DataFrame, id_col: str, vec: str) -> DataFrame:
    """(id, v array<double>) of the vectors that take part."""
    v = F.col(vec).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("id").isNotNull()).where(F.expr(
        "v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
        " AND exists(v, x -> x <> 0)"))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (size["n"] if size else 0))


def learn_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = 30, seed: int = 5) -> np.ndarray:
    """Projection (dimension, bits): principal axes turned so that signs lose least."""
    rng = np.random.default_rng(seed)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    d = unit.shape[1]
    _, axes = np.linalg.eigh(unit.T @ unit)
    axes = axes[:, ::-1][:, :bits]
    out = []
    for _ in range(-(-bits // axes.shape[1])):  # short vectors: several rotations side by side
        y = unit @ axes
        turn = np.linalg.qr(rng.normal(size=(axes.shape[1], axes.shape[1])))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.where(y @ turn > 0, 1.0, -1.0).T @ y)
            turn = (u @ vt).T
        out.append(axes @ turn)
    return np.concatenate(out, axis=1)[:, :bits].reshape(d, bits)


def _codes(v: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    signs = (v @ rotation > 0).astype(np.uint8)
    return np.packbits(signs, axis=1, bitorder="little").view("<u8").ravel()


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def coded(vectors: DataFrame, rotation: np.ndarray) -> DataFrame:
    """(id, v, code) with the code as a signed 64-bit integer."""
    kind = vectors.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                code = _codes(_matrix(batch.column(1)), rotation)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code.view(np.int64))],
                                                 names=["id", "v", "code"])

    return vectors.mapInArrow(run, f"id {kind}, v array<double>, code long")


def _best(ids: np.ndarray, v: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and cosines of the k nearest of ``v``; ties to smaller ids."""
    # row-wise sums: equal vectors get equal scores wherever they lie
    score = (v * q).sum(axis=1) / (np.sqrt((v * v).sum(axis=1)) * np.sqrt((q * q).sum()))
    near = np.arange(len(score))
    if len(score) > k:
        near = np.flatnonzero(score >= np.partition(score, -k)[-k])
    order = near[np.lexsort((ids[near], -score[near]))][:k]
    return order, score[order]


def learn_radius(index: DataFrame, queries: DataFrame, k: int, recall: float) -> int:
    """Smallest r whose R = 4 r + 3 covers ``recall`` of a query sample's true neighbours."""
    sample = queries.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_QUERIES).collect()
    if not sample:
        return 0
    qid = [r["id"] for r in sample]
    qv = np.asarray([r["v"] for r in sample], float)
    qc = np.asarray([r["code"] for r in sample], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, v, code = batch.column(0).to_numpy(), _matrix(batch.column(1)), batch.column(2).to_numpy()
            rows: tuple[list, list, list] = ([], [], [])
            for i, q in enumerate(qid):
                other = np.flatnonzero(ids != q)
                at, score = _best(ids[other], v[other], qv[i], k)
                rows[0].extend([i] * len(at))
                rows[1].extend(score.tolist())
                rows[2].extend(np.bitwise_count((code[other[at]] ^ qc[i]).view(np.uint64)).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.float64()),
                                              pa.array(rows[2], pa.int32())], names=["q", "score", "distance"])

    near = index.select("id", "v", "code").mapInArrow(run, "q int, score double, distance int")
    top = near.withColumn("rank", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "distance"))).where(F.col("rank") <= k)
    distances = sorted(r["distance"] for r in top.select("distance").collect())  # at most SAMPLE_QUERIES * k
    if not distances:
        return 0
    need = distances[min(len(distances) - 1, int(np.ceil(recall * len(distances))) - 1)]
    return max(0, -(-(need - (PARTS - 1)) // PARTS))


def _masks(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` set."""
    if radius >= width:
        return list(range(1 << width))
    return [sum(1 << b for b in c) for n in range(radius + 1) for c in combinations(range(width), n)]


def _probe(radius: int, k: int, id_kind: pa.DataType):
    masks = np.asarray(_masks(WIDTH, radius), np.int64) if radius <= 3 else None
    widest = PARTS * radius + PARTS - 1

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            j = key[0].as_py()
            left, right = left.combine_chunks(), right.combine_chunks()
            ids, code = left.column("id").to_numpy(), left.column("code").to_numpy().view(np.uint64)
            v, qv = _matrix(left.column("v").chunk(0)), _matrix(right.column("q_v").chunk(0))
            subs = [((code >> np.uint64(WIDTH * i)) & np.uint64(0xFFFF)).astype(np.int64) for i in range(j + 1)]
            order = np.argsort(subs[j], kind="stable")
            values, starts = np.unique(subs[j][order], return_index=True)
            bounds = np.append(starts, len(order))
            for q, qcode, vec in zip(right.column("q_id").to_pylist(), right.column("q_code").to_numpy().view(np.uint64), qv):
                qs = [int(qcode >> np.uint64(WIDTH * i)) & 0xFFFF for i in range(j + 1)]
                if masks is not None and len(masks) < len(values):
                    want = qs[j] ^ masks
                    at = np.minimum(np.searchsorted(values, want), len(values) - 1)
                    hit = at[values[at] == want]
                else:  # fewer values are there than masks: probe those that are there
                    hit = np.flatnonzero(POP16[values ^ qs[j]] <= radius)
                if not len(hit):
                    continue
                n = bounds[hit + 1] - bounds[hit]
                total = np.cumsum(n)
                rows = order[np.repeat(bounds[hit] - (total - n), n) + np.arange(total[-1])]
                ok = (np.bitwise_count(code[rows] ^ qcode) <= widest) & (ids[rows] != q)
                for i in range(j):
                    ok &= POP16[subs[i][rows] ^ qs[i]] > radius
                rows = rows[ok]
                if len(rows):
                    at, score = _best(ids[rows], v[rows], vec, k)
                    found[0].extend([q] * len(at))
                    found[1].extend(ids[rows[at]].tolist())
                    found[2].extend(score.tolist())
        return pa.table([pa.array(found[0], id_kind), pa.array(found[1], id_kind), pa.array(found[2], pa.float64())],
                        names=["query_id", "vec_id", "score"])

    return run


def search(index: DataFrame, queries: DataFrame, rows: int, radius: int, k: int, part_rows: int = 32_768) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest within the radius."""
    spark = index.sparkSession
    kind = index.schema["id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32()}[kind]
    b = int(min(WIDTH, max(0, np.ceil(np.log2(max(1, rows) / part_rows)))))
    sub = F.expr(f"cast(shiftrightunsigned(code, cast(j * {WIDTH} AS int)) & 65535 AS int)")
    spread = lambda df: (df.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
                         .withColumn("prefix", F.shiftright(sub, WIDTH - b)))
    placed = spread(index)
    counts = written(placed.groupBy("j", "prefix").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("salts")), "parts")
    small = F.broadcast(counts)  # at most PARTS * 2^16 rows
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    placed = (placed.join(small, ["j", "prefix"]).withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
              .withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
              .select("j", "prefix", "salt", "qblock", "id", "v", "code"))
    masks = F.array(*[F.lit(m) for m in _masks(b, radius)]) if b and radius < b else F.sequence(F.lit(0), F.lit((1 << b) - 1))
    asked = (spread(queries).withColumn("mask", F.explode(masks))
             .withColumn("prefix", F.col("prefix").bitwiseXOR(F.col("mask"))).join(small, ["j", "prefix"])
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
             .withColumn("qblock", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
             .select("j", "prefix", "salt", "qblock", "id", "v", "code")
             .toDF("q_j", "q_prefix", "q_salt", "q_qblock", "q_id", "q_v", "q_code"))
    key = ["j", "prefix", "salt", "qblock"]
    found = placed.groupBy(*key).cogroup(asked.groupBy(*[f"q_{c}" for c in key])).applyInArrow(
        _probe(radius, k, arrow), f"query_id {kind}, vec_id {kind}, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vec: str = "embedding", k: int = 5,
            recall: float = 0.96) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query row."""
    rows = usable(vectors, id_col, vec)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v").collect()
    kind = rows.schema["id"].dataType.simpleString()
    if not sample:
        return rows.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    rotation = learn_rotation(np.asarray([r["v"] for r in sample], float))
    index = written(coded(rows, rotation), "codes")
    n = index.count()
    queries = index.where(is_query(F.col("id")))
    radius = learn_radius(index, queries, k, recall)
    result, left = None, queries
    while True:
        found = written(search(index, left, n, radius, k), "found")
        done = radius >= WIDTH
        full = found.groupBy("query_id").count().where(F.col("count") >= min(k, n - 1))
        found = found if done else found.join(full, "query_id", "left_semi")
        result = found if result is None else result.unionByName(found)
        if done:
            return result
        left = left.join(full, left.id == full.query_id, "left_anti")
        if left.isEmpty():
            return result
        radius = WIDTH if radius * 2 >= WIDTH else max(1, radius * 2)


def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0).select("query_id", "rank", "vec_id", "score")
