"""Periodic runs of words (operator 12): descending-LCP Kruskal over suffix classes.

A run is a stretch of words with smallest period q, at least ``min_length`` words and
``times`` periods long, that no neighbouring word extends. It is found from
one pair of suffixes: the one at its start s and the one at s + q. Their longest
common prefix is the run's length less q, and no suffix between them shares as much.
So the suffixes are united by decreasing common prefix, each class keeps its positions
in order, and whenever a union makes two positions neighbours whose distance lies
within the common prefix, they seed a run: it starts at the left one if the words
before both differ, and its length is the common prefix plus the distance. Every run is
seeded once, with its smallest period.

Inside a task: a slice of texts is coded, documents in which no window of the shortest
useful common prefix (16 words at the default limits) occurs twice have no run and are
left out, the suffixes of the others are sorted together by prefix doubling, document
by document, and only neighbours in that order with a useful common prefix are united.
Classes merge small into large over blocked ordered lists, so a text of one
repeated word costs n log n as well. No shuffle: a text is a row.

Defined cases: a null, empty or blank text has no words and no runs; words compare
byte by byte; repeated rows, null ids and ties are rows like any other; an
empty table gives an empty result; extra columns are ignored. A text is one value of a
row, so one task holds it whole.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import binary_list, mix64, slices, table

MIN_LENGTH, TIMES = 24, 3
_ODD = np.uint64(0x9E3779B97F4A7C15)
Run = tuple[int, int, int]  # start, length, period


def least_common(min_length: int, times: int) -> int:
    """The shortest common prefix of a run's start and the place one period later."""
    return min(max(min_length, times * q) - q for q in range(1, min_length + 1))


class Positions:
    """An ordered set of integers in blocks: neighbours and insertion without moving all."""

    BLOCK = 1024

    def __init__(self, one: int) -> None:
        self.blocks = [[one]]
        self.first = [one]
        self.n = 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def around(self, x: int) -> tuple[int, int]:
        """The neighbours that ``x`` (not a member) would have; -1 for none."""
        k = bisect_right(self.first, x) - 1
        if k < 0:
            return -1, self.first[0]
        block = self.blocks[k]
        at = bisect_left(block, x)
        after = block[at] if at < len(block) else self.first[k + 1] if k + 1 < len(self.first) else -1
        return block[at - 1], after

    def add(self, x: int) -> None:
        k = max(bisect_right(self.first, x) - 1, 0)
        block = self.blocks[k]
        insort(block, x)
        self.first[k] = block[0]
        self.n += 1
        if len(block) > 2 * self.BLOCK:
            self.blocks[k:k + 1] = [block[:self.BLOCK], block[self.BLOCK:]]
            self.first.insert(k + 1, block[self.BLOCK])


def united(edges: Iterator[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Unite positions along (a, b, common) of decreasing ``common``.

    Yields (left, right, common) for every pair that a union makes neighbours.
    """
    home: dict[int, int] = {}
    sets: dict[int, Positions] = {}

    def find(a: int) -> int:
        if a not in home:
            home[a] = a
            sets[a] = Positions(a)
        root = a
        while home[root] != root:
            root = home[root]
        while home[a] != root:
            home[a], a = root, home[a]
        return root

    for a, b, common in edges:
        big, small = find(a), find(b)
        if big == small:
            continue
        if sets[big].n < sets[small].n:
            big, small = small, big
        into, moved = sets[big], list(sets.pop(small))
        home[small] = big
        for i, x in enumerate(moved):
            left, right = into.around(x)
            if left >= 0 and (i == 0 or moved[i - 1] < left):
                yield left, x, common
            if right >= 0 and (i + 1 == len(moved) or right < moved[i + 1]):
                yield x, right, common
        for x in moved:
            into.add(x)


def suffix_order(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of all documents in suffix order, document by document, and the ranks of
    their windows of 1, 2, 4, ... words (equal ranks: equal whole windows of one document).

    ``ends``: for each position, where its document ends.
    """
    n = len(codes)
    at = np.arange(n)
    rank = np.unique(ends * (codes.max() + 1) + codes, return_inverse=True)[1].astype(np.int64)
    levels, step = [rank.astype(np.int32)], 1
    while True:
        then = np.zeros(n, np.int64)
        inside = at + step < ends
        then[inside] = rank[at[inside] + step] + 1
        key = rank * (n + 1) + then
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        if rank[order[-1]] == n - 1:
            return order, levels
        levels.append(rank.astype(np.int32))
        step *= 2


def common_prefixes(a: np.ndarray, b: np.ndarray, ends: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` (of one document each pair) share."""
    n = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + n, b + n
        inside = (x < ends[a]) & (y < ends[b])
        same = np.zeros(len(a), bool)
        same[inside] = levels[k][x[inside]] == levels[k][y[inside]]
        n[same] += 1 << k
    return n


def suspects(codes: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Documents in which some window of ``window`` words (a power of two at most) occurs twice."""
    n = len(codes)
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    h, width = mix64(codes.astype(np.uint64)), 1
    while width * 2 <= window:
        h = h[:max(0, len(h) - width)] * _ODD ^ h[width:] if len(h) > width else h[:0]
        h = mix64(h)
        width *= 2
    if not len(h):
        return np.zeros(0, np.int64)
    whole = np.arange(len(h)) + width <= starts[1:][doc[:len(h)]]
    key = (doc[:len(h)][whole].astype(np.uint64) << np.uint64(40)) | (h[whole] >> np.uint64(24))
    key.sort()
    return np.unique((key[1:][key[1:] == key[:-1]] >> np.uint64(40)).astype(np.int64)) if n else np.zeros(0, np.int64)


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH, times: int = TIMES) -> list[list[Run]]:
    """The runs of each list of words, by start, then period."""
    out: list[list[Run]] = [[] for _ in texts]
    code: defaultdict[bytes, int] = defaultdict()
    code.default_factory = code.__len__
    sizes = [len(t) for t in texts]
    starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)
    codes = np.fromiter((code[w] for t in texts for w in t), np.int64, int(starts[-1]))
    least = least_common(min_length, times)
    found = suspects(codes, starts, least)
    if not len(found):
        return out
    parts = [codes[starts[d]:starts[d + 1]] for d in found]
    codes = np.concatenate(parts)
    begins = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    owner = np.repeat(np.arange(len(parts)), np.diff(begins))
    ends = begins[1:][owner]
    order, levels = suffix_order(codes, ends)
    a, b = order[:-1], order[1:]
    near = owner[a] == owner[b]
    deep = min(len(levels), least.bit_length()) - 1  # whole windows of 2^deep <= least words must agree
    near &= levels[deep][a] == levels[deep][b]
    a, b = a[near], b[near]
    common = common_prefixes(a, b, ends, levels)
    keep = np.nonzero(common >= least)[0]
    keep = keep[np.argsort(-common[keep], kind="stable")]
    edges = zip(a[keep].tolist(), b[keep].tolist(), common[keep].tolist())
    for left, right, shared in united(edges):
        d = right - left
        length = shared + d
        if d > shared or length < max(min_length, times * d):
            continue
        k = owner[left]
        if left > begins[k] and codes[left - 1] == codes[right - 1]:
            continue  # the same run started further left
        out[found[k]].append((int(left - begins[k]), length, d))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by spaces, of each run only its first period (less what others drop)."""
    if not runs:
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    kept = np.nonzero(np.cumsum(step[:-1]) == 0)[0]
    return b" ".join([words[i] for i in kept.tolist()])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
              times: int = TIMES, rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """id, runs array<struct<start, length, period>> and the collapsed text of every row.

    ``rewrite`` (id, words) -> words changes a document's words first.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = [t.split() for t in binary_list(part.column(1))]
                if rewrite is not None:
                    words = [rewrite(i, w) for i, w in zip(part.column(0).to_pylist(), words)]
                runs = runs_of(words, min_length, times)
                flat = [r for rs in runs for r in rs]
                ends = np.concatenate([[0], np.cumsum([len(rs) for rs in runs])]).astype(np.int32)
                columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0),
                     pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(columns, fields=list(run_type))),
                     pa.array([collapsed(w, rs) for w, rs in zip(words, runs)], pa.binary()).cast(pa.string())],
                    names=["id", "runs", "collapsed"])

    return docs.mapInArrow(run, f"id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def looped(key, words: list[bytes]) -> list[bytes]:
    """The contract's damage: every tenth document (by crc32 of its id) repeats a passage to its end.

    A document without id stays as it is.
    """
    if key is None or not words:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * (-(-(n - a) // p)))[:n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(docs, rewrite=looped)
    # greatest length / period, compared as fractions; runs come by start, then period
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda top, r: F.when(
        top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r).otherwise(top))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (found.withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", line), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
