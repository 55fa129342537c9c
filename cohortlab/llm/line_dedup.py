"""Line dedup by two Bloom filters (operator 4).

1. Every task hashes the line keys of its documents and sets bits in two
   filters: *once* (some document holds the key) and *twice* (a second one
   does). Tasks emit only the positions they set, by segment of the filter.
2. Segments are merged as streams, sorted by segment: a position that arrives
   a second time goes to *twice*. A merge task holds one segment at a time.
3. The *twice* filter has a fixed size (``filter_bits``, 16 MB by default), so
   it can be sent to all tasks. Each document is read again, and only keys that
   the filter suspects are shuffled; an exact count of documents per key
   confirms them and picks the document that keeps the line.
4. The confirmed keys go back to their documents by ``doc_id``.

False positives of the filter cost shuffle, never correctness; it has no false
negatives, so no repeated line is missed at any size.

Defined cases: a null or empty text is one empty line; an empty table gives an
empty result; rows that repeat an id count as one document; a null id is a
document of its own that never keeps a shared line; texts of any length are
whole; extra columns pass through, except those named like an output.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import SPACE_BYTES, binary_list, slices, table, without

SEGMENT_BITS = 1 << 20


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE_BYTES).lower()


def long_keys(text: bytes, min_chars: int) -> set[bytes]:
    """Distinct keys of at least ``min_chars`` code points."""
    keys = {line_key(x) for x in text.split(b"\n") if len(x) >= min_chars}
    return {k for k in keys if len(k) >= min_chars and len(k.decode("utf-8", "replace")) >= min_chars}


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Two filter positions of each hash, shape (n, 2)."""
    mask = np.uint64(bits - 1)
    second = (hashes >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    return np.stack([hashes & mask, (second >> np.uint64(24)) & mask], axis=1)


def _hashes(keys) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64)


def _bits_of_task(min_chars: int, bits: int):
    """Per task: the positions it saw once and those it saw twice, by segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for batch in batches:
            for part in slices(batch, "text"):
                for text in binary_list(part.column(0)):
                    if len(text) >= min_chars:
                        found.append(_hashes(long_keys(text, min_chars)))
        if not found:
            return
        keys, counts = np.unique(np.concatenate(found), return_counts=True)
        once = np.unique(_positions(keys, bits).ravel())
        # different keys of one task may also meet in a position: counted too
        alone = _positions(keys, bits).ravel()
        values, times = np.unique(alone, return_counts=True)
        twice = np.unique(np.concatenate([_positions(keys[counts > 1], bits).ravel(), values[times > 1]]))
        rows: dict[str, list] = {"segment": [], "once": [], "twice": []}
        for segment in np.unique(once // np.uint64(SEGMENT_BITS)):
            low, high = segment * np.uint64(SEGMENT_BITS), (segment + np.uint64(1)) * np.uint64(SEGMENT_BITS)
            rows["segment"].append(int(segment))
            for name, all_of in (("once", once), ("twice", twice)):
                part = all_of[np.searchsorted(all_of, low):np.searchsorted(all_of, high)] - low
                rows[name].append(zlib.compress(np.diff(part, prepend=np.uint64(0)).astype(np.uint32).tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["segment"], pa.int32()), pa.array(rows["once"], pa.binary()),
             pa.array(rows["twice"], pa.binary())], names=["segment", "once", "twice"])

    return run


def _unpack(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(blob), np.uint32), dtype=np.int64)


def _merge_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by segment; holds the two bit arrays of one segment."""
    now, once, twice = None, np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([now], pa.int32()), pa.array([zlib.compress(np.packbits(twice).tobytes(), 1)], pa.binary())],
            names=["segment", "twice"])

    for batch in batches:
        for segment, blob, blob2 in zip(*(c.to_pylist() for c in batch.columns)):
            if segment != now:
                if now is not None:
                    yield done()
                now = segment
                once[:] = False
                twice[:] = False
            at = _unpack(blob)
            twice[at[once[at]]] = True
            once[at] = True
            twice[_unpack(blob2)] = True
    if now is not None:
        yield done()


def repeated_filter(docs: DataFrame, text: str, min_chars: int, bits: int) -> dict[int, bytes]:
    """The *twice* filter by segment, compressed: at most ``bits`` / 8 bytes."""
    parts = docs.select(F.col(text).alias("text")).mapInArrow(
        _bits_of_task(min_chars, bits), "segment int, once binary, twice binary")
    merged = (parts.repartition("segment").sortWithinPartitions("segment")
              .mapInArrow(_merge_segments, "segment int, twice binary"))
    return {r["segment"]: r["twice"] for r in merged.collect()}


def suspects(docs: DataFrame, id_col: str, text: str, min_chars: int, bits: int) -> DataFrame:
    """(id, key) of every key that the filter takes for repeated, once per document row."""
    shared = docs.sparkSession.sparkContext.broadcast(repeated_filter(docs, text, min_chars, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.zeros(bits // 8, np.uint8)  # the filter as it is: one bit per position
        for s, b in shared.value.items():
            packed = np.frombuffer(zlib.decompress(b), np.uint8)
            twice[s * len(packed):(s + 1) * len(packed)] = packed
        for batch in batches:
            for part in slices(batch, "text"):
                ids, keys = [], []
                for i, blob in enumerate(binary_list(part.column(1))):
                    if len(blob) >= min_chars:
                        own = long_keys(blob, min_chars)
                        keys.extend(own)
                        ids.extend([i] * len(own))
                if not keys:
                    continue
                at = _positions(_hashes(keys), bits)
                set_bits = twice[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))
                hit = (set_bits & 1).all(axis=1)
                where = np.flatnonzero(hit)
                if len(where):
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(np.asarray(ids, np.int64)[where])),
                         pa.array([keys[i] for i in where], pa.binary())], names=["id", "key"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(
        run, f"id {kind}, key binary")


def lines_to_drop(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = 40,
                  min_docs: int = 5, filter_bits: int = 1 << 27) -> DataFrame:
    """(id, keys): the keys that a document loses; documents that lose none are absent."""
    if filter_bits & (filter_bits - 1) or not SEGMENT_BITS <= filter_bits <= 1 << 32:
        raise ValueError("filter_bits must be a power of two from 2^20 to 2^32")
    # once per document: the exchange is on (key, id), so a line that a third of
    # all documents holds is spread; its count then arrives pre-aggregated
    held = suspects(docs, id_col, text, min_chars, filter_bits).distinct()
    known = (held.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
             .where(F.col("n") >= min_docs).select("key", "keeper"))
    return (held.join(known, "key").where(~F.col("id").eqNullSafe(F.col("keeper")))
            .groupBy("id").agg(F.collect_list("key").alias("keys")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = 40,
                min_docs: int = 5, filter_bits: int = 1 << 27) -> DataFrame:
    """Documents with ``kept_text``, ``n_lines`` (before) and ``n_dropped`` added.

    A key of at least ``min_chars`` code points that ``min_docs`` documents hold
    loses all its lines except those of the largest id that holds it.
    """
    docs = without(docs, ("kept_text", "n_lines", "n_dropped"))
    drops = lines_to_drop(docs, id_col, text, min_chars, min_docs, filter_bits)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(id_col).alias("id"), F.col(text).alias("text"))
    joined = (rows.join(drops.withColumnRenamed("id", "drop_id"), F.col("id").eqNullSafe(F.col("drop_id")), "left")
              .select("row", "text", "keys"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                kept, before, lost = [], [], []
                for blob, keys in zip(binary_list(part.column(1)), part.column(2).to_pylist()):
                    lines = blob.split(b"\n")
                    stay = lines
                    if keys:
                        gone = set(keys)
                        stay = [x for x in lines if line_key(x) not in gone]
                    before.append(len(lines))
                    lost.append(len(lines) - len(stay))
                    kept.append(b"\n".join(stay) if keys else blob)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(before, pa.int64()),
                     pa.array(lost, pa.int64())], names=["row", "kept_text", "n_lines", "n_dropped"])

    row = joined.schema["row"].dataType.simpleString()
    out = joined.mapInArrow(run, f"row {row}, kept_text string, n_lines long, n_dropped long")
    return out.select("row.*", "kept_text", "n_lines", "n_dropped")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, l.pos, l.line,
         translate(trim(l.line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)),
                              lambda x, i: {'pos': i, 'line': x})) AS l FROM documents)),
shared AS (SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
           GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT n.doc_id, n.pos, n.line, (s.key IS NOT NULL AND n.doc_id <> s.keeper) AS gone
           FROM lines n LEFT JOIN shared s ON n.key = s.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
