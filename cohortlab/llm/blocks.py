"""Documents as coded blocks: the shared first step of encoding and LM scoring.

A block is a run of whole documents of about ``block_bytes`` of text. Its distinct
tokens form a local dictionary, and each document becomes the positions of its
tokens in that dictionary. Work on distinct tokens then needs one shuffle row
per (block, distinct token) instead of one per occurrence: occurrences are
pre-aggregated before anything moves.

The blocks are written once, bucketed by block id, to the shared folder.
Results for a block's dictionary come back hashed by block id, and the bucketed
blocks join them without being shuffled themselves.
"""

from __future__ import annotations

import os
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import binary_list, scratch_name, slices
from cohortlab.session import checkpoint_dir

BLOCK_BYTES = 16 << 20


def pack(codes: np.ndarray) -> bytes:
    """Compressed byte planes of small integers."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class _Open:
    """The block being filled."""

    def __init__(self) -> None:
        self.units: defaultdict[bytes, int] = defaultdict()
        self.units.default_factory = self.units.__len__
        self.seq: list[np.ndarray] = []
        self.ids: list = []
        self.flags: list[bool] = []
        self.size = 0

    def add(self, key, flag: bool, units: list[bytes], size: int) -> None:
        self.seq.append(np.fromiter(map(self.units.__getitem__, units), np.int32, len(units)))
        self.ids.append(key)
        self.flags.append(flag)
        self.size += size

    def close(self, split_unit: Callable[[bytes], list[bytes]] | None) -> dict:
        tokens: defaultdict[bytes, int] = defaultdict()
        tokens.default_factory = tokens.__len__
        n_units = [len(s) for s in self.seq]
        seq = np.concatenate(self.seq) if self.seq else np.zeros(0, np.int32)
        if split_unit is None:
            codes, ends = seq.astype(np.int64), np.cumsum(n_units)
            words = list(self.units)
        else:
            flat = array("q")
            start = np.zeros(len(self.units) + 1, np.int64)
            code = tokens.__getitem__
            for i, unit in enumerate(self.units):
                flat.extend(map(code, split_unit(unit)))
                start[i + 1] = len(flat)
            words = list(tokens)
            # a dictionary that counts by its own length refers to itself: without this only
            # the cyclic collector would free it, some blocks later
            tokens.default_factory = None
            tokens.clear()
            codes, ends = expand(np.array(flat, np.int64), start, seq, np.cumsum(n_units))
        self.units.default_factory = None
        self.units.clear()
        self.seq.clear()
        # frequent tokens get small numbers; equally frequent ones lie in their own
        # order, so their neighbours share prefixes and the lists compress
        times = np.bincount(codes, minlength=len(words))
        order = np.asarray(sorted(range(len(words)), key=words.__getitem__), np.int64)
        order = order[np.argsort(-times[order], kind="stable")]
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        codes = rank[codes]
        flags = np.asarray(self.flags, bool)
        per_doc = np.diff(np.concatenate([[0], ends])).astype(np.int64)
        counted = codes[np.repeat(flags, per_doc)]
        return {"block": int.from_bytes(os.urandom(8), "little") >> 1, "ids": self.ids, "flags": self.flags,
                "ends": ends.astype(np.int64), "codes": pack(codes), "words": [words[i] for i in order],
                "counts": np.bincount(counted, minlength=len(words)).astype(np.int64)}


def expand(flat: np.ndarray, start: np.ndarray, seq: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace each item of ``seq`` by its run in ``flat``; the ends move along."""
    length = np.diff(start)[seq]
    total = np.concatenate([[0], np.cumsum(length)])
    where = np.repeat(start[seq] - total[:-1], length) + np.arange(total[-1])
    return flat[where], total[np.asarray(ends, np.int64)]


def coded_blocks(docs: DataFrame, units_of: Callable[[bytes], list[bytes]],
                 split_unit: Callable[[bytes], list[bytes]] | None = None,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (id, flag, text) -> blocks, written to the shared folder.

    ``units_of`` cuts a text, ``split_unit`` cuts a distinct unit into tokens
    (none: units are tokens). ``counts``: occurrences in flagged documents.
    """
    spark = docs.sparkSession
    id_kind = docs.schema["id"].dataType.simpleString()
    id_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_kind]
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(id_arrow)), ("flags", pa.list_(pa.bool_())),
                        ("ends", pa.list_(pa.int64())), ("codes", pa.binary()), ("words", pa.list_(pa.binary())),
                        ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Open()

        def closed() -> pa.RecordBatch:
            done = block.close(split_unit)
            return pa.RecordBatch.from_arrays([pa.array([done[f.name]], f.type) for f in schema], schema=schema)

        for batch in batches:
            for part in slices(batch, "text"):
                for key, flag, blob in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                           binary_list(part.column(2))):
                    block.add(key, bool(flag), units_of(blob), len(blob) + 64)
                    if block.size >= block_bytes:
                        yield closed()
                        block = _Open()
        if block.ids:
            yield closed()

    blocks = docs.select("id", "flag", "text").mapInArrow(
        run, f"block long, ids array<{id_kind}>, flags array<boolean>, ends array<long>, codes binary,"
             " words array<binary>, counts array<long>")
    name = scratch_name("llm_blocks")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    (blocks.write.format("parquet").bucketBy(buckets, "block").option("path", path)
     .option("compression", "zstd").saveAsTable(name))
    return spark.table(name)


def dictionary(blocks: DataFrame) -> DataFrame:
    """(block, idx, word, n): the rows of all dictionaries."""
    return (blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("idx", "x"))
            .select("block", "idx", F.col("x.words").alias("word"), F.col("x.counts").alias("n")))
