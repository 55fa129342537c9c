"""Helpers shared by the training-data operators.

Conventions used by every operator of this subpackage:

* a document is a row with an id and a text; names of both are parameters;
* a null text is an empty text;
* input columns that carry the name of an output column are replaced by it;
* words are the maximal runs of ``[^\\x20\\x09-\\x0D]``; only A-Z are lower-cased.
  ``bytes.split`` and ``bytes.lower`` have exactly these two rules on UTF-8.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.session import checkpoint_dir

WORD_SQL = r"[^\\x20\\x09-\\x0D]+"
SPACE_BYTES = b" \t\n\x0b\x0c\r"
# Text handled at once inside a task; a longer single text is a slice of its own.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` less the columns whose names an operator is about to add."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def written(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back.

    Cuts the lineage, survives lost executors and keeps Spark from computing
    a Python stage once for each of its consumers.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def binary_list(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``limit`` text bytes (one row at least)."""
    if batch.num_rows == 0:
        return
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def scratch_name(what: str) -> str:
    return f"{what}_{os.getpid()}_{uuid.uuid4().hex[:12]}"
