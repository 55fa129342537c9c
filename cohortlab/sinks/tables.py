"""Table sinks and layout (SNK1-SNK5).

* full refresh: ``mode("overwrite")`` is rerun-safe;
* integer-range partitioning: a derived bucket column ``floor((y - start) / step)``
  used with ``partitionBy``, so readers filtering on the year prune files;
* clustering: rows are range-partitioned by (bucket, cluster keys, row hash) and
  sorted within each file, so Parquet min/max statistics skip row groups; the
  hash splits a key that holds more rows than a task should;
* column comments are kept as field metadata and land in the catalog.

Full-refresh writers replace the whole table whatever the session's overwrite
mode is; only ``write_partitions`` keeps the partitions it does not touch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def range_bucket(year: str, start: int = 2003, end: int = 2019, step: int = 2) -> str:
    """Bucket index of ``RANGE_BUCKET(y, GENERATE_ARRAY(start, end, step))`` as expression text.

    Values below ``start`` get 0 and values at or above ``end`` get the last
    bucket, as the warehouse range partitioning does with its overflow
    partitions; NULL stays NULL.
    """
    n = (end - start) // step + 1
    return (f"CASE WHEN {year} IS NOT NULL THEN "
            f"cast(least(greatest(floor(({year} - {start}) / {step}) + 1, 0), {n}) as int) END")


def clustered(df: DataFrame, partition_cols: Sequence[str], cluster_cols: Sequence[str],
              num_partitions: int | None = None) -> DataFrame:
    """Lay rows out for pruning: range-partition by partition + cluster keys, sort in files.

    The row hash is the last range key: with few key tuples the rows still
    spread over all partitions, and a hot tuple is split.
    """
    keys = [*partition_cols, *cluster_cols]
    ranges = [*[F.col(f"`{k}`") for k in keys], F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    rp = df.repartitionByRange(num_partitions, *ranges) if num_partitions else df.repartitionByRange(*ranges)
    return rp.sortWithinPartitions(*keys)


def write_table(df: DataFrame, path: str, partition_cols: Sequence[str] = (),
                cluster_cols: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Full-refresh write (overwrite) with optional range partitioning and clustering."""
    out = clustered(df, partition_cols, cluster_cols) if cluster_cols else df
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(path)


def write_partitions(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments as field metadata (kept by ``saveAsTable``)."""
    return df.select(*[
        F.col(f"`{c}`").alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(f"`{c}`")
        for c in df.columns
    ])


def save_table(spark: SparkSession, df: DataFrame, name: str, comment: str | None = None,
               partition_cols: Sequence[str] = ()) -> None:
    """Managed-table full refresh; a table comment is set when given."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(name)
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS '{comment.replace(chr(39), chr(39) * 2)}'")


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
