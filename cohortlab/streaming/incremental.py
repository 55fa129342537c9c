"""Incremental landing of mortality files (ING9).

The source is a yearly cron over idempotent full refreshes. Here new files are
picked up by a Structured Streaming file source with
``trigger(availableNow=True)``: each run processes only files not yet in the
checkpoint, then stops.

Rows are stored by (cycle, release, file). A micro-batch overwrites only the
partitions of its own files, so replaying it changes nothing, several files of a
release add up, and a release that arrives late never replaces a newer one:
:func:`latest_release` picks each cycle's newest when the table is read. Files
whose path names no cycle and release are skipped, or, by :func:`run_quarantining`,
set aside together with lines that cannot be parsed.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortlab.session import checkpoint_dir
from cohortlab.functions.bands import lit
from cohortlab.sinks.tables import write_partitions
from cohortlab.sources.ingest import MORTALITY_LINE_WIDTH, mortality_field_exprs

# Fixed value: the part of a file's path that names cycle and release.
FILE_PATTERN = r"_(\d{4})_(\d{4})_MORT_(\d{4})_PUBLIC"
LAYOUT = ("CYCLE_START_YEAR", "MORTALITY_PUBLIC_RELEASE_YEAR", "SOURCE_FILE")
QUARANTINE_LAYOUT = ("SOURCE_FILE",)


def raw_lines(spark: SparkSession, source_dir: str, glob: str = "*") -> DataFrame:
    """Streaming lines of all files with their paths; blank lines are no rows."""
    return (spark.readStream.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
            .load(source_dir).selectExpr("value", "_metadata.file_path AS path").where("trim(value) <> ''"))


def fault_expr(value: str = "value", path: str = "path") -> str:
    """Why a line cannot be landed, as SQL text; NULL for a good line."""
    return (f"CASE WHEN NOT {path} rlike {lit(FILE_PATTERN)} THEN 'file name' "
            f"WHEN length({value}) <> {MORTALITY_LINE_WIDTH} THEN 'line width' "
            f"WHEN try_cast(trim(substring({value}, 1, 14)) as double) IS NULL THEN 'respondent number' END")


def parsed(lines: DataFrame) -> DataFrame:
    """Mortality rows of (value, path) lines, with cycle and release from the path."""
    part = lambda i: f"regexp_extract(path, {lit(FILE_PATTERN)}, {i})"
    return lines.selectExpr(
        *mortality_field_exprs("value"),
        f"try_cast({part(1)} as bigint) AS CYCLE_START_YEAR",
        f"try_cast({part(2)} as bigint) AS CYCLE_END_YEAR",
        f"try_cast({part(3)} as bigint) AS MORTALITY_PUBLIC_RELEASE_YEAR",
        f"concat({part(1)}, '-', {part(2)}) AS CYCLE_LABEL",
        "sha1(path) AS SOURCE_FILE")


def mortality_stream(spark: SparkSession, source_dir: str, glob: str = "*") -> DataFrame:
    """Streaming DataFrame of parsed mortality rows; files whose path names no cycle are skipped."""
    return parsed(raw_lines(spark, source_dir, glob).where(f"path rlike {lit(FILE_PATTERN)}"))


def _counted_write(batch: DataFrame, target_dir: str, layout: Sequence[str]) -> int:
    seen = Observation()
    write_partitions(batch.observe(seen, F.count(F.lit(1)).alias("n")), target_dir, layout)
    return seen.get["n"]


def _run(stream: DataFrame, write: Callable[[DataFrame], None], checkpoint: str) -> None:
    """All new files in micro-batches, then stop."""
    (stream.writeStream.foreachBatch(lambda batch, _: write(batch)).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def run_incremental(spark: SparkSession, source_dir: str, target_dir: str,
                    checkpoint: str | None = None, glob: str = "*") -> int:
    """Process all new files once and stop; returns the number of rows written."""
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "mortality_incremental")
    written: list[int] = []
    _run(mortality_stream(spark, source_dir, glob),
         lambda batch: written.append(_counted_write(batch, target_dir, LAYOUT)), ckpt)
    return sum(written)


def run_quarantining(spark: SparkSession, source_dir: str, target_dir: str, quarantine_dir: str,
                     checkpoint: str | None = None, glob: str = "*") -> dict[str, int]:
    """:func:`run_incremental` that loses no line: what cannot be landed goes to a second table.

    A line is quarantined with its file, its text and the reason if the file's path
    names no cycle and release, if it is not ``MORTALITY_LINE_WIDTH`` characters wide, or
    if its respondent number is no number. Both sinks of a micro-batch are partitioned by
    file and replaced file by file, so a replayed batch changes neither; the batch is
    read once and kept on the executors' disks between the two writes. Returns the
    numbers of landed and quarantined lines.
    """
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "mortality_quarantining")
    done = {"landed": 0, "quarantined": 0}

    def write(batch: DataFrame) -> None:
        lines = batch.selectExpr("value", "path", f"{fault_expr()} AS reason").persist(StorageLevel.DISK_ONLY)
        try:
            done["landed"] += _counted_write(parsed(lines.where("reason IS NULL")), target_dir, LAYOUT)
            bad = lines.where("reason IS NOT NULL").selectExpr("path AS file", "value AS line", "reason", "sha1(path) AS SOURCE_FILE")
            done["quarantined"] += _counted_write(bad, quarantine_dir, QUARANTINE_LAYOUT)
        finally:
            lines.unpersist()

    _run(raw_lines(spark, source_dir, glob), write, ckpt)
    return done


def quarantined(spark: SparkSession, quarantine_dir: str) -> DataFrame:
    """file, line, reason of every line set aside."""
    return spark.read.schema("file string, line string, reason string, SOURCE_FILE string").parquet(quarantine_dir).drop("SOURCE_FILE")


def latest_release(spark: SparkSession, target_dir: str) -> DataFrame:
    """The landed rows of each cycle's newest release.

    The newest releases come from an aggregate with a row per cycle, which is
    why it may be broadcast.
    """
    rows = spark.read.parquet(target_dir)
    newest = rows.groupBy("CYCLE_START_YEAR").agg(F.max("MORTALITY_PUBLIC_RELEASE_YEAR").alias("MORTALITY_PUBLIC_RELEASE_YEAR"))
    keep = rows.join(F.broadcast(newest), ["CYCLE_START_YEAR", "MORTALITY_PUBLIC_RELEASE_YEAR"], "left_semi")
    return keep.drop("SOURCE_FILE").withColumns({c: F.col(c).cast("long") for c in LAYOUT[:2]})


def newest_releases(spark: SparkSession, target_dir: str) -> dict[int, int]:
    """Cycle start year -> newest landed release, from the partitions' names (a row per cycle)."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(target_dir)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return {}
    rows = spark.read.parquet(target_dir).groupBy("CYCLE_START_YEAR").agg(
        F.max("MORTALITY_PUBLIC_RELEASE_YEAR").alias("release")).where("CYCLE_START_YEAR IS NOT NULL")
    return {int(r["CYCLE_START_YEAR"]): int(r["release"]) for r in rows.collect()}
