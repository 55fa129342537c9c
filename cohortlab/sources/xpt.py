"""SAS transport (XPT) landing source (SRC1).

Files are listed with the ``binaryFile`` source (one row per file) and
decoded inside Python workers with ``mapInPandas``; Spark spreads files over
tasks. A file is decoded whole, so the largest file bounds a task's memory;
survey files are at most a few hundred MB. Output columns are declared per
asset and every file is reindexed to them, so a column missing in one cycle
comes out NULL with the declared type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.sources.landing import CYCLES

# The XPT reader decodes a stored zero as a tiny positive number; anything
# this small is a zero.
ZERO_EPSILON = 1e-70


def _decoder(columns: Sequence[str]):
    cols = [c.upper() for c in columns]

    def decode(batches):
        import io

        import numpy as np
        import pandas as pd

        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                frame = pd.read_sas(io.BytesIO(bytes(content)), format="xport")
                frame.columns = [str(c).upper() for c in frame.columns]
                frame = frame.reindex(columns=cols).astype("float64")
                values = frame.to_numpy()
                values[np.abs(values) < ZERO_EPSILON] = 0.0
                out = pd.DataFrame(values, columns=cols)
                out = out.astype(object).where(out.notna(), None)
                out["SOURCE_PATH"] = path
                yield out

    return decode


def read_xpt(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Decode every XPT file under ``path`` into the declared double ``columns``."""
    schema = T.StructType([T.StructField(c.upper(), T.DoubleType(), True) for c in columns]
                          + [T.StructField("SOURCE_PATH", T.StringType(), True)])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[xX][pP][tT]").load(path)
    return files.select("path", "content").mapInPandas(_decoder(columns), schema)


def cycles_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, e, x) for s, e, x in CYCLES],
                                 "cycle_start_year bigint, cycle_end_year bigint, suffix string")


def read_xpt_asset(spark: SparkSession, path: str, asset_type: str, columns: Sequence[str]) -> DataFrame:
    """An XPT asset as a landing table: columns plus the six loader metadata columns.

    The cycle comes from the file code's suffix letter (``DEMO_C`` -> 2003-2004),
    joined against the 8-row cycle table (broadcast, bounded by construction).
    """
    raw = read_xpt(spark, path, columns)
    code = F.upper(F.regexp_extract("SOURCE_PATH", r"([^/]+)\.[xX][pP][tT]$", 1))
    tagged = raw.withColumn("FILE_CODE", code).withColumn(
        "suffix", F.regexp_extract(code, r"_([A-Z])$", 1))
    cyc = F.broadcast(cycles_frame(spark))
    out = tagged.join(cyc, "suffix", "left")
    return out.select(
        *[c.upper() for c in columns],
        F.col("cycle_start_year").alias("CYCLE_START_YEAR"),
        F.col("cycle_end_year").alias("CYCLE_END_YEAR"),
        F.concat(F.col("cycle_start_year").cast("string"), F.lit("-"),
                 F.col("cycle_end_year").cast("string")).alias("CYCLE_LABEL"),
        "FILE_CODE",
        F.lit(asset_type).alias("ASSET_TYPE"),
        F.col("SOURCE_PATH").alias("SOURCE_URL"),
    )
