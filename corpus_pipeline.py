"""A corpus pipeline over ``documents``: quality, line dedup, near dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame that is written as Parquet and read again as the next stage's
documents. All but the last return the columns of ``documents``.

Defined cases: a null or empty text has no words and goes in the first stage; a document
whose lines all repeat elsewhere stays with an empty text; rows that repeat an id are judged
alike and count as one document in both dedup stages; a document without id or source is kept
like others (its source is mixed as one of its own) and never keeps a shared line; extra columns pass
through all stages but the last, whatever their names; no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.bpe import digests
from cohortlab.llm.common import table, written
from cohortlab.llm.line_dedup import dedup_lines
from cohortlab.llm.minhash import near_dedup
from cohortlab.llm.mixing import mixed
from cohortlab.llm.quality import quality_filter

NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled cutoffs keep."""
    return quality_filter(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without the lines that others repeat; ``n_chars`` follows."""
    names = docs.columns
    kept = dedup_lines(docs).drop("text", "n_lines", "n_dropped").withColumnRenamed("kept_text", "text")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*[F.col(f"`{c}`") for c in names])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return near_dedup(docs, percent=NEAR_PERCENT)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: each document as often as the target weights ask, none to three times."""
    return mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of token ids and decoded bytes, a row per document of the mixture."""
    import public_tokenizers

    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", encoding_stage),
]

# Sketching and calibrated cutoffs are not expressible in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
