"""Mixing sources to target weights by systematic sampling (operator 6).

DataFrame functions only. Targets: sources in code-point order (null last) get
the weights 1, 2, 3 in turn and share the whole size; a target stops at
``max_repeat`` times the source's size and the excess goes to the others by
weight. That fixed point is a water level: ``min(weight * level, cap)``, found
from one prefix sum over the sources ordered by cap / weight.

Copies: each document of a source expects ``target / source size`` copies.
Along the source's documents the expected copies are summed up, one random
offset per source is added, and a document is emitted once per integer that its
step crosses. Documents are ordered by size class and hash, so the sample is
also balanced by size and the words taken come near the target.

The prefix sum is not one window per source: documents are counted in cells
(source, size class, hash byte), the cells' counts are summed up per source,
and only the rank inside a cell needs its rows together. A source with a third
of all rows is spread over thousands of cells.

Defined cases: a null text has size 0; a source of size 0 has target 0 and no
copies; a null source is a source, the last; a null or repeated id is ordered by
the text's hash; an empty table gives an empty result; offsets and order come from
hashes, so reruns agree. Input columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlab.llm.common import WORD_SQL, table, without

WEIGHTS = (1, 2, 3)
SEED = "mix-1"


def _number(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("double")


def source_targets(sizes: DataFrame, max_repeat: int = 3, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size) -> the same with ``target``; a row per source."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    ranked = sizes.withColumn("w", weight.cast("long"))
    fill = W.orderBy((F.col("source_size").cast("double") / F.col("w")), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    level = (ranked
             .withColumn("total", F.sum("source_size").over(W.partitionBy()))
             .withColumn("w_all", F.sum("w").over(W.partitionBy()))
             .withColumn("full", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * max_repeat)
             .withColumn("w_full", F.coalesce(F.sum("w").over(before), F.lit(0)))
             .withColumn("level", (F.col("total") - F.col("full")).cast("double")
                         / (F.col("w_all") - F.col("w_full")).cast("double"))
             # sources before the first one that stays under its cap are full
             .withColumn("free", F.col("level") * F.col("w") <= F.col("source_size") * max_repeat)
             # the level rises while full ones leave and falls from there on
             .withColumn("water", F.max(F.when(F.col("free"), F.col("level"))).over(W.partitionBy())))
    cap = (F.col("source_size") * max_repeat).cast("double")
    return level.select("source", "source_size",
                        F.when(F.col("water").isNull() | (F.col("water") * F.col("w") > cap), cap)
                        .otherwise(F.col("water") * F.col("w")).alias("target"))


def _planned(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
                max_repeat: int = 3, seed: str = SEED) -> DataFrame:
    """row (the document), size, source_size, target and ``copies`` (0 .. max_repeat)."""
    digest = F.md5(F.concat_ws("\x1f", F.lit(seed), F.col(id_col).cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    size = F.expr(f"cast(regexp_count(coalesce(`{text}`, ''), '{WORD_SQL}') as long)")
    # four classes for each doubling: sizes inside one differ by at most a quarter
    klass = F.expr("cast(CASE WHEN size < 1 THEN -1 ELSE length(bin(size)) * 4"
                   " + (shiftright(size, greatest(length(bin(size)) - 3, 0)) & 3) END AS int)")
    rows = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(source).cast("string").alias("source"), size.alias("size"), digest.alias("digest"))
            .withColumn("klass", klass).withColumn("cell", F.substring("digest", 1, 2)))
    cells = rows.groupBy("source", "klass", "cell").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    targets = source_targets(cells.groupBy("source").agg(F.sum("s").alias("source_size")), max_repeat)
    along = W.partitionBy("source").orderBy("klass", "cell").rowsBetween(W.unboundedPreceding, -1)
    start = cells.select("source", "klass", "cell", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("start"))
    cells_of = ["source", "klass", "cell"]
    placed = (start.join(targets.withColumnRenamed("source", "t_source"),
                         F.col("source").eqNullSafe(F.col("t_source")))
              .select(*[F.col(c).alias(f"c_{c}") for c in cells_of], "start", "source_size", "target"))
    rank = F.row_number().over(W.partitionBy(*cells_of).orderBy("digest"))
    joined = rows.withColumn("rank", rank).join(
        placed, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("klass") == F.col("c_klass"))
        & (F.col("cell") == F.col("c_cell")))
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _number(F.substring(F.md5(F.concat_ws("\x1f", F.lit(seed), F.coalesce("source", F.lit("(null)")))), 1, 12)) / float(16 ** 12)
    at = F.col("start") + F.col("rank")
    copies = (F.floor(step * at + offset) - F.floor(step * (at - 1) + offset)).cast("long")
    return joined.select("row", "size", "source_size", "target", copies.alias("copies"))


def plan_copies(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` with size, source_size, target and ``copies``."""
    docs = without(docs, ("size", "source_size", "target", "copies"))
    return _planned(docs, **kw).select("row.*", "size", "source_size", "target", "copies")


def mixed(docs: DataFrame, **kw) -> DataFrame:
    """The mixture itself: each document as often as its copies, with all its own columns."""
    plan = _planned(docs, **kw).where(F.col("copies") > 0)
    return plan.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return plan_copies(docs).select("doc_id", "size", "source_size", "target",
                                    (F.col("size") * F.col("copies")).alias("taken"))


MIX_CTES = r"""
sized AS (
  SELECT *, md5(concat_ws(chr(31), 'mix-1', doc_id::VARCHAR, md5(coalesce(text, '')))) AS digest,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM {docs}),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER f, 0))::DOUBLE
            / (sum(w) OVER () - coalesce(sum(w) OVER f, 0))::DOUBLE AS level
  FROM per_source
  WINDOW f AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, CASE WHEN water IS NULL OR water * w > source_size * 3 THEN (source_size * 3)::DOUBLE
                                   ELSE water * w END AS target
  FROM (SELECT *, max(CASE WHEN level * w <= source_size * 3 THEN level END) OVER () AS water FROM levels)),
ranked AS (
  SELECT s.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS step,
         ('0x' || substr(md5(concat_ws(chr(31), 'mix-1', coalesce(s.source, '(null)'))), 1, 12))::BIGINT::DOUBLE
           / 281474976710656.0::DOUBLE AS off,
         row_number() OVER (PARTITION BY s.source ORDER BY
           CASE WHEN size < 1 THEN -1 ELSE length(bin(size)) * 4
             + ((size >> greatest(length(bin(size)) - 3, 0)) & 3) END, digest) AS rk
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copied AS (SELECT *, (floor(step * rk + off) - floor(step * (rk - 1) + off))::BIGINT AS copies FROM ranked)
"""

OP6_SQL = "WITH " + MIX_CTES.replace("{docs}", "documents") + """
SELECT doc_id, size, source_size, target, size * copies AS taken FROM copied
"""
