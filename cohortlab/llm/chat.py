"""Chat formatting in budgeted windows (operator 8). DataFrame functions only.

Template: ``<|im_start|>role NEWLINE text <|im_end|> NEWLINE`` per turn. Inside roles and
texts a backslash becomes ``\\b``, ``<`` becomes ``\\l`` and ``[`` becomes ``\\s`` (in
roles a line feed ``\\n``): no control string of this or of the bracket style can
appear in a turn, and because each backslash is followed by its code letter two
or three plain replacements undo it.

Windows: the turns' tokens are summed up along the conversation and a turn
belongs to the stripe of half a budget in which it ends, so a window's own turns
stay within the budget unless one turn alone is longer than half of it. Each
window starts with the conversation's system turn and repeats up to
``history_turns`` turns that precede it; repeated turns carry no loss. New
assistant turns are the targets.

The prefix sum runs in two levels (chunks of turns, then the chunks' totals),
and windows are assembled per (conversation, window): no step needs a whole
conversation together, except the reader that rebuilds it for its digest.

Defined cases: null role and text are empty; turns are ordered by turn (null
last), role, text; repeated rows are turns of their own; a null conv_id is a
conversation; an empty table gives no windows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlab.llm.common import table

START, END = "<|im_start|>", "<|im_end|>\n"
TOKENS_SQL = r"regexp_count({text}, '[^\\x20\\x09-\\x0D]+') + 4"
CHUNK = 1024


def escape(c: Column, role: bool = False) -> Column:
    c = F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\s"))
    return F.replace(c, F.lit("\n"), F.lit("\\n")) if role else c


def unescape(c: Column, role: bool = False) -> Column:
    c = F.replace(c, F.lit("\\n"), F.lit("\n")) if role else c
    return F.replace(F.replace(F.replace(c, F.lit("\\s"), F.lit("[")), F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (0-based), role, text, tokens, upto (prefix sum with the turn)."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tokens", F.expr(TOKENS_SQL.format(text="text")).cast("long"))
    # chunks by turn number: consecutive turns, however many a conversation has
    rows = rows.withColumn("chunk", F.floor(F.col("turn") / CHUNK))
    inside = W.partitionBy("conv_id", "chunk").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    rows = rows.withColumn("at", F.row_number().over(inside) - 1).withColumn(
        "sum_in", F.sum("tokens").over(inside.rowsBetween(W.unboundedPreceding, 0)))
    chunks = rows.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"), F.sum("tokens").alias("s"))
    before = W.partitionBy("conv_id").orderBy(F.col("chunk").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    starts = chunks.select(F.col("conv_id").alias("c_conv"), F.col("chunk").alias("c_chunk"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
                           F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s0"))
    joined = rows.join(starts, F.col("conv_id").eqNullSafe(F.col("c_conv")) & F.col("chunk").eqNullSafe(F.col("c_chunk")))
    return joined.select("conv_id", (F.col("n0") + F.col("at")).cast("long").alias("pos"), "role", "text", "tokens",
                         (F.col("s0") + F.col("sum_in")).alias("upto"))


def format_windows(turns: DataFrame, budget: int = 2048, history_turns: int = 2) -> DataFrame:
    """One row per window: conv_id, window, formatted, segments.

    ``segments`` lists the turns in order: pos, begin and length (code points of
    the escaped role and text in ``formatted``), repeated, loss.
    """
    stripe = max(1, budget // 2)
    rows = numbered_turns(turns).withColumn("window", F.floor((F.col("upto") - 1) / stripe).cast("long"))
    # a system turn is a conversation's turn 0; at most one row per conversation
    system = rows.where((F.col("pos") == 0) & (F.col("role") == "system"))
    first = rows.groupBy("conv_id", "window").agg(F.min("pos").alias("first"))
    # history: a turn is repeated in a later window that starts within the next
    # history_turns turns; windows without turns of their own do not exist
    near = rows.select("conv_id", "pos", "role", "text", F.explode(
        F.sequence(F.col("pos") + 1, F.col("pos") + history_turns)).alias("first")) if history_turns > 0 else None
    parts = [rows.select("conv_id", "window", "pos", "role", "text", F.lit(False).alias("repeated"))]
    starts = first.select(F.col("conv_id").alias("f_conv"), "window", "first")
    if near is not None:
        near = near.withColumnRenamed("first", "follows")
        parts.append(near.join(starts, near.conv_id.eqNullSafe(F.col("f_conv")) & (F.col("follows") == F.col("first"))
                               & (F.col("first") > 0))
                     # the system turn is added below
                     .where(~((F.col("pos") == 0) & (F.col("role") == "system")))
                     .select("conv_id", "window", "pos", "role", "text", F.lit(True).alias("repeated")))
    parts.append(system.drop("window").join(starts, system.conv_id.eqNullSafe(F.col("f_conv")) & (F.col("first") > 0))
                 .select("conv_id", "window", "pos", "role", "text", F.lit(True).alias("repeated")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    role, text = escape(F.col("role"), True), escape(F.col("text"))
    turn = F.struct("pos", role.alias("role"), text.alias("text"), "repeated",
                    ((F.col("role") == "assistant") & ~F.col("repeated")).alias("loss"))
    windows = every.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    formatted = F.concat_ws("", F.transform("turns", lambda t: F.concat(
        F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END))))
    head, tail = len(START), len(END)
    # begins by a running sum over the window's turns
    ends = F.aggregate(
        "turns", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(
            "array<struct<pos:bigint,role_at:bigint,role_len:bigint,text_at:bigint,text_len:bigint,repeated:boolean,loss:boolean>>").alias("out")),
        lambda acc, t: F.struct(
            (acc["at"] + head + F.length(t["role"]) + 1 + F.length(t["text"]) + tail).cast("long").alias("at"),
            F.array_append(acc["out"], F.struct(
                t["pos"].alias("pos"), (acc["at"] + head).cast("long").alias("role_at"),
                F.length(t["role"]).cast("long").alias("role_len"),
                (acc["at"] + head + F.length(t["role"]) + 1).cast("long").alias("text_at"),
                F.length(t["text"]).cast("long").alias("text_len"),
                t["repeated"].alias("repeated"), t["loss"].alias("loss"))).alias("out")))["out"]
    return windows.select("conv_id", "window", formatted.alias("formatted"), ends.alias("segments"))


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, pos, role, text, loss of every turn, cut out of ``formatted``."""
    cut = lambda at, n: F.expr(f"substring(formatted, cast(s.{at} + 1 AS int), cast(s.{n} AS int))")
    return (windows.select("conv_id", "formatted", F.explode("segments").alias("s")).where(~F.col("s.repeated"))
            .select("conv_id", F.col("s.pos").alias("pos"), unescape(cut("role_at", "role_len"), True).alias("role"),
                    unescape(cut("text_at", "text_len")).alias("text"), F.col("s.loss").alias("loss")))


SPECIAL = "</s>[INST] ok [/INST]"


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", SPECIAL), (-1, 1, "assistant", SPECIAL)],
                                  "conv_id long, turn long, role string, text string")
    windows = format_windows(given.unionByName(extra))
    sizes = windows.groupBy("conv_id").agg(F.sum(F.length("formatted")).cast("long").alias("formatted_chars"))
    back = read_back(windows).groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("pos", "role", "text", "loss"))).alias("turns"))
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    loss = F.concat_ws("", F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]))
    digests = back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                          F.sha2(whole, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
                          F.sha2(loss, 256).alias("loss_sha256"))
    sizes = sizes.withColumnRenamed("conv_id", "s_conv")
    return (digests.join(sizes, F.col("conv_id").eqNullSafe(F.col("s_conv")))
            .select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"))


OP8_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
numbered AS (
  SELECT *, row_number() OVER o - 1 AS pos,
         sum(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4) OVER o AS upto
  FROM given WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text ROWS UNBOUNDED PRECEDING)),
sized AS (
  SELECT *, (upto - 1) // 1024 AS win,
         12 + 1 + 11 + length(role) + length(text)
         + (length(text) - length(replace(replace(replace(text, chr(92), ''), '<', ''), '[', '')))
         + (length(role) - length(replace(replace(replace(replace(role, chr(92), ''), '<', ''), '[', ''), chr(10), ''))) AS chars
  FROM numbered),
firsts AS (SELECT conv_id, win, min(pos) AS first FROM sized GROUP BY conv_id, win),
again AS (
  SELECT f.conv_id, sum(s.chars) AS chars
  FROM firsts f JOIN sized s ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.first > 0
    AND ((s.pos >= f.first - 2 AND s.pos < f.first) OR (s.pos = 0 AND s.role = 'system'))
  GROUP BY f.conv_id),
own AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
         coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
         sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
         sum(chars) AS chars
  FROM sized GROUP BY conv_id)
SELECT o.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, (o.chars + coalesce(a.chars, 0))::BIGINT AS formatted_chars
FROM own o LEFT JOIN again a ON o.conv_id IS NOT DISTINCT FROM a.conv_id
"""
