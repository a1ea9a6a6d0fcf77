"""Preference formatting: common prompt once, then the two completions with their loss masks.

Chosen and rejected conversations are tables of turns. Turns found on both sides at the same place
meet in one grouping by their content; the first place (per pair) with a turn on one side only ends
the prompt. The result is one row per rendered turn, in order of (turn, tie): a pair of any length
is never gathered in one task, and each row carries its own mask.

Defined cases: rows without a pair_id take no part; exact repeats of a turn count once; other
turns that share a number follow each other by role and text (tie 0, 1, ...); a null turn number
comes first; a null role or text is rendered as nothing, and equals only null; equal conversations
give a prompt and no completion; a side without turns gives the other side's completion only; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuelake.llm.common import read

FIRST = -(1 << 63)
TRAINED = "assistant"


def header(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"))


END = "<|end|>\n"


def turns(rows: DataFrame, side: int) -> DataFrame:
    own = rows.select(F.col("pair_id").cast("long"), F.coalesce(F.col("turn").cast("long"), F.lit(FIRST)).alias("turn"), "role", "text").where("pair_id IS NOT NULL").distinct()
    tie = F.row_number().over(Window.partitionBy("pair_id", "turn").orderBy("role", "text")) - 1
    return own.select("*", tie.alias("tie"), F.lit(side).alias("side"))


def preference(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, part, turn, tie, role, rendered, train_start, train_end) from (pair_id, turn, role, text).

    part: prompt, chosen or rejected. The loss covers characters train_start to train_end of
    `rendered` (null: none): the assistant's words and the end mark, in completions only.
    """
    both = turns(chosen, 1).unionByName(turns(rejected, 2)).groupBy("pair_id", "turn", "tie", "role", "text").agg(F.bit_or("side").alias("sides"))
    ends = both.where("sides <> 3").groupBy("pair_id").agg(F.min(F.struct("turn", "tie")).alias("end"))
    told = both.join(ends, "pair_id", "left")
    shared = F.col("end").isNull() | (F.struct("turn", "tie") < F.col("end"))
    parts = F.when(shared, F.array(F.lit("prompt"))).when(F.col("sides") == 1, F.array(F.lit("chosen"))).when(F.col("sides") == 2, F.array(F.lit("rejected"))).otherwise(F.array(F.lit("chosen"), F.lit("rejected")))
    out = told.select("pair_id", F.explode(parts).alias("part"), "turn", "tie", "role", "text")
    head, body = header(F.col("role")), F.concat(F.coalesce("text", F.lit("")), F.lit(END))
    trained = (F.col("part") != "prompt") & (F.col("role") == TRAINED)
    return out.select(
        "pair_id", "part", F.when(F.col("turn") != FIRST, F.col("turn")).alias("turn"), F.col("tie").cast("long").alias("tie"), "role", F.concat(head, body).alias("rendered"),
        F.when(trained, F.length(head)).cast("long").alias("train_start"), F.when(trained, F.length(head) + F.length(body)).cast("long").alias("train_end"))


def with_foreign_reply(rows: DataFrame) -> DataFrame:
    """The conversations with their last assistant turn replaced by that of pair_id with its lowest
    bit flipped (no such reply: an empty one): rejected sides where no judgement is recorded."""
    last = rows.where((F.col("role") == TRAINED) & F.col("turn").isNotNull() & F.col("pair_id").isNotNull()).groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    donor = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("last.text").alias("reply"))
    told = last.select("pair_id", F.col("last.turn").alias("at")).join(donor, "pair_id", "left")
    text = F.when((F.col("turn") == F.col("at")) & (F.col("role") == TRAINED), F.coalesce("reply", F.lit(""))).otherwise(F.col("text"))
    return rows.join(told, "pair_id", "left").select("pair_id", "turn", "role", text.alias("text"))


def op2_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("pair_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return preference(rows, with_foreign_reply(rows))


SQL = f"""
WITH c AS (SELECT DISTINCT conv_id AS pair_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT pair_id, max(turn) AS last_turn FROM c WHERE role = '{TRAINED}' GROUP BY pair_id),
lt AS (SELECT pair_id, last_turn, max(text) AS reply FROM c JOIN l USING (pair_id) WHERE turn = last_turn AND role = '{TRAINED}' GROUP BY pair_id, last_turn),
r AS (
  SELECT DISTINCT c.pair_id, c.turn, c.role,
         CASE WHEN c.turn = lt.last_turn AND c.role = '{TRAINED}' THEN coalesce(d.reply, '') ELSE c.text END AS text
  FROM c LEFT JOIN lt USING (pair_id) LEFT JOIN lt d ON d.pair_id = xor(c.pair_id, 1)),
n AS (
  SELECT 'chosen' AS side, *, row_number() OVER (PARTITION BY pair_id, turn ORDER BY role NULLS FIRST, text NULLS FIRST) - 1 AS tie FROM c
  UNION ALL
  SELECT 'rejected', *, row_number() OVER (PARTITION BY pair_id, turn ORDER BY role NULLS FIRST, text NULLS FIRST) - 1 FROM r),
k AS (SELECT *, count(*) OVER (PARTITION BY pair_id, turn, tie, role, text) AS n_sides FROM n),
e AS (SELECT *, bool_and(n_sides = 2) OVER (PARTITION BY pair_id ORDER BY turn NULLS FIRST, tie RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS shared FROM k),
p AS (SELECT DISTINCT pair_id, CASE WHEN shared THEN 'prompt' ELSE side END AS part, turn, tie, role, text FROM e)
SELECT pair_id, part, turn, tie, role,
       '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS rendered,
       CASE WHEN part <> 'prompt' AND role = '{TRAINED}' THEN length(role) + 5 END AS train_start,
       CASE WHEN part <> 'prompt' AND role = '{TRAINED}' THEN length(role) + 5 + length(coalesce(text, '')) + 8 END AS train_end
FROM p
"""
