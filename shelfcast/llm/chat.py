"""Operator 2: multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered once with
that speaker as the assistant and everybody else as a named user; system turns
stay system turns.  The result has one row per perspective and turn: the
rendered segment, its character offset in the rendered dialogue, and the span
that carries loss (the assistant's words and end marker).  Concatenating the
segments of a perspective by ``seq`` gives the whole dialogue, so no task ever
holds a dialogue as one value: running offsets are built in two levels, over
blocks of turns and then over block totals.

Edge cases: null text renders as empty; a null or blank speaker is called
``unknown`` and is a participant like any other; null turns sort first; equal
turns sort by speaker and text, and repeated rows are rendered each time; a
conversation of system turns only has no participant and gives no row; extra
columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
BLOCK = 1024  # turns whose offsets one window task sums


def rotate(df: DataFrame, conv: str = "conv_id", turn: str = "turn",
           speaker: str = "role", text: str = "text") -> DataFrame:
    name = F.trim(F.coalesce(F.col(speaker), F.lit("")))
    turns = df.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.when(name == "", "unknown").otherwise(name).alias("speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"))
    people = (turns.filter(F.col("speaker") != "system")
              .groupBy(F.col("conv_id").alias("_c"), F.col("speaker").alias("perspective"))
              .agg(F.lit(1).alias("_one")).drop("_one"))
    mine = F.col("speaker") == F.col("perspective")
    head = (F.when(F.col("speaker") == "system", "system\n").when(mine, "assistant\n")
            .otherwise(F.concat(F.lit("user name="), F.col("speaker"), F.lit("\n"))))
    out = (turns.join(people, turns["conv_id"].eqNullSafe(people["_c"])).drop("_c")
           .withColumn("trained", mine)
           .withColumn("_head", F.concat(F.lit(OPEN), head))
           .withColumn("segment", F.concat("_head", "_text", F.lit(CLOSE)))
           .withColumn("n_chars", F.length("segment").cast("long"))
           .withColumn("_block", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK)))
    key = ["conv_id", "perspective"]
    in_block = Window.partitionBy(*key, "_block").orderBy("turn", "speaker", "_text")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    out = (out.withColumn("_at", F.coalesce(F.sum("n_chars").over(before), F.lit(0)))
           .withColumn("_seq", F.row_number().over(in_block) - 1))
    blocks = out.groupBy(*key, "_block").agg(F.sum("n_chars").alias("_n"), F.count("*").alias("_k"))
    prior = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        *[F.col(c).alias(f"_b_{c}") for c in (*key, "_block")],
        F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_k").over(prior), F.lit(0)).alias("_k0"))
    same = (out["conv_id"].eqNullSafe(blocks["_b_conv_id"])
            & (out["perspective"] == blocks["_b_perspective"])
            & (out["_block"] == blocks["_b__block"]))
    start = F.col("_n0") + F.col("_at")
    return out.join(blocks, same).select(
        "conv_id", "perspective", (F.col("_k0") + F.col("_seq")).cast("long").alias("seq"),
        "turn", "speaker", "segment", start.cast("long").alias("start_char"), "n_chars", "trained",
        F.when(F.col("trained"), start + F.length("_head")).cast("long").alias("mask_start"),
        F.when(F.col("trained"), start + F.col("n_chars")).cast("long").alias("mask_end"))


ORACLE = """
WITH t AS (SELECT conv_id, turn,
             CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE trim(role) END AS speaker,
             coalesce(text, '') AS txt FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
s AS (SELECT t.conv_id, perspective, turn, speaker, txt, speaker = perspective AS trained,
        '<|im_start|>' || CASE WHEN speaker = 'system' THEN 'system'
             WHEN speaker = perspective THEN 'assistant'
             ELSE 'user name=' || speaker END || chr(10) AS head
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
x AS (SELECT *, head || txt || '<|im_end|>' || chr(10) AS segment FROM s),
y AS (SELECT *, CAST(length(segment) AS BIGINT) AS n_chars,
        CAST(row_number() OVER o - 1 AS BIGINT) AS seq,
        CAST(coalesce(sum(length(segment)) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_char
      FROM x WINDOW o AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, txt))
SELECT conv_id, perspective, seq, turn, speaker, segment, start_char, n_chars, trained,
       CASE WHEN trained THEN start_char + length(head) END AS mask_start,
       CASE WHEN trained THEN start_char + n_chars END AS mask_end FROM y
"""
