"""Chat formatting with DataFrame expressions only.

A conversation's turns are collected as structs, sorted by turn (ties: role, then text) and laid out as

    <|im_start|>ROLE \n TEXT <|im_end|> \n

Adjacent turns of one role are merged into one block whose texts stand apart by <|im_next|>. Inside texts and roles any
<, backslashes, | gets one more backslash before the |, so that no control string can occur there; taking one away
restores the text. In roles, backslash and line feed are written as two characters besides.

The result keeps the layout as segments (text, loss): their texts in order are the formatted string, and loss marks
exactly the assistants' texts.

Defined results: a null text or role is empty; a null turn sorts first; a null conv_id is a conversation of its own;
repeated rows are repeated turns; other columns of the input are left out; no rows give no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table

START, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>\n"
CONTROL = "<|im_end|><|im_start|>assistant ok"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\")
    return unescaped(F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\"))


def format_conversations(rows: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """rows: (conv_id, turn, role, text). (conv_id, formatted, segments)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def segments(t: Column, i: Column) -> Column:
        again = (i > 0) & (F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"] == t["role"])
        header = F.concat(F.when(i > 0, F.lit(END)).otherwise(F.lit("")), F.lit(START), escaped_role(t["role"]), F.lit("\n"))
        return F.array(
            F.struct(F.when(again, F.lit(NEXT)).otherwise(header).alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(t["text"]).alias("text"), (t["role"] == loss_role).alias("loss")),
        )

    closing = F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
    laid = turns.select("conv_id", F.concat(F.flatten(F.transform("turns", segments)), closing).alias("segments"))
    return laid.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns in a formatted string: array of (role, text)."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")

    def turns(block: Column) -> Column:
        body = F.substr(block, F.lit(len(START) + 1))
        role = F.substring_index(body, "\n", 1)
        texts = F.split(F.substr(body, F.length(role) + 2), r"<\|im_next\|>")
        return F.transform(texts, lambda x: F.struct(unescaped_role(role).alias("role"), unescaped(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = CONTROL.replace("'", "''")
    extra = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{control}'), (-1L, 1L, 'assistant', '{control}') AS t(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = format_conversations(rows).select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE_SQL = {
    "op2_chat_format": rf"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'),
r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
t AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (11 * count(DISTINCT 1) + sum(
     length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))
     + CASE WHEN before IS NOT DISTINCT FROM role THEN 11 ELSE
       13 + length(replace(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n'))
       + CASE WHEN before IS NULL THEN 0 ELSE 11 END END))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id"""
}
