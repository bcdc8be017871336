"""Chat formatting by prefix-target expansion: one training example for each assistant turn.

A turn is written <s>[ROLE] text</s>. Inside roles and texts the escape character and the first characters of all
control strings are written as two characters (\\ as \\b, < as \\l, [ as \\k, ] as \\j), so no text can end a turn or
open another, and the escapes can be undone in any text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("[", "\\k"), ("]", "\\j"))
TARGET_ROLE = "assistant"
#: A null role is written as this; the escapes keep it apart from every role there can be.
NO_ROLE = "\\n"


def escape(text: Column) -> Column:
    for plain, code in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _written(turn: Column) -> Column:
    role = F.coalesce(escape(turn["role"]), F.lit(NO_ROLE))
    return F.concat(F.lit("<s>["), role, F.lit("] "), escape(turn["text"]), F.lit("</s>"))


def expand(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", target_role: str = TARGET_ROLE) -> DataFrame:
    """Training examples: conv_id, target (number of the trainable turn in its conversation, from 0), context, reply, tail.

    Every assistant turn is an example of its own. context holds all turns before it, reply the turn itself; only the
    reply's text is trainable: context + reply has loss on the characters from length(context) + length('<s>[assistant] ')
    to the last </s>. What follows the last assistant turn is an example without reply (target null), so
    nothing of a conversation is lost. Rows are ordered by turn, null last; rows that repeat a turn by role and text.
    Null texts count as empty; rows with a null conv_id form one conversation. A conversation is a unit of the
    format: its examples are made where its rows meet.
    """
    key = F.struct(F.col(turn_col).isNull().alias("last"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    turns = conversations.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(key)).alias("turns"))
    turns = turns.withColumn("written", F.transform("turns", _written)).withColumn("roles", F.transform("turns", lambda t: F.coalesce(t["role"] == target_role, F.lit(False))))
    n = F.size("turns")
    at = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get("roles", i))
    # without a reply: only if the last turn is no target
    tail = F.when(F.get("roles", n - 1), F.array().cast("array<int>")).otherwise(F.array(n))
    out = turns.select("conv_id", "written", n.alias("n"), F.explode(F.concat(at, tail)).alias("at"))
    context = F.array_join(F.slice("written", F.lit(1), F.col("at")), "")
    reply = F.when(F.col("at") < F.col("n"), F.get("written", F.col("at")))
    return out.select("conv_id", F.when(F.col("at") < F.col("n"), F.col("at")).alias("target"), context.alias("context"), reply.alias("reply"))


def formatted(examples: DataFrame) -> DataFrame:
    """The output rows: conv_id, target, text, loss_start, loss_end (half-open, in characters of text; null without reply)."""
    text = F.concat("context", F.coalesce("reply", F.lit("")))
    head = F.length("context") + F.instr("reply", "] ") + 1
    return examples.select("conv_id", "target", text.alias("text"), head.alias("loss_start"), (F.length(text) - F.length(F.lit("</s>"))).alias("loss_end")).withColumn("loss_end", F.when(F.col("loss_start").isNotNull(), F.col("loss_end")))


def read_turns(text: Column) -> Column:
    """The turns that a formatted text holds: array of struct(role, text), escapes undone."""
    pieces = F.filter(F.split(text, "</s>", -1), lambda p: p != "")
    role = lambda p: F.substring_index(F.substring(p, 5, 1 << 30), "] ", 1)
    return F.transform(pieces, lambda p: F.struct(F.when(role(p) != NO_ROLE, unescape(role(p))).alias("role"), unescape(F.substring(p, F.length(role(p)) + 7, F.length(p))).alias("text")))


def summary(rows: DataFrame) -> DataFrame:
    """What the formatted rows say about each conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The longest example of a conversation holds all its turns. formatted_chars counts all its examples.
    """
    reply = F.when(F.col("loss_start").isNotNull(), unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))))
    parts = rows.select("conv_id", F.length("text").alias("n"), "text", F.struct(F.col("target").alias("at"), reply.alias("reply")).alias("part"), "target")
    out = parts.groupBy("conv_id").agg(
        F.max_by("text", F.struct("n", F.coalesce("target", F.lit(1 << 30)))).alias("whole"),
        F.sort_array(F.collect_list(F.when(F.col("target").isNotNull(), F.col("part")))).alias("replies"),
        F.sum("n").alias("formatted_chars"),
    )
    loss = F.array_join(F.transform("replies", lambda r: r["reply"]), "")
    out = out.withColumn("turns", read_turns(F.col("whole"))).withColumn("loss", loss)
    script = F.array_join(F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(script.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), w AS (
  SELECT *, coalesce(role = 'assistant', false) AS hit, row_number() OVER o AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    length('<s>[' || coalesce(replace(replace(replace(replace(role, '\', '\b'), '<', '\l'), '[', '\k'), ']', '\j'), '\n') || '] ' || replace(replace(replace(replace(text, '\', '\b'), '<', '\l'), '[', '\k'), ']', '\j') || '</s>') AS long
  FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, text)
), s AS (SELECT *, sum(long) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM w)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (hit), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (hit), '')) AS loss_sha256,
  CAST(sum(CASE WHEN hit OR i = n THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""
