"""Logged conversations: keep the maximal ones and render their turns.

A log that snapshots a conversation after every turn holds each prefix of it as a
conversation of its own. A rolling hash over turns makes "is a prefix of" an equality of
(last turn, hash), so two anti-joins on hashes find what to drop; texts take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEEDS = (11, 29)
# Turns of a conversation are hashed in blocks, so that one huge conversation is no single task.
BLOCK = 256


def _light(conversations: DataFrame) -> DataFrame:
    """Each distinct turn as (conv_id, turn, two hashes), without text."""
    role, text = F.col("role"), F.col("text")
    hashes = [F.xxhash64(F.lit(seed), role.isNull(), role, text.isNull(), text).alias(f"h{i}") for i, seed in enumerate(SEEDS)]
    return conversations.select("conv_id", F.coalesce(F.col("turn").cast("bigint"), F.lit(-1)).alias("turn"), *hashes).distinct()


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, p0, p1, last): hashes of everything up to a turn; ``last`` marks final turns."""
    at_turn = _light(conversations).groupBy("conv_id", "turn").agg(*[F.bit_xor(f"h{i}").alias(f"h{i}") for i in range(2)])
    at_turn = at_turn.select(
        "conv_id", "turn", F.floor(F.col("turn") / BLOCK).alias("block"),
        *[F.xxhash64(F.lit(seed), F.col("turn"), F.col(f"h{i}")).alias(f"h{i}") for i, seed in enumerate(SEEDS)],
    )
    blocks = at_turn.groupBy("conv_id", "block").agg(*[F.bit_xor(f"h{i}").alias(f"b{i}") for i in range(2)], F.max("turn").alias("block_end"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("conv_id").orderBy("block")
    blocks = blocks.select(
        F.col("conv_id").alias("c"), F.col("block").alias("k"), "block_end",
        *[F.coalesce(F.bit_xor(f"b{i}").over(earlier), F.lit(0).cast("bigint")).alias(f"b{i}") for i in range(2)],
        F.lead("block").over(ahead).isNull().alias("final"),
    )
    within = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    running = at_turn.select("conv_id", "block", "turn", *[F.bit_xor(f"h{i}").over(within).alias(f"r{i}") for i in range(2)])
    return running.join(blocks, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("k"))).select(
        "conv_id", "turn", *[F.col(f"r{i}").bitwiseXOR(F.col(f"b{i}")).alias(f"p{i}") for i in range(2)],
        (F.col("final") & (F.col("turn") == F.col("block_end"))).alias("last"),
    )


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """The ``conv_id`` of conversations that no other one continues; the smallest id of equal ones."""
    states = prefix_hashes(conversations)
    key = ["turn", "p0", "p1"]
    # Grouping sends each state once per task, however many conversations begin alike.
    continued = states.where(~F.col("last")).select(*key).distinct()
    whole = states.where("last").groupBy(*key).agg(F.min_by(F.struct("conv_id"), F.struct("conv_id")).alias("kept"))
    return whole.join(continued, key, "left_anti").select("kept.conv_id")


def _markup_free(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Maximal conversations, one row per distinct turn: ``conv_id``, ``turn``, ``role``, ``rendered``.

    A conversation is the set of its (turn, role, text); repeated rows count once. It is
    dropped if another one equals it up to its last turn and goes on, or if an equal one has
    a smaller ``conv_id`` (null is smallest; rows with a null id are one conversation). A
    null turn sorts before all others as turn -1. Null roles render as ``user``, null texts
    as nothing; they differ from each other in comparisons. ``<|`` in a text is broken up,
    so that only the template writes markers. Joining a conversation's rows by turn, role
    and text gives its whole rendering; rows stay apart so that long chats are no one cell.
    Further columns are left out.
    """
    kept = maximal_conversations(conversations).withColumnRenamed("conv_id", "kept_id")
    turns = conversations.select("conv_id", F.coalesce(F.col("turn").cast("bigint"), F.lit(-1)).alias("turn"), "role", "text")
    turns = turns.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")), "left_semi").distinct()
    role = F.regexp_replace(F.coalesce(F.col("role"), F.lit("user")), r"[^\p{L}\p{N}_-]", "_")
    return turns.select("conv_id", "turn", "role", F.concat(F.lit("<|"), role, F.lit("|>\n"), _markup_free(F.col("text")), F.lit("<|end|>\n")).alias("rendered"))


ORACLE = r"""
WITH turns AS (SELECT DISTINCT conv_id, coalesce(turn, -1)::BIGINT AS turn, role, text FROM conversations),
at_turn AS (
  SELECT conv_id, turn, string_agg(coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n'), chr(2) ORDER BY coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n')) AS body
  FROM turns GROUP BY conv_id, turn),
states AS (
  SELECT conv_id, turn, string_agg(turn || chr(3) || body, chr(4)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS body,
    lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) IS NULL AS last
  FROM at_turn),
whole AS (SELECT body, min(conv_id) AS conv_id FROM states WHERE last GROUP BY body),
kept AS (SELECT conv_id FROM whole WHERE body NOT IN (SELECT body FROM states WHERE NOT last))
SELECT t.conv_id, t.turn, t.role,
  '<|' || regexp_replace(coalesce(t.role, 'user'), '[^\p{L}\p{N}_-]', '_', 'g') || '|>' || chr(10) || replace(coalesce(t.text, ''), '<|', '< |') || '<|end|>' || chr(10) AS rendered
FROM turns t JOIN kept k ON t.conv_id IS NOT DISTINCT FROM k.conv_id
"""
