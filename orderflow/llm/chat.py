"""Chat formatting after a cumulative-snapshot collapse.

A chat that is logged after every answer leaves snapshots that are prefixes of its
last state. Each turn gets a rolling hash of the conversation up to it: the sum of
two 64-bit hashes of (position, role, text). A conversation whose last hash is a
proper prefix hash of another is dropped by an anti-join; of equal conversations
the smallest id stays. The remaining ones, all maximal, are rendered.

The collapse moves only ids and hashes. Hash keys of common first turns or common
conversations are made distinct before they meet. Texts are shuffled once, by
conversation, and only those of maximal conversations.

Defined cases: turns are ordered by (turn, role, text), nulls first; a row that
repeats another of its conversation counts once; a null role is rendered as
``user``, a null text as empty, and both count as these values when compared; rows
without conversation id belong to no conversation and are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.session import stage

DEFAULT_ROLE = "user"


def _turns(chats: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    return chats.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(DEFAULT_ROLE)).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, n, size, h1, h2: a rolling hash after each of the conversation's turns."""
    whole = Window.partitionBy("conv_id")
    order = whole.orderBy("turn", "role", "t1", "t2")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h1, h2 = F.xxhash64("n", "role", "t1", "t2"), F.xxhash64(F.lit(7), "n", "role", "t2", "t1")
    return (
        turns.select("conv_id", "turn", "role", F.xxhash64("text").alias("t1"),
                     F.xxhash64(F.lit(1), "text").alias("t2"))
        .distinct()
        .withColumn("n", F.row_number().over(order))
        .select("conv_id", "n", F.count(F.lit(1)).over(whole).alias("size"),
                *(F.sum(h.cast("decimal(20,0)")).over(upto).alias(name)
                  for h, name in ((h1, "h1"), (h2, "h2"))))
    )


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, copies of conversations that no other one extends or repeats."""
    hashes = stage(prefix_hashes(turns), "chat-prefixes")
    key = ["n", "h1", "h2"]
    whole = hashes.where("n = size").groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    inner = hashes.where("n < size").select(*key).distinct()
    return whole.join(inner, key, "left_anti").select("conv_id", "copies")


def render(chats: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """conv_id, n_turns, copies, chat: one row per maximal conversation."""
    turns = _turns(chats, conv_id, turn, role, text)
    kept = stage(maximal(turns), "chat-maximal")
    line = "transform(said, x -> concat('<|', x.role, '|>\\n', x.text, '\\n<|end|>\\n'))"
    return (
        turns.join(kept, "conv_id")
        .groupBy("conv_id")
        .agg(F.first("copies").alias("copies"),
             F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("said"))
        .select("conv_id", F.size("said").cast("long").alias("n_turns"), "copies",
                F.array_join(F.expr(line), "").alias("chat"))
    )
