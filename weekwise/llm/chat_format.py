"""Chat formatting with cumulative-snapshot collapse; DataFrame operations only.

Logged conversations often begin another, longer one: each turn was logged
with all before it.  A running 128-bit hash over the turns names every prefix
of every conversation.  Conversations with one name are copies, of which the
smallest conv_id stays, and an anti-join drops those whose name is that of a
proper prefix of another.  The rest are rendered.

Hashes alone cross the network until the conversations that stay are known;
names are reduced to distinct ones before they meet, so a first turn that all
conversations share costs no more than another.

Defined cases: a row that repeats another (conversation, turn, role and text)
counts once; different rows of one turn stand in the order of their hash;
null roles and texts are empty; a null turn comes first; rows without conv_id
belong to no conversation.  A conversation is one output row, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekwise.llm.common import Scratch

TEMPLATE = ("<|{role}|>\n", "<|end|>\n")   # before and after each turn


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.xxhash64(F.lit(1), role, text).alias("h"), F.xxhash64(F.lit(2), text, role).alias("g"))


def prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, n, p1, p2, last): the name of every turn-prefix, rolled over the turns."""
    turns = _turns(conversations).select("conv_id", "turn", "h", "g").distinct()
    ordered = Window.partitionBy("conv_id").orderBy("turn", "h", "g")
    numbered = turns.withColumn("n", F.row_number().over(ordered)).withColumn(
        "last", F.lead("h").over(ordered).isNull())
    rolling = ordered.rowsBetween(Window.unboundedPreceding, 0)
    return numbered.select(
        "conv_id", "n", F.bit_xor(F.xxhash64("n", "h", "g")).over(rolling).alias("p1"),
        F.bit_xor(F.xxhash64("g", "n", "h")).over(rolling).alias("p2"), "last")


def maximal(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, n_turns, copies): the conversations that no other one continues."""
    names = scratch.save(prefixes(conversations), "prefixes")
    whole = names.filter("last").groupBy("n", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    begun = names.filter("not last").select("n", "p1", "p2").distinct()
    return whole.join(begun.hint("merge"), ["n", "p1", "p2"], "left_anti").select(
        "conv_id", F.col("n").cast("long").alias("n_turns"), "copies")


def _guarded(text: Column) -> Column:
    """Marks written in a text cannot pass for the template's."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def render(conversations: DataFrame, template: tuple[str, str] = TEMPLATE) -> DataFrame:
    """(conv_id, n_turns, copies, rendered) of the conversations that stay."""
    scratch = Scratch(conversations.sparkSession, "chat")
    kept = scratch.save(maximal(conversations, scratch), "kept")
    turns = _turns(conversations).join(kept.hint("merge"), "conv_id")
    turn = F.struct("turn", "h", "g", "role", "text")
    before, after = template
    head, tail = before.split("{role}")

    def written(t):
        return F.concat(F.lit(head), _guarded(t["role"]), F.lit(tail), _guarded(t["text"]), F.lit(after))

    grouped = turns.groupBy("conv_id").agg(
        F.first("n_turns").alias("n_turns"), F.first("copies").alias("copies"),
        F.array_sort(F.collect_set(turn)).alias("turns"))
    return grouped.select("conv_id", "n_turns", "copies",
                          F.array_join(F.transform("turns", written), "").alias("rendered"))
