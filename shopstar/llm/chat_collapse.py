"""Cumulative-snapshot collapse of logged conversations, then rendering.

Chat logs often hold a conversation once per turn, each snapshot a prefix of
the next. Every turn gets a rolling hash of all turns up to it (128 bits, the
exclusive or of hashes of place, role and text, as a running window); a
conversation whose whole hash is the inner prefix of another one is dropped by
an anti-join. Equal conversations are one: the smallest id stays.

Main path: DataFrame functions only. Hashes, not texts, are windowed and
joined; prefixes are made distinct first, so a first turn shared by a third of
all conversations is one row per task. Texts move once, for rendering.

Defined cases: turns are ordered by number, nulls first, equal numbers by content hash; rows equal
in all four columns count once; a null text renders empty, a null role as
``unknown``; rows without a conversation id belong to no conversation and are
left out; an empty table gives an empty result; other columns are ignored.
Role and text are escaped so that they cannot contain the markers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstar.llm.common import written

# The markers of the rendered form.
START, STOP = "<|im_start|>", "<|im_end|>"


def _plain(value: Column, default: str) -> Column:
    return F.replace(F.coalesce(value, F.lit(default)), F.lit("<|"), F.lit("< |"))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, n, pos, a, b): the rolling hash after each turn, and n turns in all."""
    content = [F.col("role"), F.col("role").isNull(), F.col("text"), F.col("text").isNull()]
    hashed = turns.where("conv_id is not null").select(
        "conv_id", "turn", F.xxhash64(*content).alias("h1"),
        F.xxhash64(F.lit(1), *content).alias("h2")).distinct()
    ordered = Window.partitionBy("conv_id").orderBy("turn", "h1", "h2")
    numbered = hashed.withColumn("pos", F.row_number().over(ordered))
    rolling = ordered.rowsBetween(Window.unboundedPreceding, 0)
    return numbered.select(
        "conv_id", "pos", F.bit_xor(F.xxhash64("pos", "h1", "h2")).over(rolling).alias("a"),
        F.bit_xor(F.xxhash64("h2", "pos", "h1")).over(rolling).alias("b"),
        F.lead("pos").over(ordered).isNull().alias("whole"))


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that prefix no other."""
    rolled = written(prefixes(turns), "prefixes")
    whole = rolled.where("whole").groupBy("pos", "a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    inner = rolled.where("not whole").select("pos", "a", "b").distinct()
    return whole.join(inner, ["pos", "a", "b"], "left_anti").select(
        "conv_id", F.col("pos").cast("long").alias("n_turns"), "n_copies")


def collapse(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies, rendered) of the maximal conversations."""
    turns = conversations.select("conv_id", "turn", "role", "text")
    kept = written(maximal(turns), "maximal")
    content = [F.col("role"), F.col("role").isNull(), F.col("text"), F.col("text").isNull()]
    line = F.concat(F.lit(START), _plain(F.col("role"), "unknown"), F.lit("\n"),
                    _plain(F.col("text"), ""), F.lit(STOP + "\n"))
    rendered = (turns.join(kept, "conv_id", "left_semi")
                .groupBy("conv_id").agg(F.sort_array(F.collect_set(F.struct(
                    "turn", F.xxhash64(*content).alias("h1"),
                    F.xxhash64(F.lit(1), *content).alias("h2"), line.alias("line")))).alias("t"))
                .select("conv_id", F.array_join(F.col("t.line"), "").alias("rendered")))
    return kept.join(rendered, "conv_id").select("conv_id", "n_turns", "n_copies", "rendered")
