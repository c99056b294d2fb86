"""Sharding by a hierarchical weighted hash tree.

Regions hold racks, racks hold shards. A key descends the tree: at each node
every child draws a number from (key, child), divided by the child's weight,
and the smallest wins (weighted rendezvous). A weight change moves keys only
between the changed child and its siblings, and only in the subtrees on the
path to it. ``grow`` opens a region of its own for a new shard: only the top
draw changes, and a key moves only if the new region wins it, so the new shard
takes rows only into itself.

Slots are numbered without a gap by counts per (input partition, shard): the
assignment is written once with its partition, the counts' running totals are
a small table, and a window inside each (partition, shard) adds the rest.

Defined cases: null ids go by the hash of null, all to one shard; null and
empty texts count one byte; repeated rows get a slot each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstar.llm.common import written


@dataclass(frozen=True)
class Node:
    """``name`` seeds the draws, so it must stay; a leaf has a shard number."""
    name: str
    weight: float = 1.0
    shard: int | None = None
    children: tuple["Node", ...] = ()

    @property
    def total(self) -> float:
        return sum(c.total for c in self.children) if self.children else self.weight


def balanced(shards: int, per_rack: int = 2, racks: int = 2) -> Node:
    """``shards`` equal shards in racks of ``per_rack``, regions of ``racks`` racks."""
    leaves = [Node(f"s{k}", shard=k) for k in range(shards)]
    level = [Node(f"k{k}", children=tuple(leaves[k:k + per_rack])) for k in range(0, shards, per_rack)]
    return Node("root", children=tuple(
        Node(f"r{k}", children=tuple(level[k:k + racks])) for k in range(0, len(level), racks)))


def leaves(tree: Node) -> list[Node]:
    return [x for c in tree.children for x in leaves(c)] if tree.children else [tree]


def grow(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a new region and rack."""
    n = 1 + max(x.shard for x in leaves(tree))
    rack = Node(f"k+{n}", children=(Node(f"s{n}", weight, n),))
    return Node(tree.name, children=(*tree.children, Node(f"r+{n}", children=(rack,))))


def shard_of(key: Column, tree: Node) -> Column:
    """The shard of ``key``: the descent as one native expression."""
    if not tree.children:
        return F.lit(tree.shard)
    if len(tree.children) == 1:
        return shard_of(key, tree.children[0])

    def draw(child: Node) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(child.name)), 11).cast("double")
        return -F.log((bits + 0.5) / float(1 << 53)) / child.total

    best = F.least(*[F.struct(draw(c).alias("draw"), F.lit(k).alias("child"))
                     for k, c in enumerate(tree.children)])["child"]
    out = shard_of(key, tree.children[-1])
    for k in range(len(tree.children) - 2, -1, -1):
        out = F.when(best == k, shard_of(key, tree.children[k])).otherwise(out)
    return out


def assign(docs: DataFrame, tree: Node, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard) for each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.col(id_col)
    placed = written(docs.select(
        key.alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(key, tree).cast("int").alias("shard"),
        shard_of(key, grow(tree)).cast("int").alias("grown_shard"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "placed")
    running = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("shard", "part").agg(F.count("*").alias("n")).select(
        "shard", "part", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("at")) - 1
    return placed.withColumn("inside", inside).join(before, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("inside")).alias("slot"),
        "grown_shard")
