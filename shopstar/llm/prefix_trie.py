"""Trie of conversation prefixes over minimal-perfect-hash node tables.

A conversation's prefix of d turns is a node: its key is d and a 128-bit
digest, the exclusive or of its turns' hashes with their places, so digests
come from running aggregates in segments and a parent's digest is its child's
without the last turn. Equal keys are one node; members are counted map-side.

Nodes are dealt to shards by subtree. A node's weight (turns of its members
from here on) bounds its subtree, and weights fall along a path; nodes whose
weights lie between the same two powers form a layer, and the parts of a layer
hang below higher layers. A part of the lowest layer holds ``PART`` nodes at
most, one of a higher layer ``SPREAD`` per depth, so no shard grows with a hot
first turn. In a shard the distinct digests get slots of a minimal perfect
hash (levels of collision-free places, ranked); a lookup is verified against
the digest stored in its slot. Counts are scattered into flat arrays and added
up through the parent slots, deepest first. The tops' sums, added up per
parent, go into the next layer; there are as many jobs as layers, a logarithm
of the input.

Defined cases: null role or text is the empty string; a null turn comes first;
turns with equal numbers follow the order of their hashes, repeated rows are
turns of their own; rows without a conversation id belong to none and are
dropped; an empty table gives no nodes; other columns are ignored; a negative
id's origin and crc are those of SQL's remainder and its decimal digits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstar.llm.common import split_words, written

#: Conversations that share an origin, and the most turns taken from it.
FAMILY, HEADS = 20, 4
#: Turns of one conversation that are ordered together.
SEGMENT_BITS = 10
#: Largest weight of a part of the lowest layer; ratio of weights in a layer.
PART, SPREAD = 1 << 12, 1 << 6
#: Nodes that a shard holds on average.
SHARD = 1 << 15
#: Member ids that are joined in one string.
CHUNK_BITS = 8

_FIRST = -(1 << 62)


def _hash(*cols: Column) -> tuple[Column, Column]:
    return F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)


def _turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, seg, k, a, b, words): turn k (from 1) of a segment of a
    conversation. Texts go no further than this."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    a, b = _hash(role, text)
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), a.alias("a"), b.alias("b"),
        F.size(split_words(text)).cast("long").alias("words"),
        F.coalesce(F.shiftright(F.col(turn_col).cast("long"), SEGMENT_BITS), F.lit(_FIRST)).alias("seg"))
    inside = Window.partitionBy("conv_id", "seg").orderBy(F.col("turn").asc_nulls_first(), "a", "b")
    return rows.select("conv_id", "seg", F.row_number().over(inside).cast("long").alias("k"), "a", "b", "words")


def _rebuilt(turns: DataFrame, family: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """(conv_id, seg, pos, a, b, words) of the rebuilt conversations, and
    (conv_id, len) of all, those without a turn too. Per conversation only
    its segments' sizes and its first turns are held together."""
    before = Window.partitionBy("conv_id").orderBy("seg")
    segments = turns.groupBy("conv_id", "seg").agg(F.count("*").alias("n")).select(
        "conv_id", "seg", F.coalesce(F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)),
                                     F.lit(0)).alias("off"), "n")
    segments = written(segments, "trie_segments")
    origins = (turns.where((F.col("conv_id") % family == 0) & (F.col("k") < heads))
               .join(segments.select("conv_id", "seg", "off"), ["conv_id", "seg"])
               .where(F.col("off") + F.col("k") < heads)
               .groupBy(F.col("conv_id").alias("origin"))
               .agg(F.sort_array(F.collect_list(F.struct((F.col("off") + F.col("k")).alias("pos"), "a", "b", "words")))
                    .alias("heads")))
    id_ = F.col("conv_id")
    h = F.crc32(id_.cast("string").cast("binary")) % heads
    convs = (segments.groupBy("conv_id").agg(F.sum("n").alias("n"))
             .select("conv_id", "n", h.alias("h"), (id_ - id_ % family).alias("origin"))
             .join(origins, "origin", "left")
             .select("conv_id", "n", "h", F.filter(F.coalesce(F.col("heads"), F.array().cast(
                 "array<struct<pos:bigint,a:bigint,b:bigint,words:bigint>>")),
                 lambda x: x["pos"] <= F.col("h")).alias("heads")))
    convs = written(convs, "trie_conversations")
    taken = F.size("heads").cast("long")
    shift = segments.join(convs.select("conv_id", "h", (taken - F.col("h")).alias("shift")), "conv_id") \
        .select("conv_id", "seg", "off", "h", "shift")
    pos = F.col("off") + F.col("k")
    own = turns.join(shift, ["conv_id", "seg"]).where(pos > F.col("h")).select(
        "conv_id", "seg", (pos + F.col("shift")).alias("pos"), "a", "b", "words")
    given = convs.select("conv_id", F.lit(_FIRST - 1).alias("seg"), F.inline("heads"))
    return own.unionByName(given), convs.select(
        "conv_id", (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"))


def _prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, x, y, px, py, words, len): a row per rebuilt turn, the
    digests of the prefix that it ends and of the one before."""
    a, b = _hash(F.col("pos"), F.col("a"), F.col("b"))
    turns = turns.select("conv_id", "seg", "pos", a.alias("a"), b.alias("b"), "words")
    before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    starts = turns.groupBy("conv_id", "seg").agg(F.bit_xor("a").alias("ta"), F.bit_xor("b").alias("tb")).select(
        "conv_id", "seg", *[F.coalesce(F.bit_xor(t).over(before), F.lit(0)).alias(t) for t in ("ta", "tb")])
    so_far = Window.partitionBy("conv_id", "seg").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = (turns.join(starts, ["conv_id", "seg"])
            .select("conv_id", F.col("pos").alias("depth"), "a", "b", "words",
                    *[F.col(t).bitwiseXOR(F.bit_xor(c).over(so_far)).alias(n)
                      for n, c, t in (("x", "a", "ta"), ("y", "b", "tb"))])
            .select("conv_id", "depth", "x", "y", F.col("x").bitwiseXOR(F.col("a")).alias("px"),
                    F.col("y").bitwiseXOR(F.col("b")).alias("py"), "words"))
    return rows.join(lengths, "conv_id")


def _nodes(prefixes: DataFrame, lengths: DataFrame, part: int, spread: int) -> DataFrame:
    """A row per node: key, parent's key, smallest member, members, words,
    weight and layer. The root's key is depth 0 and digest 0."""
    members = [F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")]
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "x", "y", "px", "py", "words")]
    root = lengths.agg(*members, F.sum(F.col("len") + 1).alias("weight")).where("n_convs > 0").select(
        *zero, "conv_id", "n_convs", "weight")
    inner = prefixes.groupBy("depth", "x", "y").agg(
        F.min("px").alias("px"), F.min("py").alias("py"), F.min("words").alias("words"), *members,
        F.sum(F.col("len") - F.col("depth") + 1).alias("weight"))
    bound, layer, steps = part, F.lit(0), []
    while bound < 1 << 62:
        steps.append(F.when(F.col("weight") > bound, 1).otherwise(0))
        bound *= spread
    for s in steps:
        layer = layer + s
    return inner.unionByName(root).withColumn("layer", layer)


class PerfectHash:
    """Slots 0..n-1 of n distinct keys (equal-length uint64 arrays). Each
    level hashes what is left; keys alone in their place keep it, ranked."""

    def __init__(self, *keys: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        left, done = np.arange(keys[0].size), 0
        while left.size:
            size = 2 * left.size + 1
            place = self._place(len(self.levels), size, *[k[left] for k in keys])
            alone = np.bincount(place, minlength=size) == 1
            self.levels.append((size, alone, np.cumsum(alone) - 1 + done))
            done += int(alone.sum())
            left = left[~alone[place]]
            if len(self.levels) > 200:
                raise ValueError("keys are not distinct")

    @staticmethod
    def _place(level: int, size: int, *keys: np.ndarray) -> np.ndarray:
        h = np.full(keys[0].size, level + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in keys:
            h = (h ^ k) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(32)
            h = h * np.uint64(0xC4CEB9FE1A85EC53)
            h ^= h >> np.uint64(29)
        return (h % np.uint64(size)).astype(np.int64)

    def __call__(self, *keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot or -1 for a key that is not held."""
        out = np.full(keys[0].size, -1)
        todo = np.arange(keys[0].size)
        for level, (size, alone, rank) in enumerate(self.levels):
            place = self._place(level, size, *[k[todo] for k in keys])
            hit = alone[place]
            out[todo[hit]] = rank[place[hit]]
            todo = todo[~hit]
        return out


def accumulate(depth: np.ndarray, x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray,
               own: np.ndarray, leaves: np.ndarray, children: np.ndarray, values: np.ndarray):
    """Sums over the subtrees of one shard, in the order of the given nodes:
    (parent's place or -1, children, leaves, own). ``values`` are only fetched
    for the parents. ``leaves``, ``children`` and ``own`` come with what lower
    layers have given."""
    keys = [a.view(np.uint64) for a in (depth, x, y)]
    table = PerfectHash(*keys)
    slot = table(*keys)
    stored = np.empty((3, depth.size), np.uint64)
    stored[:, slot] = keys
    above = [a.view(np.uint64) for a in (depth - 1, px, py)]
    parent = table(*above)
    held = (parent >= 0) & (depth > 0)
    for row, key in zip(stored, above):  # a slot counts if it holds that very digest
        held &= row[parent] == key
    by_slot = np.full(depth.size, -1)
    by_slot[slot] = np.where(held, parent, -1)
    n_children = np.zeros(depth.size, np.int64)
    n_children[slot] = children
    n_children += np.bincount(parent[held], minlength=depth.size)
    n_leaves, total = np.zeros(depth.size, np.int64), np.zeros(depth.size, np.int64)
    n_leaves[slot], total[slot] = leaves, own
    n_leaves[n_children == 0] = 1
    level = np.zeros(depth.size, np.int64)
    level[slot] = depth
    order = np.argsort(-level, kind="stable")
    for now in np.split(order, np.flatnonzero(np.diff(level[order])) + 1):
        now = now[by_slot[now] >= 0]
        np.add.at(n_leaves, by_slot[now], n_leaves[now])
        np.add.at(total, by_slot[now], total[now])
    fetched = np.zeros(depth.size, np.int64)
    fetched[slot] = values
    return (held, np.where(held, fetched[parent], 0), n_children[slot], n_leaves[slot], total[slot])


_KEY = ("depth", "x", "y")
_DONE = ("depth bigint, x bigint, y bigint, px bigint, py bigint, conv_id bigint, n_convs bigint, "
         "parent_conv_id bigint, n_children bigint, n_leaves bigint, saved_tokens bigint")


def _layer_sums(nodes: DataFrame, shards: int) -> DataFrame:
    """``accumulate`` per shard; a top of a part has no parent_conv_id yet."""
    def run(table: pa.Table) -> pa.Table:
        c = {n: table.column(n).to_numpy() for n in table.column_names}
        held, parent, children, leaves, saved = accumulate(
            c["depth"], c["x"], c["y"], c["px"], c["py"], c["saved"] + (c["n_convs"] - 1) * c["words"],
            c["leaves"], c["children"], c["conv_id"])
        return pa.table({**{n: c[n] for n in ("depth", "x", "y", "px", "py", "conv_id", "n_convs")},
                         "parent_conv_id": pa.array(parent, mask=~held),
                         "n_children": children, "n_leaves": leaves, "saved_tokens": saved})

    shard = F.pmod(F.xxhash64("rx", "ry", "rdepth"), F.lit(shards)).alias("shard")
    return nodes.groupBy(shard).applyInArrow(run, _DONE)


def _ends(prefixes: DataFrame, lengths: DataFrame) -> DataFrame:
    """(depth, x, y, ends_sha256) of the nodes at which conversations end. Ids
    are joined in short runs, so a hot node is a stream of runs in one task."""
    ends = prefixes.where("depth = len").select("conv_id", *_KEY).unionByName(
        lengths.where("len = 0").select("conv_id", *[F.lit(0).cast("long").alias(k) for k in _KEY]))
    runs = ends.groupBy(*_KEY, F.shiftright("conv_id", CHUNK_BITS).alias("run")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    ordered = runs.repartition(*_KEY).sortWithinPartitions(*_KEY, "run").select(*_KEY, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, hashlib.sha256()

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows)) or [[]] * 4
            return pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], [*_KEY, "ends_sha256"])

        for b in batches:
            out = []
            for *key, ids in zip(*[b.column(k).to_pylist() for k in range(4)]):
                if key != now:
                    if now is not None:
                        out.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256()
                    digest.update(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield batch(out)
        if now is not None:
            yield batch([(*now, digest.hexdigest())])

    return ordered.mapInArrow(run, "depth bigint, x bigint, y bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", family: int = FAMILY, heads: int = HEADS, part: int = PART,
                spread: int = SPREAD, shard: int = SHARD) -> DataFrame:
    """A row per node of the trie of rebuilt conversations: conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    turns = written(_turns(conversations, conv_col, turn_col, role_col, text_col), "trie_turns")
    rebuilt, lengths = _rebuilt(turns, family, heads)
    prefixes = written(_prefixes(rebuilt, lengths), "trie_prefixes")
    nodes = written(_nodes(prefixes, lengths, part, spread), "trie_nodes")
    # the top of a node's part: the first prefix of its layer on its smallest member's path
    paths = prefixes.select("conv_id", *_KEY).join(nodes.select(*_KEY, "layer"), [*_KEY])
    tops = paths.groupBy("conv_id", "layer").agg(F.min(F.struct(*_KEY)).alias("top"))
    root = nodes.where("depth = 0").select("conv_id", "layer", F.struct(*_KEY).alias("root"))
    tops = nodes.join(tops, ["conv_id", "layer"], "left").join(
        root.select(F.col("layer").alias("root_layer"), "root"), F.col("layer") == F.col("root_layer"), "left")
    top = F.coalesce(F.col("root"), F.col("top"))  # the root's layer has one part
    placed = written(tops.select(*nodes.columns, *[top[k].alias(f"r{k}") for k in _KEY]), "trie_placed")
    sizes = {r["layer"]: r["n"] for r in placed.groupBy("layer").agg(F.count("*").alias("n")).collect()}
    done: DataFrame | None = None
    given = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]
    for layer in sorted(sizes):
        rows = placed.where(F.col("layer") == layer).drop("layer", "weight")
        if done is None:
            rows = rows.select("*", *given)
        else:
            below = done.where(F.col("parent_conv_id").isNull()).groupBy(
                (F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(
                F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
            rows = rows.join(below, [*_KEY], "left").na.fill(0, ["children", "leaves", "saved"])
        own = written(_layer_sums(rows, -(-sizes[layer] // shard)), "trie_layer")
        done = own if done is None else done.unionByName(own)
    if done is None:
        done = conversations.sparkSession.createDataFrame([], _DONE)
    above = nodes.where("layer > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("up"))
    ends = written(_ends(prefixes, lengths), "trie_ends")
    tops_only = done.where("parent_conv_id is null").join(above, ["depth", "px", "py"], "left") \
        .withColumn("parent_conv_id", F.col("up")).select(*done.columns)
    whole = done.where("parent_conv_id is not null").unionByName(tops_only)
    return whole.join(ends, [*_KEY], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
