"""SimHash near-duplicates by pigeonhole blocks.

A 64-bit fingerprint sums up the word shingles of a text. It is cut into six
blocks; two fingerprints that differ in three bits at most agree on three
blocks at least, so each fingerprint is keyed by every choice of three blocks
(20 keys of about 32 bits) and close pairs meet under a key. Pairs under a key
are verified by their Hamming distance.

Only distinct fingerprints are keyed: copies cost one row. A key shared by
many fingerprints is dealt into tiles of bounded size (every two of its salts
meet in one tile); a tile returns a spanning forest of its verified links,
never all pairs, and the components of the forests are those of all links.

Defined cases: null, empty and blank texts have fingerprint zero and link like
any other; fewer words than a shingle make one shingle; repeated rows give a
row each; a null id gets its component's id, the smallest non-null one (null
if there is none); an empty table gives an empty result; other columns are
ignored by the operator and kept by ``drop_near_duplicates``, which judges each
row by its own text, whether its id is null or repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstar.llm.common import LOWER, text_bytes, written
from shopstar.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints of one salt of a key; a tile holds two salts.
TILE = 1024
#: Rows of 25 bytes, told apart by their hashes, that may be broadcast.
BROADCAST_ROWS = 400_000
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = text_bytes(text).translate(LOWER).split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), CHUNK):
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in
                              zip(starts[k:k + CHUNK], ends[k:k + CHUNK])), "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, fp bigint")


def block_masks(max_bits: int, extra: int = 3) -> list[int]:
    """Masks such that any two fingerprints within ``max_bits`` agree under
    one: ``max_bits + extra`` blocks, each choice of ``extra`` of them."""
    blocks = max_bits + extra
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(masks, extra)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def forest(values: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """Spanning forest of the links among ``values``: (member, tree's smallest).

    The values are walked tree by tree; a value leaves the rest as it joins."""
    rest = np.sort(values)
    child: list[int] = []
    root: list[int] = []
    while rest.size > 1:
        first, rest = rest[0], rest[1:]
        queue = [first]
        while queue and rest.size:
            near = np.bitwise_count((rest ^ queue.pop()).view(np.uint64)) <= max_bits
            if near.any():
                found = rest[near]
                rest = rest[~near]
                child += found.tolist()
                root += [int(first)] * found.size
                queue += list(found)
    return child, root


def links(nodes: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """(a, b): a forest over the distinct fingerprints ``nodes.fp`` with the
    components of all pairs within ``max_bits``."""
    keys = [F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for k, m in enumerate(block_masks(max_bits))]
    keyed = nodes.select("fp", F.inline(F.array(*keys)))
    shared = written(keyed.groupBy("k", "key").agg(F.count("*").alias("n")).where("n > 1"),
                     "shared_keys")
    salts = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    salted = keyed.join(shared, ["k", "key"]).select(
        "k", "key", "fp", F.pmod(F.xxhash64("fp"), salts).cast("int").alias("s"),
        F.explode(F.sequence(F.lit(0), salts - 1)).alias("t"))
    tiles = salted.groupBy("k", "key", F.least("s", "t").alias("i"), F.greatest("s", "t").alias("j")
                           ).agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = batch.column(0).offsets.to_numpy()
            values = batch.column(0).values.to_numpy()
            a: list[int] = []
            b: list[int] = []
            for lo, hi in zip(offsets, offsets[1:]):
                child, root = forest(values[lo:hi], max_bits)
                a += child
                b += root
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             ["a", "b"])

    return tiles.select("fps").mapInArrow(run, "a bigint, b bigint").distinct()


def _classes(fps: DataFrame, max_bits: int, tile: int) -> DataFrame:
    """(fp, root, component_id) of the distinct fingerprints of ``fps``
    (doc_id, fp): the component's smallest fingerprint and smallest id."""
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct_fingerprints")
    roots = connected_components(links(nodes, max_bits, tile))
    roots = written(roots.select(F.col("node").alias("fp"), "root"), "fingerprint_roots")
    lows = written(roots.join(nodes, "fp").groupBy("root").agg(F.min("low").alias("component_id")),
                   "component_ids")
    linked = roots.join(lows, "root").select("fp", "root", "component_id")
    return written(nodes.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNotNull(), F.col("component_id")).otherwise(F.col("low")).alias("component_id")),
        "fingerprint_classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id) for each row: the component's smallest id."""
    fps = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = _classes(fps, max_bits, tile)
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _comparable(docs: DataFrame, column: str) -> Column:
    """The column as something that can be hashed: a map or variant by its JSON form."""
    kind = docs.schema[column].dataType.simpleString()
    if "map<" in kind or "variant" in kind:
        return F.to_json(F.struct(F.col(f"`{column}`")))
    return F.col(f"`{column}`")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (a null
    id after all others), then of the smallest hashes of its text and of the
    whole row; one of rows that are equal in all columns. Rows are told apart
    by those hashes, 192 bits, not by ids, so rows that share an id but not a
    text are judged by their own texts."""
    whole = F.xxhash64(*[_comparable(docs, c) for c in docs.columns])
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"), whole.alias("r"))
    keyed = docs.select(F.struct(F.col(f"`{id_col}`").alias("id"), key.alias("key")).alias("id"), text.alias("text"))
    fps = written(fingerprints(keyed, "id", "text", shingle).select("doc_id.*", "fp"), "fingerprints")
    classes = _classes(fps.select(F.col("id").alias("doc_id"), "fp"), max_bits, tile)
    placed = fps.join(classes.select("fp", "root"), "fp")
    chosen = placed.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "key")).alias("stays"))
    # few rows go, so those are named; a key that stays is named if it has several rows
    counted = placed.groupBy("root", "id", "key").agg(F.count("*").alias("n")).join(chosen, "root")
    same = F.col("key") == F.col("stays.key")
    named = written(counted.where(~same | (F.col("n") > 1)).select("key", same.alias("stays")), "near_duplicates")
    if named.count() <= BROADCAST_ROWS:  # else texts and keys meet by a shuffle
        named = F.broadcast(named)
    row = F.col("row")
    own = docs.select(F.struct("*").alias("row"), key.alias("key"))
    once = own.join(named.where("stays"), "key", "left_semi").groupBy("key").agg(F.first("row").alias("row"))
    return own.join(named, "key", "left_anti").select("row").unionByName(once.select("row")).select(
        *[row.getField(c).alias(c) for c in docs.columns])
