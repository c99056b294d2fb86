"""Files of records that span lines, read in splits by all tasks.

A quoted CSV value may hold newlines and a JSON array may be one long line, so
the parsers' multi-line mode reads a file in one task. Here the text is read in
Spark's ordinary splits, as chunks between separators: the newline for CSV, the
closing brace for a JSON array. What a chunk means depends on all text before
it, but little of that: whether a quote is open, and for JSON how deep the
brackets are. So:

1. each split is summed up without knowing what comes before it: quotes modulo
   two, and the change of depth for either state of the quotes;
2. a prefix over the splits of each file (one small row per split) gives every
   split its state at the start;
3. with that state each split finds its records. Those that cross a border
   leave a fragment on either side; fragments are few, and are put together
   per file in order. Only splits at which a record crosses are read for them.

The rows per split are broadcast, 40 bytes each: at most one for every
``spark.sql.files.maxPartitionBytes`` of input, which is checked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopstar.sources.store import written

#: Splits whose states may be broadcast (160 MB); larger inputs need larger splits.
MAX_SPLITS = 4_000_000

WHOLE, HEAD, MIDDLE, TAIL = range(4)


class MalformedFile(ValueError):
    pass


@dataclass(frozen=True)
class Format:
    """How records are found. ``scan`` gives, for chunks and whether a quote is
    open at their first one, whether one is open after each chunk and the depth
    after each (from 0). A record ends with a chunk after which no quote is
    open and the depth is ``base``; a whole file ends at depth ``final``, its
    last chunk counted as if a separator followed."""
    separator: str
    base: int
    final: int
    scan: Callable[[pa.Array, int], tuple[np.ndarray, np.ndarray]]


def _csv_scan(values: pa.Array, open_: int) -> tuple[np.ndarray, np.ndarray]:
    quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
    return (open_ + np.cumsum(quotes, dtype=np.int64)) % 2, np.zeros(len(values), np.int64)


def _json_scan(values: pa.Array, open_: int) -> tuple[np.ndarray, np.ndarray]:
    # a character behind a backslash is never a quote or a bracket
    values = pc.replace_substring_regex(values, r"(?s)\\.", "")
    quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
    state = (open_ + np.cumsum(quotes, dtype=np.int64)) % 2
    before = np.concatenate(([open_], state[:-1])).astype(bool)
    opening = pa.array(np.where(before, '"', "")) if len(values) else values
    outside = pc.replace_substring_regex(
        pc.binary_join_element_wise(opening.cast(values.type), values, ""), '(?s)"[^"]*(?:"|$)', "")

    def count(bracket: str) -> np.ndarray:
        return pc.count_substring(outside, bracket).to_numpy(zero_copy_only=False).astype(np.int64)

    return state, np.cumsum(count("{") + count("[") - count("]") - (state == 0))


CSV = Format("\n", 0, 0, _csv_scan)
JSON_ARRAY = Format("}", 1, -1, _json_scan)


def _chunks(spark: SparkSession, path: str, kind: Format) -> DataFrame:
    """(value, file, split): chunks in the order of their file within each task."""
    return spark.read.text(path, lineSep=kind.separator).select(
        "value", F.xxhash64(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("split"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """((file, split), first, end) of the chunks of one split in a batch."""
    file, split = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
    edges = np.flatnonzero((np.diff(file) != 0) | (np.diff(split) != 0)) + 1
    for a, b in zip(np.concatenate(([0], edges)), np.append(edges, file.size)):
        if a < b:
            yield (int(file[a]), int(split[a])), int(a), int(b)


def _states(chunks: DataFrame, kind: Format) -> DataFrame:
    """(file, split, open, depth, after, last_depth): the state at the start of each
    split, whether a record is under way at its end, and for the last split of
    a file the state at its end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, [0, 0, 0, 0]  # open and depth if none is open before; if one is

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (*now, *sums)],
                                              ["file", "split", "o0", "d0", "o1", "d1"])

        for batch in batches:
            for key, a, b in _runs(batch):
                if key != now:
                    if now is not None:
                        yield row()
                    now, sums = key, [0, 0, 1, 0]
                for k in (0, 2):
                    state, depth = kind.scan(batch.column(0).slice(a, b - a), sums[k])
                    sums[k] = int(state[-1])
                    sums[k + 1] += int(depth[-1])
        if now is not None:
            yield row()

    before = Window.partitionBy("file").orderBy("split")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    sums = chunks.mapInArrow(run, "file bigint, split bigint, o0 bigint, d0 bigint, o1 bigint, d1 bigint")
    opened = sums.withColumn("open", F.coalesce(F.sum("o0").over(earlier), F.lit(0)) % 2)
    own = F.when(F.col("open") == 0, F.col("d0")).otherwise(F.col("d1"))
    depth = opened.withColumn("own", own).withColumn("depth", F.coalesce(F.sum("own").over(earlier), F.lit(0)))
    return depth.select("file", "split", "open", "depth",
                        F.when(F.col("open") == 0, F.col("o0")).otherwise(F.col("o1")).alias("after"),
                        (F.col("depth") + F.col("own")).alias("last_depth"),
                        F.lead("split").over(before).isNull().alias("last"))


def _found(chunks: DataFrame, states: DataFrame, kind: Format) -> DataFrame:
    """(value, file, split, kind, first): whole records and the fragments of
    those that cross borders; ``first``: nothing of the file stands before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, depth, closed, first = None, 0, 0, True, True
        pending: list[str] = []

        def rows(values, kinds, firsts) -> pa.RecordBatch:
            n = len(values)
            return pa.RecordBatch.from_arrays(
                [values if isinstance(values, pa.Array) else pa.array(values, pa.string()),
                 pa.array([now[0]] * n, pa.int64()), pa.array([now[1]] * n, pa.int64()),
                 pa.array(kinds, pa.int32()), pa.array(firsts, pa.bool_())], ["value", "file", "split", "kind", "first"])

        def rest() -> Iterator[pa.RecordBatch]:
            if now is not None and pending:
                yield rows([kind.separator.join(pending)], [TAIL if closed else MIDDLE], [first])

        for batch in batches:
            start_open, start_depth = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4))
            for key, a, b in _runs(batch):
                if key != now:
                    yield from rest()
                    now, pending, first = key, [], key[1] == 0
                    state, depth = int(start_open[a]), int(start_depth[a])
                    # a record is under way at the start, but for the very first one
                    closed = state == 0 and depth == kind.base or first
                values = batch.column(0).slice(a, b - a)
                states_, depths = kind.scan(values, state)
                ends = np.flatnonzero((states_ == 0) & (depths + depth == kind.base))
                state, depth = int(states_[-1]), depth + int(depths[-1])
                if not ends.size:
                    pending += values.to_pylist()
                    continue
                begins = np.concatenate(([0], ends[:-1] + 1))
                single = begins == ends
                single[0] &= not pending and closed
                parts = np.flatnonzero(~single)
                made, kinds = [], []
                for k in parts:
                    piece = [*(pending if k == 0 else []), *values.slice(begins[k], ends[k] - begins[k] + 1).to_pylist()]
                    made.append(kind.separator.join(piece))
                    kinds.append(WHOLE if k or closed else HEAD)
                if parts.size == 0:
                    out, out_kinds = values.take(pa.array(ends)), np.zeros(ends.size, np.int32)
                else:
                    whole = values.take(pa.array(ends[single]))
                    place = np.empty(ends.size, np.int64)  # back into the order of the file
                    place[np.flatnonzero(single)] = np.arange(whole.__len__())
                    place[parts] = len(whole) + np.arange(parts.size)
                    out = pa.concat_arrays([whole, pa.array(made, whole.type)]).take(pa.array(place))
                    out_kinds = np.zeros(ends.size, np.int32)
                    out_kinds[parts] = kinds
                firsts = np.zeros(ends.size, bool)
                firsts[0] = first
                yield rows(out.cast(pa.string()), out_kinds, firsts)
                first, closed = False, True
                pending = values.slice(ends[-1] + 1).to_pylist()
        yield from rest()

    held = chunks.join(F.broadcast(states.select("file", "split", "open", "depth")), ["file", "split"]).select(
        "value", "file", "split", "open", "depth")
    return held.mapInArrow(run, "value string, file bigint, split bigint, kind int, first boolean")


def read_records(spark: SparkSession, path: str, kind: Format) -> tuple[DataFrame, DataFrame]:
    """(value, first) of the records of the files at ``path``, without their
    last separator, and (value) of what stands after the last record of a file,
    if anything. A file that ends inside a record is an error."""
    chunks = _chunks(spark, path, kind)
    states = written(_states(chunks, kind), "file_splits")
    crossing = (F.col("open") != 0) | (F.col("depth") != kind.base) & (F.col("split") != 0)
    cut_off = F.col("last") & ((F.col("after") != 0) | (F.col("last_depth") != kind.final))
    n, crossed, broken = states.agg(F.count("*"), F.count_if(crossing), F.count_if(cut_off)).first()
    if n > MAX_SPLITS:
        raise ValueError(f"{n} splits: raise spark.sql.files.maxPartitionBytes")
    if broken:
        raise MalformedFile(f"{broken} of the files at {path} end inside a record")
    whole = _found(chunks, states, kind).where(F.col("kind") == WHOLE).select("value", "first")
    # splits at whose start or end a record is under way
    over = F.coalesce(F.lead(crossing).over(Window.partitionBy("file").orderBy("split")), F.lit(True))
    some = states.withColumn("over", over).where(crossing | F.col("over")).select("file", "split")
    parts = _found(chunks.join(F.broadcast(some), ["file", "split"], "left_semi"), states, kind) \
        .where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("split", "kind")
    joined = (parts.withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
              .groupBy("file", "record")
              .agg(F.array_sort(F.collect_list(F.struct("split", "kind", "value", "first"))).alias("parts"))
              .select(F.array_join(F.transform("parts", lambda p: p["value"]), kind.separator).alias("value"),
                      F.exists("parts", lambda p: p["first"]).alias("first"),
                      F.exists("parts", lambda p: p["kind"] == HEAD).alias("closed")))
    if crossed:
        whole = whole.unionByName(joined.where("closed").select("value", "first"))
    return whole, joined.where("not closed").select("value")
