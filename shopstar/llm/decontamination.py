"""Benchmark decontamination by a broadcast set of word windows.

Spark turns the benchmark into distinct windows of ``size`` words (an item of
fewer words is one window) with the items they come from. The windows are
broadcast in blocks of at most ``max_windows`` (a checked count); a benchmark
within one block, as usual, needs one pass over the texts, a larger one a pass
per block with the hits so far carried along. Texts are scanned whole: words
of the benchmark's vocabulary get a number, runs of them a 64-bit window key,
and a key found in the set is verified word by word.

Defined cases: null, empty and wordless texts or items have no words and no
windows; repeated rows are scanned each; repeated items count once by their
id; items with a null id take part in hits but not in the item list; an empty
benchmark hits nothing; an empty table gives an empty result; the other
columns of the documents are kept unchanged where rows are returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.llm.common import LOWER_WORDS, NON_WORD, let, split_words, text_bytes, written

WINDOW = 10
#: Windows in one broadcast block (about 100 bytes each).
MAX_WINDOWS = 500_000
_FACTOR = 0x9E3779B97F4A7C15
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_windows(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id",
                 text_col: str = "text") -> DataFrame:
    """(window, items): distinct windows and the sorted ids, as text, of their items."""
    words = split_words(F.translate(F.col(text_col), _UPPER, _LOWER), NON_WORD)
    windows = let(words, lambda w: F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (size - 1), F.lit(1))),
                    lambda i: F.array_join(F.slice(w, i, F.lit(size)), " "))))
    return (benchmark.select(F.col(id_col).cast("string").alias("item"),
                             F.explode(windows).alias("window"))
            .groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items")))


def window_keys(ids: np.ndarray, at: np.ndarray, size: int, factor: int) -> np.ndarray:
    """64-bit key of the ``size`` word numbers from each place ``at``."""
    out = np.zeros(at.size, np.uint64)
    for k in range(size):
        out = out * np.uint64(factor) + ids[at + k]
    return out


def window_set(rows: list[tuple[str, list[str]]]) -> tuple:
    """A block's windows as plain data to broadcast: the words' numbers, the
    key's factor, and per window size the sorted keys, windows and items."""
    split = [(w.encode(), items) for w, items in rows]
    numbers: dict[bytes, int] = {}
    sizes: dict[int, list] = {}
    for window, items in split:
        words = window.split()
        sizes.setdefault(len(words), []).append((window, items))
        for word in words:
            numbers.setdefault(word, len(numbers) + 1)
    factor = _FACTOR
    while True:
        tables = {}
        for size, own in sizes.items():
            ids = np.array([[numbers[w] for w in window.split()] for window, _ in own], np.uint64)
            keys = window_keys(ids.ravel(), np.arange(0, ids.size, size), size, factor)
            order = np.argsort(keys)
            tables[size] = (keys[order], [own[k][0] for k in order], [own[k][1] for k in order])
        if all(np.diff(keys).all() for keys, _, _ in tables.values()):
            return numbers, factor, tables
        factor += 2  # two windows with one key: another factor


def scan_words(windows: tuple, words: list[bytes], hit: np.ndarray, items: set[str]) -> None:
    """Marks the words inside occurring windows and adds the windows' items."""
    numbers, factor, tables = windows
    ids = np.fromiter(map(numbers.get, words, repeat(0)), np.uint64, len(words))
    known = np.concatenate(([0], np.cumsum(ids != 0)))
    for size, (keys, texts, owners) in tables.items():
        if len(words) < size:
            continue
        at = np.flatnonzero(known[size:] - known[:-size] == size)
        if not at.size:
            continue
        found = window_keys(ids, at, size, factor)
        place = np.minimum(np.searchsorted(keys, found), keys.size - 1)
        same = keys[place] == found
        for p, k in zip(at[same].tolist(), place[same].tolist()):
            if b" ".join(words[p:p + size]) == texts[k]:
                hit[p:p + size] = True
                items.update(owners[k])


def _blocks(benchmark: DataFrame, size: int, max_windows: int) -> Iterator[tuple[tuple, bool]]:
    """(window set, is it the last) block by block: the driver holds one at a time."""
    windows = written(item_windows(benchmark, size), "benchmark_windows")
    n = windows.agg(F.coalesce(F.sum(F.greatest(F.size("items"), F.lit(1))), F.lit(0))).first()[0]
    blocks = max(1, -(-n // max_windows))
    block = F.pmod(F.xxhash64("window"), F.lit(blocks))
    for b in range(blocks):
        yield window_set([tuple(r) for r in windows.where(block == b).collect()]), b == blocks - 1


def _words(text: str | None) -> list[bytes]:
    return text_bytes(text).translate(LOWER_WORDS).split()


def _report(text: str | None, hit: np.ndarray, items: set[str]) -> tuple:
    listed = ",".join(sorted(items))
    n_hit = int(hit.sum())
    return (hit.size, n_hit, len(items), hashlib.sha256(listed.encode()).hexdigest(), n_hit > 0)


def remove_spans(text: str, hit: np.ndarray) -> str:
    """``text`` without its hit words and what stands between two of them."""
    data = text_bytes(text)
    if not hit.any():
        return text
    flat = np.frombuffer(data.translate(LOWER_WORDS), np.uint8) != 32
    starts = np.flatnonzero(flat & ~np.concatenate(([False], flat[:-1])))
    ends = np.flatnonzero(flat & ~np.concatenate((flat[1:], [False]))) + 1
    out, at = [], 0
    edges = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    for first, last in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1):
        out.append(data[at:starts[first]])
        at = ends[last]
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


_REPORT = ("n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "report", size: int = WINDOW,
                  id_col: str = "doc_id", text_col: str = "text",
                  max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``report``: (doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated) per row. ``documents``: the rows without a hit. ``spans``:
    all rows, with hit words cut out of the text."""
    if mode not in ("report", "documents", "spans"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")) \
        if mode == "report" else docs.select(F.col(text_col).alias("text"), F.struct("*").alias("row"))
    state = rows.select("*", F.lit(None).cast("binary").alias("hit"),
                        F.array().cast("array<string>").alias("items"))
    final = (f"doc_id {docs.schema[id_col].dataType.simpleString()}, {_REPORT}" if mode == "report"
             else rows.select("row", "text").schema)
    for windows, last in _blocks(benchmark, size, max_windows):
        shared = spark.sparkContext.broadcast(windows)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("text").to_pylist()
                hits, listed = [], []
                for text, old, had in zip(texts, batch.column("hit").to_pylist(),
                                          batch.column("items").to_pylist()):
                    words = _words(text)
                    hit = np.zeros(len(words), bool) if old is None else np.frombuffer(old, bool).copy()
                    items = set(had)
                    scan_words(shared.value, words, hit, items)
                    hits.append(hit)
                    listed.append(items)
                if not last:
                    names = batch.schema.names
                    batch = batch.set_column(names.index("hit"), batch.schema.field("hit"), pa.array(
                        [h.tobytes() for h in hits], pa.binary()))
                    yield batch.set_column(names.index("items"), batch.schema.field("items"), pa.array(
                        [sorted(i) for i in listed], batch.schema.field("items").type))
                elif mode == "report":
                    cols = zip(*map(_report, texts, hits, listed)) if texts else [[]] * 5
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id"), *[pa.array(list(c), t) for c, t in zip(cols, (
                            pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()))]],
                        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
                elif mode == "documents":
                    clean = pa.array([not h.any() for h in hits], pa.bool_())
                    yield batch.select(["row", "text"]).filter(clean)
                else:
                    cut = [t if t is None else remove_spans(t, h) for t, h in zip(texts, hits)]
                    yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(cut, pa.string())],
                                                     ["row", "text"])

        state = state.mapInArrow(run, final if last else state.schema)
        if not last:
            state = written(state, "hits")
            shared.unpersist()
    if mode == "report":
        return state
    return state.select(*[
        F.col("text").alias(c) if c == text_col and mode == "spans"
        else F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" and mode == "spans"
        else F.col("row")[c].alias(c) for c in docs.columns])
