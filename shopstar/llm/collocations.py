"""Phrase collocations counted with broadcast double-array tries.

1. Texts are cut into pieces and words once. A task numbers the words of a
   run of documents of one language and writes them as flat arrays: the run's
   distinct word hashes, and a place in them for each text position (0 between
   pieces); beside them the run's words and their counts.
2. Apriori, level by level: a phrase of k words is a candidate if both phrases
   of k - 1 words in it may be frequent. Each run gathers its phrases; only
   ``KEY_BITS`` of a phrase's hash and its count are shuffled and summed, with
   the first run that holds it. A key that reaches the least count goes to that
   run, which spells it out, and into a bitmap for the next level. A false hit
   of a bitmap makes a key more to sum, never a candidate.
3. Candidates are dealt to blocks of bounded size by their first words (those
   of a very frequent first word by their second too). A block is a
   double-array trie over the block's own words, built in a task and broadcast
   alone. numpy moves the states of all text positions of a run that begin a
   phrase of the block at once, one level after the other; the states are
   counted by ``bincount`` over many runs at a time, and a task's counts are
   summed by the phrase's place in the block. More candidates are
   more blocks, each over fewer positions.
   Phrases that share a key are noticed, since their counts do not add up to
   the key's sum, and are spelled out by all runs and counted too.
4. Counts are joined to their parts' counts; cuts are scored in exact decimal
   arithmetic; the best of each language come from bounded first rounds.

Word hashes are 64 bits of language and word; that no other word of the corpus
shares a frequent word's is checked, and another seed is taken if one does. A
hot word, pair or language is summed in each run before it is shuffled.

Defined cases: a null text has no words, a null language is ``und`` (one group
with a literal ``und``); repeated rows and null ids count each; an empty table
gives no phrases; other columns are ignored; a language with fewer phrases
returns all it has.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstar.llm.common import delete_folder, text_bytes, written_once
from shopstar.session import scratch_folder

LEAST = 10
LONGEST = 3
TOP = 2000
#: A phrase goes if a longer one has this percentage of its count.
COVER = 50
SCALE = 1_000_000
#: Positions of a run; bytes of a text that are split at a time.
RUN_TOKENS = 1 << 21
SPLIT_BYTES = 1 << 22
#: Bits of a phrase's hash that its first sums go by.
KEY_BITS = 44
#: log2 of the bits of a level's bitmap of frequent phrases, at least; it has
#: ``BITS_PER_KEY`` bits a key, as far as 2^MOST_FILTER_BITS bits go (32 MB).
FILTER_BITS = 26
BITS_PER_KEY = 16
MOST_FILTER_BITS = 28
#: Candidates of a block on average: its trie takes some 50 bytes for each.
BLOCK = 1 << 19
#: Bits of a digit of a word's number in a trie.
DIGIT_BITS = 10
#: log2 of the places of the table that tells most words that no phrase of a trie has.
KNOWN_BITS = 20
UNKNOWN_LANG = "und"

_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 10 if b in _PIECE_ENDS else 32 if b == 9 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    """Words to numbers in the order of their first appearance. 0 stands
    between pieces; an empty string (between two blanks) is no word: -1."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 1
        return n


def _numbered(pieces: bytes, numbers: _Numbers) -> np.ndarray:
    """Word numbers of some pieces in order, a 0 behind each piece."""
    words = pieces.replace(b"\n", b" \n ").split(b" ")
    found = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
    return np.append(found[found >= 0], np.int32(0))


def _seeded(seed: int, lang: str) -> int:
    """The seed of a language's word hashes, as Spark's xxhash64(seed, lang, word) has it."""
    return xxhash.xxh64_intdigest(lang.encode(), xxhash.xxh64_intdigest(seed.to_bytes(8, "little"), 42))


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed).cast("long"), F.col("lang"), F.col("word"))


_RUN = "run bigint, lang string, words binary, tokens binary, word binary, f bigint"


def _runs(docs: DataFrame, text_col: str, lang_col: str, seed: int, run_tokens: int) -> DataFrame:
    """Two kinds of rows: runs (run, lang, words, tokens), and the words of a run
    (lang, word, f)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        schema = pa.schema([("run", pa.int64()), ("lang", pa.string()), ("words", pa.binary()), ("tokens", pa.binary()),
                            ("word", pa.binary()), ("f", pa.int64())])
        open_: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for lang, (numbers, parts) in open_.items():
                words = [w for w, n in numbers.items() if n > 0]
                if not words:
                    continue
                tokens, base = np.concatenate(parts), _seeded(seed, lang)
                hashes = np.array([xxhash.xxh64_intdigest(w, base) for w in words], np.uint64)
                f = np.bincount(tokens, minlength=len(words) + 1)[1:]
                number += 1
                yield pa.RecordBatch.from_pylist([{"run": number, "lang": lang, "words": hashes.tobytes(), "tokens": _small(tokens)}],
                                                 schema)
                for k in range(0, len(words), 1 << 16):
                    part = slice(k, k + (1 << 16))
                    n = len(words[part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(n, pa.int64()), pa.array([lang] * n), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
                         pa.array(words[part], pa.binary()), pa.array(f[part])], schema=schema)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                value, k = text_bytes(text.as_py()).translate(_LOWER), 0
                while k < len(value):
                    end = value.find(b"\n", k + SPLIT_BYTES)  # a piece is never cut
                    end = len(value) if end < 0 else end
                    numbers, parts = open_.setdefault(lang, (_Numbers(), []))
                    parts.append(_numbered(value[k:end], numbers))
                    size += parts[-1].size
                    k = end
                    if size >= run_tokens:
                        yield from flush()
                        open_, size = {}, 0
        yield from flush()

    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
                       F.col(text_col).alias("text")).mapInArrow(run, _RUN)


def _small(tokens: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest bytes first: high bytes are mostly zero."""
    planes = tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(hashes, tokens, number) of each run: hash 0 stands for no word."""
    for batch in batches:
        for words, tokens, number in zip(*batch.columns):
            planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(tokens.as_py()), np.uint8).reshape(4, -1)
            yield (np.concatenate((np.zeros(1, np.uint64), np.frombuffer(words.as_py(), np.uint64))),
                   np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64), number.as_py())


def _mixed(hashes: list[np.ndarray]) -> np.ndarray:
    """One hash of the phrase; of one word: its own."""
    out = hashes[0]
    for h in hashes[1:]:
        out = (out ^ (out >> np.uint64(31))) * _MIX + h
    return out


def _key(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - KEY_BITS)


def _bitmap(keys: DataFrame, bits: int):
    """The first bits of the keys as a broadcast bitmap, at most one row per 64
    of its bits on the driver. Its size follows the number of keys: at a fixed
    one, false hits would grow with the square of the input."""
    bits = max(bits, min((BITS_PER_KEY * keys.count()).bit_length(), MOST_FILTER_BITS))
    place = F.shiftrightunsigned("key", KEY_BITS - bits)
    slots = keys.groupBy(F.shiftrightunsigned(place, 6).alias("slot")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int")))
        .alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[slots.column(0).to_numpy()] = slots.column(1).to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(out)


def _holds(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys >> np.uint64(KEY_BITS - (bitmap.size.bit_length() + 5))
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _frequent_words(rows: DataFrame, seed: int, least: int, bits: int) -> tuple[DataFrame, object, DataFrame] | None:
    """(lang, word, h, f) of the words with ``least`` occurrences or more, the
    bitmap of their hashes, and (lang, n) of all words; None if another word
    has the hash of a frequent one."""
    hashed = rows.withColumn("h", _hash(seed))
    keys = hashed.groupBy(F.shiftrightunsigned("h", 64 - KEY_BITS).alias("key")).agg(F.sum("f").alias("n")) \
        .where(F.col("n") >= least)
    shared = _bitmap(written_once(keys.select("key"), "phrase_keys"), bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_holds(shared.value, _key(b.column(2).to_numpy().view(np.uint64)))))

    found = written_once(hashed.select("lang", "word", "h", "f").mapInArrow(
        run, "lang string, word binary, h bigint, f bigint").groupBy("lang", "word", "h").agg(F.sum("f").alias("f")),
        "phrase_words")
    alike = found.groupBy("h").agg(F.count("*").alias("n"), F.max("f").alias("f")).where(
        (F.col("f") >= least) & ((F.col("n") > 1) | (F.col("h") == 0)))
    if alike.limit(1).collect():
        return None
    totals = written_once(rows.groupBy("lang").agg(F.sum("f").alias("n")), "phrase_totals")
    return found.where(F.col("f") >= least), shared, totals


def _held(hashes: np.ndarray, tokens: np.ndarray, k: int, shorter: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """A run's phrases of k words whose parts of k - 1 words the bitmap
    ``shorter`` holds, as k columns of word hashes, and their counts."""
    at = [tokens[j:tokens.size - k + 1 + j] for j in range(k)]
    if k == 2:  # words are tested once, not at each position
        good = _holds(shorter, _key(hashes))
        good[0] = False
        ok = good[at[0]] & good[at[1]]
    else:
        shifted = [tokens[j:tokens.size - k + 2 + j] for j in range(k - 1)]
        part = _holds(shorter, _key(_mixed([hashes[x] for x in shifted])))
        part &= np.logical_and.reduce([x > 0 for x in shifted])
        ok = part[:-1] & part[1:]
    rows = [a[ok] for a in at]
    size = hashes.size
    if size ** k < 1 << 63 or not rows[0].size:  # a phrase as one number of the run, where it fits
        code = rows[0]
        for r in rows[1:]:
            code = code * size + r
        code, n = np.unique(code, return_counts=True)
        cols = []
        for _ in range(k):
            cols.append(hashes[code % size])
            code = code // size
        return cols[::-1], n
    found, n = np.unique(np.stack(rows, axis=1), axis=0, return_counts=True)
    return [hashes[c] for c in found.T], n


def _in_parts(cols: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    for lo in range(0, cols[0].size, 1 << 17):
        yield pa.RecordBatch.from_arrays([pa.array(c[lo:lo + (1 << 17)].view(np.int64)) for c in cols], names)


def _gathered(runs: DataFrame, k: int, shorter) -> DataFrame:
    """(key, n, run) of the phrases of k words whose parts of k - 1 words the
    bitmap ``shorter`` holds: their sum, and the first run that has some."""
    names = ["key", "n", "run"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, tokens, number in _opened(batches):
            cols, n = _held(hashes, tokens, k, shorter.value)
            yield from _in_parts([_key(_mixed(cols)), n, np.full(n.size, number)], names)

    return runs.mapInArrow(run, "key bigint, n bigint, run bigint").groupBy("key").agg(
        F.sum("n").alias("n"), F.min("run").alias("run"))


def _spelled(runs: DataFrame, k: int, shorter, keys: DataFrame) -> DataFrame:
    """(h1..hk) of the phrases that ``keys`` (key, run) stand for, each key
    spelled out by its run alone: as many phrases as keys, but for keys that
    two phrases of a run share."""
    names = [f"h{j + 1}" for j in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (hashes, tokens, _), own in zip(_opened([batch.select(["words", "tokens", "run"])]), batch.column("keys")):
                cols, _ = _held(hashes, tokens, k, shorter.value)
                wanted = np.isin(_key(_mixed(cols)), own.values.to_numpy().view(np.uint64))
                yield from _in_parts([c[wanted] for c in cols], names)

    dealt = keys.groupBy("run").agg(F.collect_list("key").alias("keys"))  # no more of a run than it has phrases
    return runs.join(dealt, "run").select("words", "tokens", "run", "keys").mapInArrow(
        run, ", ".join(f"{n} bigint" for n in names))


def _alike(runs: DataFrame, k: int, shorter, keys) -> DataFrame:
    """(h1..hk) of all runs' phrases whose keys the bitmap ``keys`` holds."""
    names = [f"h{j + 1}" for j in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, tokens, _ in _opened(batches):
            cols, _ = _held(hashes, tokens, k, shorter.value)
            wanted = _holds(keys.value, _key(_mixed(cols)))
            yield from _in_parts([c[wanted] for c in cols], names)

    return runs.mapInArrow(run, ", ".join(f"{n} bigint" for n in names)).distinct()


def _candidates(runs: DataFrame, shorter, k: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(key, n, run) of the keys of k words that reach ``least``, and (h1..hk) of their phrases."""
    keys = written_once(_gathered(runs, k, shorter).where(F.col("n") >= least), "phrase_keys")
    return keys, written_once(_spelled(runs, k, shorter, keys.select("run", "key")), f"phrases_{k}")


class DoubleArray:
    """Double-array trie over phrases of word hashes, rows of ``phrases``
    padded with 0. A word is spelled by digits of ``DIGIT_BITS`` bits of its
    number among the trie's words, so a node has few children at most; the
    child by digit d stands at base[node] + d if check[] there names the node."""

    def __init__(self, phrases: np.ndarray):
        self.words = np.unique(phrases[phrases != 0])
        number = np.searchsorted(self.words, phrases).astype(np.int32)
        spelled = np.stack([self._digit(number, d).astype(np.int16) for d in range(self.digits)], axis=2)
        spelled[phrases == 0] = -1
        spelled = spelled.reshape(phrases.shape[0], -1)
        order = np.lexsort(spelled.T[::-1])
        spelled = spelled[order]
        # nodes are numbered level by level; an edge leads to each but the root
        node = np.zeros(order.size, np.int32)
        parents, labels, made = [], [], 1
        for level in range(spelled.shape[1]):
            live = np.flatnonzero(spelled[:, level] >= 0)
            above, label = node[live], spelled[live, level]
            fresh = np.concatenate(([True], (above[1:] != above[:-1]) | (label[1:] != label[:-1])))[:live.size]
            parents.append(above[fresh])
            labels.append(label[fresh])
            node[live] = made + np.cumsum(fresh) - 1
            made += int(fresh.sum())
        parent, label = np.concatenate(parents), np.concatenate(labels)
        shift, size = self._place(parent, label, made)
        slot = np.concatenate((np.zeros(1, np.int64), shift[parent] + label))
        self.base = np.zeros(size, np.int64)
        self.base[slot] = shift
        self.check = np.full(size, -1)
        self.check[slot[1:]] = slot[parent]
        self.ends = np.empty(order.size, np.int64)
        self.ends[order] = slot[node]

    @property
    def digits(self) -> int:
        return max(1, -(-int(self.words.size - 1).bit_length() // DIGIT_BITS))

    def _digit(self, number: np.ndarray, d: int) -> np.ndarray:
        return number >> (DIGIT_BITS * (self.digits - 1 - d)) & ((1 << DIGIT_BITS) - 1)

    @staticmethod
    def _place(parent: np.ndarray, label: np.ndarray, nodes: int) -> tuple[np.ndarray, int]:
        """The shift of each node, so that no two edges share a slot, and the
        size of the table. Wide nodes one by one, then all others at once in
        rounds of random shifts, those with one child into what is free."""
        rng = np.random.default_rng(1)
        alphabet = 1 << DIGIT_BITS
        size = label.size + label.size // 4 + 2 * alphabet
        used = np.zeros(size, bool)
        used[0] = True  # the root
        shift = np.zeros(nodes, np.int64)
        starts = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1]))[:parent.size])
        widths = np.diff(np.append(starts, parent.size))
        for k in starts[widths >= 8][np.argsort(-widths[widths >= 8], kind="stable")]:
            own = label[k:k + alphabet][parent[k:k + alphabet] == parent[k]]
            while True:
                tried = rng.integers(1, size - alphabet, 16)
                free = np.flatnonzero(~used[tried[:, None] + own].any(axis=1))
                if free.size:
                    break
                size += 2 * alphabet  # a fresh place at the end is always free
                used = np.concatenate((used, np.zeros(2 * alphabet, bool)))
                tried, free = np.array([size - 2 * alphabet]), np.zeros(1, np.int64)
                break
            shift[parent[k]] = tried[free[0]]
            used[shift[parent[k]] + own] = True
        some = np.repeat((widths > 1) & (widths < 8), widths)
        left = np.flatnonzero(some)
        while left.size:
            shift[parent[left]] = 0
            heads = np.unique(parent[left])
            shift[heads] = rng.integers(1, size - alphabet, heads.size)
            want = shift[parent[left]] + label[left]
            bad = used[want]
            _, first = np.unique(want, return_index=True)
            clash = np.ones(left.size, bool)
            clash[first] = False
            lost = np.isin(parent[left], parent[left][bad | clash])
            used[want[~lost]] = True
            left = left[lost]
        single = starts[widths == 1]
        free = alphabet + np.flatnonzero(~used[alphabet:])[:single.size]
        shift[parent[single]] = free - label[single]
        return shift, max(size, int(shift.max(initial=0)) + alphabet)

    #: Whether a word of the trie has these first bits; made when first asked.
    _known: np.ndarray | None = None

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """The number among the trie's words of each word of a run, or -1."""
        first = np.uint64(64 - KNOWN_BITS)
        if self._known is None:
            self._known = np.zeros(1 << KNOWN_BITS, bool)
            self._known[self.words >> first] = True
        some = np.flatnonzero(self._known[hashes >> first])  # most of a run's words are in no phrase of a block
        at = np.minimum(np.searchsorted(self.words, hashes[some]), self.words.size - 1)
        number = np.full(hashes.size, -1)
        number[some] = np.where(self.words[at] == hashes[some], at, -1)
        number[0] = -1
        return number

    def walk(self, hashes: np.ndarray, tokens: np.ndarray, width: int, firsts: np.ndarray) -> Iterator[np.ndarray]:
        """The states that a run's positions reach by 1 to ``width`` words.
        ``firsts``: the numbers of the words that begin a phrase."""
        number = self.numbered(hashes)
        begins = np.zeros(self.words.size + 1, bool)
        begins[firsts] = True
        place = np.flatnonzero(begins[number][tokens])
        state = np.zeros(place.size, np.int64)
        for level in range(width):
            inside = place + level < tokens.size
            place, state = place[inside], state[inside]
            word = number[tokens[place + level]]
            place, state, word = place[word >= 0], state[word >= 0], word[word >= 0]
            for d in range(self.digits):
                to = self.base[state] + self._digit(word, d)
                ok = self.check[to] == state
                place, state, word = place[ok], to[ok].astype(np.int64), word[ok]
            yield state

    def counts(self, runs: Iterator[tuple[np.ndarray, np.ndarray]], width: int, firsts: np.ndarray) -> np.ndarray:
        """How often each phrase stands at consecutive positions of the runs
        (hashes, tokens). States are added up once they are as many as the
        table has slots, so a run costs its own positions, not the table."""
        total, seen, held = np.zeros(self.check.size, np.int64), [], 0
        for hashes, tokens in runs:
            for state in self.walk(hashes, tokens, width, firsts):
                seen.append(state)
                held += state.size
            if held >= total.size:
                total += np.bincount(np.concatenate(seen), minlength=total.size)
                seen, held = [], 0
        if seen:
            total += np.bincount(np.concatenate(seen), minlength=total.size)
        return total[self.ends]

    def count(self, hashes: np.ndarray, tokens: np.ndarray, width: int, firsts: np.ndarray) -> np.ndarray:
        """:meth:`counts` of one run."""
        return self.counts(iter([(hashes, tokens)]), width, firsts)


#: The arrays of a block: its trie, and its phrases as numbers of the trie's words (-1 beyond a phrase's end).
_ARRAYS = {"words": np.uint64, "base": np.int32, "check": np.int32, "ends": np.int32, "phrases": np.int32}


def _blocks(candidates: DataFrame, names: list[str], block: int) -> tuple[DataFrame, int]:
    """The candidates with their block, and the number of blocks."""
    firsts = written_once(candidates.groupBy("h1").agg(F.count("*").alias("n")), "phrase_firsts")
    total = firsts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block))
    wide = firsts.where(F.col("n") > max(1, block // 8)).select("h1", F.lit(True).alias("wide"))  # 8 * blocks rows at most
    deal = F.when(F.col("wide"), F.xxhash64("h1", "h2")).otherwise(F.xxhash64("h1"))
    return candidates.join(F.broadcast(wide), "h1", "left").select(
        *names, F.pmod(deal, F.lit(blocks)).cast("int").alias("block")), blocks


def _tries(candidates: DataFrame, names: list[str]) -> DataFrame:
    """(block, the arrays) with a row per block of candidates."""
    def build(table: pa.Table) -> pa.Table:
        phrases = np.stack([table.column(n).to_numpy() for n in names], axis=1).view(np.uint64)
        trie = DoubleArray(phrases)
        numbers = np.where(phrases != 0, np.searchsorted(trie.words, phrases), -1)
        arrays = (trie.words, trie.base, trie.check, trie.ends, numbers)
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), **{
            n: pa.array([a.astype(kind).tobytes()], pa.binary()) for (n, kind), a in zip(_ARRAYS.items(), arrays)}})

    return candidates.groupBy("block").applyInArrow(build, "block int, " + ", ".join(f"{n} binary" for n in _ARRAYS))


def _opened_trie(arrays: tuple[bytes, ...], width: int) -> tuple[DoubleArray, np.ndarray]:
    """A block's trie and its phrases as numbers of the trie's words."""
    trie = DoubleArray.__new__(DoubleArray)
    trie.words, trie.base, trie.check, trie.ends, phrases = (
        np.frombuffer(x, t) for x, t in zip(arrays, _ARRAYS.values()))
    return trie, phrases.reshape(-1, width)


def phrase_counts(runs: DataFrame, candidates: DataFrame, width: int, block: int) -> DataFrame:
    """(h1..h<width>, key, a): how often each candidate (0 beyond its end)
    occurs in the runs, and its key."""
    names = [f"h{j + 1}" for j in range(width)]
    schema = ", ".join(f"{n} bigint" for n in [*names, "key", "a"])
    spark = runs.sparkSession
    dealt, blocks = _blocks(candidates, names, block)
    tries = written_once(_tries(dealt, names), "phrase_tries")
    found = spark.createDataFrame([], schema)
    for k in range(blocks):
        rows = tries.where(F.col("block") == k).drop("block").toArrow()
        if not rows.num_rows:
            continue
        shared = spark.sparkContext.broadcast(tuple(rows.column(n)[0].as_py() for n in _ARRAYS))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trie, phrases = _opened_trie(shared.value, width)
            total = trie.counts(((h, t) for h, t, _ in _opened(batches)), width, np.unique(phrases[:, 0]))
            seen = np.flatnonzero(total)
            yield from _in_parts([seen, total[seen]], ["place", "a"])

        def spell(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trie, phrases = _opened_trie(shared.value, width)
            for batch in batches:
                part = phrases[batch.column(0).to_numpy()]
                cols = [np.where(part[:, j] >= 0, trie.words[part[:, j]], np.uint64(0)) for j in range(width)]
                key = _key(_mixed(cols[:2]))
                for j in range(2, width):
                    key = np.where(part[:, j] >= 0, _key(_mixed(cols[:j + 1])), key)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c.view(np.int64)) for c in (*cols, key)], batch.column(1)], [*names, "key", "a"])

        # a phrase goes by its place in the block until its counts are summed
        sums = runs.mapInArrow(run, "place bigint, a bigint").groupBy("place").agg(F.sum("a").alias("a"))
        found = found.unionByName(written_once(sums.mapInArrow(spell, schema), "phrase_counts"))
        shared.destroy()  # one block at a time on the executors
    return found


def _score(l_: str, r: str) -> Column:
    """floor(SCALE * a * a / (l * r)): decimals, whose whole-number division is exact."""
    a, l_, r = (f"cast({c} as decimal(19,0))" for c in ("a", l_, r))
    return F.expr(f"({SCALE} * ({a} * {a})) div ({l_} * {r})")


def _best(scored: DataFrame, top: int, deals: int) -> DataFrame:
    """The first ``top`` of each language: first of each deal of it, then of
    what is left, so a task sorts a bounded share of a hot language."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    dealt = scored.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(deals)))
    first = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))) \
        .where(F.col("rank") <= top).drop("deal")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .where(F.col("rank") <= top)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                 top: int = TOP, run_tokens: int = RUN_TOKENS, filter_bits: int = FILTER_BITS,
                 block: int = BLOCK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases
    of two and three words."""
    spark = docs.sparkSession
    for seed in count():
        # runs and words in folders of their own: the words are done with first
        path = scratch_folder(spark, "phrase_runs")
        kind = F.when(F.col("word").isNull(), "run").otherwise("word")
        _runs(docs, text_col, lang_col, seed, run_tokens).withColumn("kind", kind).write.partitionBy("kind").parquet(path)
        both = spark.read.schema(f"{_RUN}, kind string").parquet(path)
        found = _frequent_words(both.where("kind = 'word'").select("lang", "word", "f"), seed, least, filter_bits)
        delete_folder(spark, f"{path}/kind=word")
        if found:
            break
        delete_folder(spark, path)
    frequent, singles, totals = found
    runs = both.where("kind = 'run'").select("words", "tokens", "run")
    keys2, pairs = _candidates(runs, singles, 2, least)
    twos = _bitmap(keys2, filter_bits)
    keys3, triples = _candidates(runs, twos, 3, least)
    zero = F.lit(0).cast("long").alias("h3")
    counted = phrase_counts(runs, pairs.select("h1", "h2", zero).unionByName(triples), LONGEST, block)
    # a key whose phrases do not add up to its sum has phrases that its run did not hold
    size = F.when(F.col("h3") == 0, 2).otherwise(3).alias("size")
    sums = counted.groupBy(size, "key").agg(F.sum("a").alias("known"))
    shared = written_once(
        keys2.select(F.lit(2).alias("size"), "key", "n").unionByName(keys3.select(F.lit(3).alias("size"), "key", "n"))
        .join(sums, ["size", "key"], "left").where(F.coalesce("known", F.lit(0)) != F.col("n")), "shared_keys")
    if shared.limit(1).collect():
        more = [_alike(runs, k, shorter, _bitmap(shared.where(F.col("size") == k), filter_bits))
                for k, shorter in ((2, singles), (3, twos))]
        rest = more[0].select("h1", "h2", zero).unionByName(more[1]).join(counted, ["h1", "h2", "h3"], "left_anti")
        counted = counted.unionByName(phrase_counts(runs, written_once(rest, "shared_phrases"), LONGEST, block))
    for bitmap in (singles, twos):
        bitmap.destroy()
    counted = counted.where(F.col("a") >= least).drop("key")

    def word(k: int) -> DataFrame:
        return frequent.select(F.col("h").alias(f"h{k}"), F.col("word").cast("string").alias(f"w{k}"),
                               F.col("f").alias(f"f{k}"), *(["lang"] if k == 1 else []))

    two = written_once(counted.where("h3 = 0").drop("h3").join(word(1), "h1").join(word(2), "h2"), "phrase_twos")
    three = counted.where("h3 <> 0")
    inside = three.select("h1", "h2", "a").unionByName(three.select(
        F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a")).groupBy("h1", "h2").agg(F.max("a").alias("longer"))
    kept = two.join(inside, ["h1", "h2"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < COVER * F.col("a")))
    scored2 = kept.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"),
                          F.col("f2").alias("r"), _score("f1", "f2").alias("score"))
    cut = (three.join(two.select("lang", "h1", "h2", "w1", "w2", "f1", F.col("a").alias("f12")), ["h1", "h2"])
           .join(two.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("w2").alias("w3"),
                            F.col("f2").alias("f3"), F.col("a").alias("f23")), ["h2", "h3"])
           .withColumn("s1", _score("f1", "f23")).withColumn("s2", _score("f12", "f3")))
    first = F.col("s1") <= F.col("s2")
    scored3 = cut.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                         F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                         F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"),
                         F.least("s1", "s2").alias("score"))
    deals = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best = _best(scored2.unionByName(scored3), top, deals)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
