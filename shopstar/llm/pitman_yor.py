"""Language-model scores from a hierarchical Pitman-Yor model.

A token's context restaurant is that of the word before it, each word its own.
All context restaurants share one parent, whose dishes are the
words and whose base is uniform over the known words and one unknown. Each
restaurant holds customers (tokens) at tables; a table is a customer of the
parent. Seating is sampled by Gibbs: given everything else, the tables of a
dish with ``c`` customers follow S_d(c, t) * a^t (generalised Stirling numbers,
a = strength left for new tables times the parent's probability), drawn exactly
for c <= EXACT; beyond it each customer's table-opening indicator is redrawn
given the last state, customers of near equal rank in one binomial draw.
Predictive probabilities are averaged over the samples; texts are scored by
them, perplexity is 10 ** (-score / n_tokens).

As Spark jobs: one pass tokenises the texts into blocks of documents. A block
sends its distinct (word, context) pairs, without documents, to slices dealt by
the hash of the pair, so that neither a frequent word nor a frequent context
meets in one task; the block's own tokens are kept as numbers of its pairs. A
slice adds up its pairs once. A pair seen once has one table in every sample,
so only pairs seen twice or more take part in the sweeps: the slices seat them
and send the tables per word and per context to the owners of the word's and
the context's hash; an owner adds them to the fixed tables, seats the parent's
dishes and replies the true totals for the next sweep. In the end the owners
send each sample's totals to the slices, these the averaged probabilities to
the blocks, which score their documents. The number of slices follows the
corpus, an eighth of them are owners; the driver sees a few sums per slice.
Each step is written to the shared folder, and deleted by kind once no later
step reads it.

Defined cases: null and empty texts are the end token alone; repeated rows are
scored each (and train as often); null ids count as held out (crc32 of the
empty string is 0); with nothing to train on, every token is unknown with
probability 1; an empty table gives an empty result; other columns are ignored.
Ids are integers.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.llm.common import LOWER, text_bytes
from shopstar.session import scratch_folder

STRENGTH = 1.0
BURN_IN, SAMPLES = 3, 3
#: Largest number of customers whose tables are drawn from the exact law.
EXACT = 48
#: Tokens a task gathers for one block; text bytes a slice stands for.
BLOCK_TOKENS, SLICE_BYTES = 2_000_000, 30_000_000
MIN_SLICES, SLICES_PER_OWNER = 12, 8
_START, _END = xxhash.xxh64_intdigest(b"\n^", 0), xxhash.xxh64_intdigest(b"\n$", 0)


class _Hashes(dict):
    """word -> 64-bit hash, remembered while it is small."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word, 0)
        return value


# --- blocks ---------------------------------------------------------------

def _runs(changed: np.ndarray) -> np.ndarray:
    """Starts of runs, from the flags that an element differs from the one before."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, changed.size + 1), bool), changed)))


def _slice_of(key: np.ndarray, slices: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, all lowest bytes of an array first: small numbers and
    small gaps leave planes of zeros."""
    head = ";".join(f"{a.dtype.str},{a.size}" for a in arrays).encode() + b"\n"
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(a.size, a.itemsize).T.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def _unpack(payload: bytes) -> list[np.ndarray]:
    data, out = zstandard.ZstdDecompressor().decompress(payload), []
    at = data.index(b"\n") + 1
    for kind, size in (x.split(",") for x in data[:at - 1].decode().split(";")):
        kind, size = np.dtype(kind), int(size)
        planes = np.frombuffer(data, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(size))
        at += size * kind.itemsize
    return out


def _gaps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _joined(payloads: list[bytes], n: int) -> list[np.ndarray]:
    """The ``n`` arrays of each payload, end to end."""
    parts = [_unpack(p) for p in payloads]
    return [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(n)]


def _pair_hash(word: np.ndarray, before: np.ndarray) -> np.ndarray:
    h = word * np.uint64(0x9E3779B185EBCA87) + before * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x165667B19E3779F9)
    return h ^ (h >> np.uint64(29))


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


#: A message: the slice, owner or home of a block it goes to; what it is; the slice or owner and the block it is from.
_MESSAGE = "to int, kind string, slice int, block bigint, payload binary"
Message = tuple[int, str, int, int, bytes]


def _messages(rows: list[Message]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                      ["to", "kind", "slice", "block", "payload"])


def _block_messages(block: int, ids: list, held: list[bool], hashes: list[np.ndarray],
                    slices: int) -> Iterator[Message]:
    """``p``, to each slice: distinct pairs (word, word before) of the block and
    their training counts. ``e``, to the block's home: tokens of each document,
    ids, id validity, and the pairs of each document's tokens, ascending."""
    sizes = np.array([h.size for h in hashes], np.int64)
    word = np.concatenate(hashes)
    before = np.concatenate(([0], word[:-1])).astype(np.uint64)
    before[np.cumsum(sizes) - sizes] = _START
    h = _pair_hash(word, before)
    order = np.argsort(h, kind="stable")
    h, word, before = h[order], word[order], before[order]
    first = _runs((np.diff(h) != 0) | (np.diff(word) != 0) | (np.diff(before) != 0))
    pair = np.empty(h.size, "<u4")
    pair[order] = np.repeat(np.arange(first.size), np.diff(np.append(first, h.size)))
    train = np.bincount(pair, np.repeat(~np.array(held, bool), sizes), first.size).astype("<u4")
    part = _slice_of(h[first], slices)
    cuts = np.searchsorted(part, np.arange(slices + 1))
    by_word = np.lexsort((before[first], word[first], part))  # a slice's pairs by word, then context
    number = np.empty(first.size, "<u4")
    number[by_word] = np.arange(first.size)
    pair, train, word, before = number[pair], train[by_word], word[first][by_word], before[first][by_word]
    for s in np.flatnonzero(np.diff(cuts)):
        own = slice(cuts[s], cuts[s + 1])
        runs = _runs(np.diff(word[own]) != 0)
        contexts, at = np.unique(before[own], return_inverse=True)
        yield int(s), "p", int(s), block, _pack(
            _gaps(word[own][runs]), np.diff(np.append(runs, at.size)).astype("<u4"), _gaps(contexts),
            at.astype("<u2" if contexts.size <= 1 << 16 else "<u4"), train[own])
    id_values = np.array([0 if i is None else i for i in ids], "<i8")
    id_valid = np.array([i is not None for i in ids], "u1")
    doc = np.repeat(np.arange(sizes.size, dtype=np.uint64), sizes)
    pair = np.sort(doc << np.uint64(32) | pair).astype("<u4")  # a document's pairs in ascending order: gaps
    gaps = _gaps(pair)
    starts = np.cumsum(sizes) - sizes
    gaps[starts] = pair[starts]
    yield _home(block, slices), "e", 0, block, _pack(sizes, id_values, id_valid, gaps)


def _pairs(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, word before and training count of each pair of a ``p`` message."""
    words, runs, contexts, at, train = _unpack(payload)
    return np.repeat(np.cumsum(words, dtype=np.uint64), runs), np.cumsum(contexts, dtype=np.uint64)[at], train


def _home(block: int, slices: int) -> int:
    return xxhash.xxh64_intdigest(str(block), 0) % slices


def _gather(docs: DataFrame, slices: int) -> DataFrame:
    """The messages of all blocks of the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, n_blocks = _Hashes(), TaskContext.get().partitionId() << 32, 0
        ids: list = []
        held: list[bool] = []
        hashes: list[np.ndarray] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, held, hashes, tokens, n_blocks
            rows = list(_block_messages(part + n_blocks, ids, held, hashes, slices))
            n_blocks += 1
            ids, held, hashes, tokens = [], [], [], 0
            return _messages(rows)

        for batch in batches:
            for doc_id, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                         batch.column(2)):
                words = text_bytes(text.as_py()).translate(LOWER).split()
                ids.append(doc_id)
                held.append(out)
                own = np.empty(len(words) + 1, np.uint64)
                own[:-1] = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                own[-1] = _END
                hashes.append(own)
                tokens += own.size
                if tokens >= BLOCK_TOKENS:
                    yield flush()
        if ids:
            yield flush()

    return docs.mapInArrow(run, _MESSAGE)


# --- seating ----------------------------------------------------------------

@dataclass
class Totals:
    """Of all training tokens: tokens, distinct words, and how many dishes have
    one and two customers, in the contexts and (by contexts they occur in) in
    the parent."""
    tokens: int
    words: int
    ones: tuple[int, int]
    twos: tuple[int, int]

    def discount(self, level: int) -> float:
        n1, n2 = self.ones[level], self.twos[level]
        return float(np.clip(n1 / (n1 + 2 * n2) if n1 else 0.5, 0.05, 0.95))


def log_stirling(d: float, size: int = EXACT) -> np.ndarray:
    """log S_d(c, t) for 1 <= t <= c <= size, else -inf."""
    out = np.full((size + 1, size + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(1, size + 1)
    for c in range(1, size):
        with np.errstate(divide="ignore"):
            old = out[c, 1:] + np.log(np.maximum(c - d * t, 0))
        out[c + 1, 1:] = np.logaddexp(out[c, :-1], old)
    return out


def _rank_edges(largest: int) -> np.ndarray:
    """Ranks 1, 2, ... cut into bins that grow by a twentieth of their rank."""
    edges = [1]
    while edges[-1] < largest:
        edges.append(edges[-1] + max(1, edges[-1] // 20))
    return np.array(edges, np.int64)


class Dishes:
    """Tables of many dishes, each given its customers and its ``a``."""

    def __init__(self, d: float):
        self.d, self.table = d, log_stirling(d)
        self.size: np.ndarray | None = None

    def _large(self, c: np.ndarray, a: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Redraws the openings of dishes with more than EXACT customers."""
        edges = _rank_edges(int(c.max()))
        n_bins = np.searchsorted(edges, c, side="left")
        starts = np.cumsum(n_bins) - n_bins
        bins = np.arange(n_bins.sum()) - np.repeat(starts, n_bins)
        own = np.repeat(np.arange(c.size), n_bins)
        lo = edges[bins]
        width = np.minimum(edges[bins + 1], c[own]) - lo
        rank = lo + (width - 1) / 2
        if self.size is None or not np.array_equal(self.size, c):
            # customers differ from the last state: start from a chain with d = 0
            self.size, self.open = c.copy(), width * a[own] / (a[own] + rank)

        def within(values: np.ndarray) -> np.ndarray:  # running sum, this bin excluded
            total = np.cumsum(values) - values
            return total - np.repeat(total[starts], n_bins)

        t = 1 + within(self.open)
        seated = np.maximum(rank - self.d * t, 0.5)
        later = (width - self.open) / seated
        tail = np.repeat(np.add.reduceat(later, starts), n_bins) - within(later) - later / 2
        odds = a[own] / seated * np.exp(-self.d * tail)
        self.open = rng.binomial(width, odds / (1 + odds)).astype(float)
        return 1 + np.add.reduceat(self.open, starts).astype(np.int64)

    def draw(self, c: np.ndarray, a: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        t = np.minimum(c, 1)
        small = np.flatnonzero((c > 1) & (c <= EXACT))
        for own in np.split(small[(order := np.argsort(c[small], kind="stable"))],
                            _runs(np.diff(c[small][order]) != 0)[1:]) if small.size else []:
            n = int(c[own[0]])
            for part in np.array_split(own, 1 + own.size * n // 4_000_000):
                law = self.table[n, 1:n + 1] + np.log(a[part])[:, None] * np.arange(1, n + 1)
                law = np.cumsum(np.exp(law - law.max(axis=1, keepdims=True)), axis=1)
                t[part] = 1 + (law < rng.random(part.size)[:, None] * law[:, -1:]).sum(axis=1)
        large = np.flatnonzero(c > EXACT)
        if large.size:
            t[large] = self._large(c[large], a[large], rng)
        return t


# --- jobs -------------------------------------------------------------------

Inbox = dict[str, list[tuple[int, int, bytes]]]


def _answers(messages: list[DataFrame], receivers: int, answer: Callable[[int, Inbox], Iterator[Message]],
             passed: str = "") -> DataFrame:
    """What the receivers answer to the messages, each given its own by kind,
    in the senders' order. Messages of the kind ``passed`` go through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inbox: dict[int, Inbox] = defaultdict(lambda: defaultdict(list))
        for batch in batches:
            for to, kind, part, block, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == passed:
                    yield _messages([(to, kind, part, block, payload)])
                else:
                    inbox[to][kind].append((part, block, payload))
        for to in sorted(inbox):
            own = inbox.pop(to)
            for rows in own.values():
                rows.sort()
            for row in answer(to, own):
                yield _messages([row])

    together = messages[0]
    for m in messages[1:]:
        together = together.unionByName(m)
    return together.repartitionById(receivers, F.col("to")).mapInArrow(run, _MESSAGE)


class Written:
    """Answers in the shared folder, a folder for each kind; a kind is deleted
    once no later step reads it."""

    def __init__(self, answers: DataFrame, name: str):
        self.spark, self.path = answers.sparkSession, scratch_folder(answers.sparkSession, name)
        key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(key, "false")
        self.spark.conf.set(key, "true")  # the shuffle's files are of no use once the answers are written
        try:
            answers.withColumn("folder", F.col("kind")).write.partitionBy("folder").parquet(self.path)
        finally:
            self.spark.conf.set(key, before)

    def __getitem__(self, kind: str) -> DataFrame:
        return self.spark.read.schema(f"{_MESSAGE}, folder string").parquet(self.path).where(
            F.col("folder") == kind).drop("folder")

    def drop(self, *kinds: str) -> None:
        context = self.spark.sparkContext
        for kind in kinds:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/folder={kind}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

    def sums(self, n: int) -> list[int]:
        """The ``t`` messages (a few numbers from each sender), added up."""
        total = [0] * n
        for r in self["t"].select("payload").toLocalIterator():
            total = [a + int(x) for a, x in zip(total, _unpack(bytes(r.payload))[0])]
        return total


def _per(numbers: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(numbers, values, n).astype(np.int64)


def _add_up(me: int, inbox: Inbox, owners: int) -> Iterator[Message]:
    """A slice's pairs from its blocks. ``k``: pairs of each word, context number
    and training count of each pair; ``k2``: of the pairs seen twice or more
    the numbers of word and context among those of such pairs, the count, and
    words and contexts at each owner; ``i``: the pairs of each block; ``m``, to
    owners: words and contexts with their customers, dishes of one customer and
    larger dishes; ``t``: pairs seen once and twice."""
    rows = [(block, _pairs(payload)) for _, block, payload in inbox["p"]]
    word, before, train = (np.concatenate([r[k] for _, r in rows]) for k in range(3))
    order = np.lexsort((before, word))
    word, before = word[order], before[order]
    first = _runs((np.diff(word) != 0) | (np.diff(before) != 0))
    at = np.empty(order.size, "<u4")
    at[order] = np.repeat(np.arange(first.size, dtype="<u4"), np.diff(np.append(first, order.size)))
    count = np.add.reduceat(train[order].astype(np.int64), first)
    words, w = np.unique(word[first], return_inverse=True)
    contexts, u = np.unique(before[first], return_inverse=True)
    yield me, "k", me, 0, _pack(np.bincount(w, minlength=words.size).astype("<u4"), u.astype("<u4"), count.astype("<u4"))
    edges, places = np.arange(owners + 1), []
    seen = np.flatnonzero(count > 1)
    for names, number in ((words, w), (contexts, u)):
        again = np.unique(number[seen])
        places += [np.searchsorted(again, number[seen]).astype("<u4"),
                   np.searchsorted(_slice_of(names[again], owners), edges)]
    yield me, "k2", me, 0, _pack(places[0], places[2], count[seen], places[1], places[3])
    ends = _offsets([r[0].size for _, r in rows])
    yield me, "i", me, 0, _pack(np.array([b for b, _ in rows]), np.diff(ends),
                                np.concatenate([_gaps(at[a:b]) for a, b in zip(ends, ends[1:])]))
    sides = []
    for names, number in ((words, w), (contexts, u)):
        cuts = np.searchsorted(_slice_of(names, owners), edges)
        sides.append((cuts, (names, *(_per(number, x, names.size) for x in (count, count == 1, count > 1)))))
    for j in np.flatnonzero(sum(np.diff(cuts) for cuts, _ in sides)):
        yield int(j), "m", me, 0, _pack(*[
            f(a[cuts[j]:cuts[j + 1]]) for cuts, (names, *sums) in sides
            for f, a in ((_gaps, names), *((lambda x: x.astype("<u4"), x) for x in sums))])
    yield me, "t", me, 0, _pack(np.array([(count == 1).sum(), (count == 2).sum()]))


def _own(me: int, inbox: Inbox) -> Iterator[Message]:
    """An owner's words and contexts. ``x``: for both, their numbers in each
    slice's order, which of them the slice seats, customers and the tables of
    dishes of one customer; ``r``, to slices: the first tables, one for each
    dish; ``t``: tokens, words, words in one and in two contexts, tables,
    parent's tables."""
    rows = [(part, _unpack(payload)) for part, _, payload in inbox["m"]]
    parts, out, told = np.array([part for part, _ in rows]), [], []
    for k in (0, 4):
        names = np.concatenate([np.cumsum(r[k], dtype=np.uint64) for _, r in rows])
        customers, single, larger = (np.concatenate([r[k + j] for _, r in rows]).astype(np.int64) for j in (1, 2, 3))
        names, number = np.unique(names, return_inverse=True)
        sums = [_per(number, x, names.size) for x in (customers, single, larger)]
        at = _offsets([r[k].size for _, r in rows])
        out += [at, number.astype("<u4"), larger > 0, sums[0], sums[1]]
        told.append((at, number, larger > 0, sums[0], sums[1] + sums[2]))
    yield me, "x", me, 0, _pack(parts, *out)
    (_, _, _, count, dishes), (_, _, _, _, tables) = told
    yield from _replies(me, parts, [t[:3] for t in told], dishes, np.minimum(count, 1), tables)
    yield me, "t", me, 0, _pack(np.array([count.sum(), (count > 0).sum(), (dishes == 1).sum(), (dishes == 2).sum(),
                                          dishes.sum(), (count > 0).sum()]))


def _replies(me: int, parts: np.ndarray, sides: list, tables: np.ndarray, s: np.ndarray,
             in_context: np.ndarray) -> Iterator[Message]:
    """``r``, to slices: of what they seat, tables of each word, its tables in
    the parent, tables of each context."""
    (w_at, w, w_seen), (u_at, u, u_seen) = sides
    for k, part in enumerate(parts):
        a, b = slice(w_at[k], w_at[k + 1]), slice(u_at[k], u_at[k + 1])
        own_w, own_u = w[a][w_seen[a]], u[b][u_seen[b]]
        yield int(part), "r", me, 0, _pack(*[x.astype("<u4") for x in (tables[own_w], s[own_w], in_context[own_u])])


def _parent(me: int, inbox: Inbox, new0: float, d0: float, sweep: int, sampled: bool) -> Iterator[Message]:
    """An owner's totals and parent seating: ``r`` to the slices; ``h``, kept of
    a sample: tables of each word, its tables in the parent, tables of each
    context; ``t``: the sums of the first two."""
    parts, w_at, w, w_seen, _, tables, u_at, u, u_seen, _, in_context = _unpack(inbox["x"][0][2])
    more = _joined([payload for _, _, payload in inbox["m"]], 2)
    tables = tables + _per(w[w_seen], more[0], tables.size)
    in_context = in_context + _per(u[u_seen], more[1], in_context.size)
    rng = np.random.default_rng([me, sweep, 21])
    s = Dishes(d0).draw(tables, np.full(tables.size, new0), rng)
    yield from _replies(me, parts, [(w_at, w, w_seen), (u_at, u, u_seen)], tables, s, in_context)
    if sampled:
        yield me, "h", me, sweep, _pack(*[x.astype("<u4") for x in (tables, s, in_context)])
    yield me, "t", me, 0, _pack(np.array([tables.sum(), s.sum()]))


def _word_p(tables: np.ndarray, s: np.ndarray, totals: Totals, strength: float, t_all: int, s_all: int) -> np.ndarray:
    """The parent's probability of words."""
    d0 = totals.discount(1)
    return (tables - d0 * s + (strength + d0 * s_all) / (totals.words + 1)) / (strength + t_all)


def _sweep(me: int, inbox: Inbox, totals: Totals, strength: float, t_all: int, s_all: int, sweep: int,
           sampled: bool) -> Iterator[Message]:
    """A slice's next seating of its pairs seen twice or more. ``s``: tables,
    openings of large dishes, sum of the samples' tables; ``m``, to owners:
    tables per word and context."""
    word, context, c, w_cuts, u_cuts = _unpack(inbox["k2"][0][2])
    t, open_, total = (_unpack(inbox["s"][0][2]) if inbox["s"] else
                       (np.ones(c.size, "<u4"), np.zeros(0), np.zeros(c.size, "<u4")))
    tw, s, tu = _joined([payload for _, _, payload in inbox["r"]], 3)
    d = totals.discount(0)
    dishes, rng = Dishes(d), np.random.default_rng([me, sweep, 20])
    if open_.size:
        dishes.size, dishes.open = c[c > EXACT], open_.astype(float)
    if c.size:
        p = _word_p(tw, s, totals, strength, t_all, s_all)
        t = dishes.draw(c, (strength + d * tu)[context] * p[word], rng)
    opened = np.zeros(0) if dishes.size is None else dishes.open
    yield me, "s", me, 0, _pack(t.astype("<u4"), opened.astype("<u4"),
                                (total + t if sampled else total).astype("<u4"))
    tw, tu = _per(word, t, tw.size).astype("<u4"), _per(context, t, tu.size).astype("<u4")
    for j in np.flatnonzero(np.diff(w_cuts) + np.diff(u_cuts)):
        yield int(j), "m", me, 0, _pack(tw[w_cuts[j]:w_cuts[j + 1]], tu[u_cuts[j]:u_cuts[j + 1]])


def _samples(me: int, inbox: Inbox) -> Iterator[Message]:
    """``f``, an owner's words and contexts to the slices that hold them:
    customers and, of each sample, tables (and, of words, the parent's)."""
    parts, w_at, w, _, count, _, u_at, u, _, customers, _ = _unpack(inbox["x"][0][2])
    kept = [_unpack(payload) for _, _, payload in inbox["h"]]
    of_words = [count, *[a for tables, s, _ in kept for a in (tables, s)]]
    of_contexts = [customers, *[in_context for _, _, in_context in kept]]
    for k, part in enumerate(parts):
        own_w, own_u = w[w_at[k]:w_at[k + 1]], u[u_at[k]:u_at[k + 1]]
        yield int(part), "f", me, 0, _pack(*[a[own_w].astype("<u4") for a in of_words],
                                           *[a[own_u].astype("<u4") for a in of_contexts])


def _probabilities(inbox: Inbox, totals: Totals, strength: float, sums: list[tuple[int, int]]) -> tuple:
    """(probability, word's customers) of each pair of a slice, averaged over
    the samples, whose sums of tables are ``sums``."""
    runs, context, count = _unpack(inbox["k"][0][2])
    n, d = len(sums), totals.discount(0)
    told = [x.astype(np.int64) for x in _joined([payload for _, _, payload in inbox["f"]], 2 + 3 * n)]
    of_word, samples, customers, in_context = told[0], told[1:1 + 2 * n], told[1 + 2 * n], told[2 + 2 * n:]
    word = np.repeat(np.arange(runs.size), runs)
    tables = np.where(count == 1, n, 0)
    tables[count > 1] = _unpack(inbox["s"][0][2])[2]
    out = (n * count.astype(np.int64) - d * tables) / (strength + customers)[context]
    for k, (t_all, s_all) in enumerate(sums):
        p = _word_p(samples[2 * k], samples[2 * k + 1], totals, strength, t_all, s_all)
        out += ((strength + d * in_context[k]) / (strength + customers))[context] * p[word]
    return out / n, of_word[word]


def _answer_blocks(me: int, inbox: Inbox, totals: Totals, strength: float, sums: list[tuple[int, int]],
                   slices: int) -> Iterator[Message]:
    """``q``, to the blocks' homes: score and word's training count of each pair."""
    p, count = _probabilities(inbox, totals, strength, sums)
    score, count = np.log10(p).astype("<f4"), count.astype("<u4")
    blocks, sizes, gaps = _unpack(inbox["i"][0][2])
    ends = _offsets(sizes)
    for k, block in enumerate(blocks):
        own = np.cumsum(gaps[ends[k]:ends[k + 1]], dtype=np.int64)
        yield _home(int(block), slices), "q", me, int(block), _pack(score[own], count[own])


def _block_scores(messages: list[DataFrame], totals: Totals, slices: int) -> DataFrame:
    """The documents' scores, a block at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: dict[int, bytes] = {}
        pairs: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        for batch in batches:
            for _, kind, part, block, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == "e":
                    tokens[block] = payload
                else:
                    pairs[block].append((part, payload))
        for block in sorted(tokens):
            sizes, ids, valid, gaps = _unpack(tokens.pop(block))
            score, count = _joined([payload for _, payload in sorted(pairs.pop(block))], 2)
            base = np.log10((count + 0.1) / (totals.tokens + 0.1 * (totals.words + 1)))
            starts = np.cumsum(sizes) - sizes
            pair = np.cumsum(gaps, dtype=np.int64)
            pair -= np.repeat(pair[starts] - gaps[starts], sizes)
            n_known, base, score = (np.add.reduceat(x[pair], starts) for x in
                                    ((count > 0).astype(np.int64), base, score.astype(float)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=valid == 0), *map(pa.array, (sizes, n_known, base, score))],
                ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    together = messages[0].unionByName(messages[1])
    return together.repartitionById(slices, F.col("to")).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    strength: float = STRENGTH, burn_in: int = BURN_IN,
                    samples: int = SAMPLES, slice_bytes: int = SLICE_BYTES,
                    min_slices: int = MIN_SLICES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity) per row of ``docs``; see the module's text."""
    key = F.col(id_col).cast("long")

    def held(c):
        return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 10 == 0

    texts = docs.select(key.alias("doc_id"), held(key).alias("held_out"), F.col(text_col).alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slices = max(min_slices, -(-size // slice_bytes))
    owners = max(min_slices, slices // SLICES_PER_OWNER)
    parts = Written(_answers([_gather(texts, slices)], slices, lambda me, x: _add_up(me, x, owners), passed="e"),
                    "slices")
    told = Written(_answers([parts["m"]], owners, _own), "owners")
    parts.drop("m")
    n1, n2 = parts.sums(2)
    tokens, words, k1, k2, t_all, s_all = told.sums(6)
    totals = Totals(tokens, words, (n1, k1), (n2, k2))
    d0, numbers = totals.discount(1), told["x"]
    state: list[DataFrame] = []
    kept: list[DataFrame] = []
    sums: list[tuple[int, int]] = []
    for k in range(burn_in + samples):
        sampled = k >= burn_in
        moved = Written(_answers([parts["k2"], told["r"], *state], slices,
                                 lambda me, x, a=(t_all, s_all, k, sampled): _sweep(me, x, totals, strength, *a)),
                        "seats")
        told.drop("r")
        if k:
            last.drop("s")
        new0 = (strength + d0 * s_all) / (totals.words + 1)
        told = Written(_answers([numbers, moved["m"]], owners,
                                lambda me, x, a=(new0, d0, k, sampled): _parent(me, x, *a)), "parents")
        moved.drop("m")
        t_all, s_all = told.sums(2)
        last, state = moved, [moved["s"]]
        if sampled:
            kept.append(told["h"])
            sums.append((t_all, s_all))
    found = Written(_answers([numbers, *kept], owners, _samples), "samples")["f"]
    scores = _answers([parts["k"], parts["i"], found, *state], slices,
                      lambda me, x: _answer_blocks(me, x, totals, strength, sums, slices))
    out = _block_scores([parts["e"], scores], totals, slices)
    return out.select(
        "doc_id", held(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
