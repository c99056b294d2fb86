"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is normalised (one dummy blank in front, blanks escaped) and cut into
words where no piece of the model can reach across: before a run of blanks, and
around characters that no longer piece holds. The distinct new words of a
batch are merged together: one flat array of symbols, the rank of every
adjacent pair by binary search in the model's pair table, the least rank of
each word by a segmented minimum, the leftmost pairs of that rank joined in all
words at once, the array compacted; until no pair is left. A word whose least
rank could make a better pair than itself joins its leftmost pair only, so the
order is the library's at every step. Words of more than ``LONG_WORD`` symbols
(white-space-free runs) go through the same merges one at a time with a heap,
which does not take a round over the whole word for each merge.

Rows are encoded where they are: nothing is shuffled, a task holds one slice of
text and a word cache of bounded size, and a lost task is simply run again. The
model's path is a parameter; workers read it from the installed package.

Defined cases: null and empty texts have no ids and decode to the empty text;
characters outside the vocabulary become their bytes' pieces (the unknown
piece if the model has none); repeated rows and null ids give a row each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
#: Symbols of a word beyond which merges are taken from a heap.
LONG_WORD = 1024
#: Characters encoded together, and words kept in a task's cache.
SLICE_CHARS = 1 << 21
CACHE_WORDS = 1 << 18

_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE, _UNUSED = 1, 2, 3, 4, 6, 5
_NONE = np.iinfo(np.int64).max


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``starts[i] .. starts[i] + lengths[i] - 1`` for all i in order."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if ends.size else 0) + np.repeat(starts - (ends - lengths), lengths)


class _Table:
    """Byte strings end to end, fetched for many indices at once."""

    def __init__(self, values: list[bytes]):
        self.lengths = np.fromiter(map(len, values), np.int64, len(values))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(values), np.uint8)

    def fetch(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes, and where each index's bytes end."""
        lengths = self.lengths[index]
        return self.flat[_ragged(self.starts[index], lengths)], np.cumsum(lengths)


class Model:
    """Symbols, pair ranks and byte tables of a BPE model file. Symbols are
    piece ids; characters that only occur inside pieces get numbers above."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        if (proto.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces
                or not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix
                or kinds & {_USER, _UNUSED}):
            raise ValueError("only BPE models with identity normalisation and plain pieces are supported")
        self.dummy = spec.add_dummy_prefix
        pieces = {p.piece: k for k, p in enumerate(proto.pieces) if p.type == _NORMAL}
        inner = {c for p in pieces if len(p) > 1 for c in p}
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a piece with a blank behind other characters reaches across words")
        symbols = dict(pieces)
        for c in sorted(inner - set(pieces)):
            symbols[c] = len(proto.pieces) + len(symbols) - len(pieces)
        self.n_symbols = len(proto.pieces) + len(symbols) - len(pieces)
        # equal scores are equal ranks
        scores = sorted({-proto.pieces[k].score for k in pieces.values()})
        place = {s: r for r, s in enumerate(scores)}
        rank = {p: place[-proto.pieces[k].score] for p, k in pieces.items()}
        pairs = []
        unsafe = np.zeros(self.n_symbols, bool)
        for piece, k in pieces.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in symbols and right in symbols:
                    pairs.append((symbols[left] * self.n_symbols + symbols[right], rank[piece], k))
                for part in (left, right):
                    if part in rank and rank[part] >= rank[piece]:
                        unsafe[symbols[part]] = True
        keys, ranks, merged = (np.array(x, np.int64) for x in zip(*sorted(pairs)))
        self.keys, self.ranks, self.merged = keys, ranks, merged
        self.unsafe = unsafe
        self.pairs = {k: (r, m) for k, r, m in zip(keys.tolist(), ranks.tolist(), merged.tolist())}
        self.chars = {c: k for c, k in symbols.items() if len(c) == 1}
        alone = "" if "\n" in inner else "\n"
        self.words = re.compile(f"{BLANK}+[^{BLANK}{alone}]*|[^{BLANK}{alone}]+" + (f"|{alone}+" if alone else ""))
        self.unk = next(k for k, p in enumerate(proto.pieces) if p.type == _UNKNOWN)
        self.byte_ids = np.full(256, self.unk, np.int64)
        self.has_bytes = _BYTE in kinds
        out: list[bytes] = []
        for k, p in enumerate(proto.pieces):
            if p.type == _BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = k
                out.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == _CONTROL:
                out.append(b"")
            else:
                out.append(b" \xe2\x81\x87 " if p.type == _UNKNOWN else p.piece.replace(BLANK, " ").encode())
        self.is_byte = np.array([p.type == _BYTE for p in proto.pieces])
        self.is_piece = np.zeros(self.n_symbols, bool)
        self.is_piece[list(pieces.values())] = True
        self.text = _Table(out)
        self.decimal = _Table([f"{k},".encode() for k in range(len(proto.pieces))])

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``_NONE``: no piece) and its place in the table."""
        key = np.where((left < 0) | (right < 0), -1, left * self.n_symbols + right)
        at = np.minimum(np.searchsorted(self.keys, key), self.keys.size - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE), at

    def _merge_rounds(self, symbols: np.ndarray, points: np.ndarray, word: np.ndarray):
        """Final (symbols, code points, words). ``points`` is the character of
        a symbol outside the vocabulary. Finished words leave the rounds."""
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while symbols.size:
            ranks = np.full(symbols.size, _NONE)
            at = np.zeros(symbols.size, np.int64)
            ranks[:-1], at[:-1] = self._pair_ranks(symbols[:-1], symbols[1:])
            ranks[:-1][word[1:] != word[:-1]] = _NONE
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lengths = np.diff(np.append(first, symbols.size))
            least = np.repeat(np.minimum.reduceat(ranks, first), lengths)
            ended = least == _NONE
            if ended.any():
                done.append((symbols[ended], points[ended], word[ended]))
                going = ~ended
                symbols, points, word = symbols[going], points[going], word[going]
                ranks, at, least = ranks[going], at[going], least[going]
                if not symbols.size:
                    break
                first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
                lengths = np.diff(np.append(first, symbols.size))
            hit = np.flatnonzero(ranks == least)
            # of overlapping pairs every second one, from the left
            fresh = np.concatenate(([True], np.diff(hit) > 1))
            start = np.maximum.accumulate(np.where(fresh, np.arange(hit.size), 0))
            hit = hit[(np.arange(hit.size) - start) % 2 == 0]
            leftmost = np.concatenate(([True], word[hit[1:]] != word[hit[:-1]]))
            joined = self.merged[at[hit]]
            # one word's pairs of a rank may be of several pieces with equal scores
            risky = np.zeros(symbols.size, bool)
            risky[hit] = self.unsafe[joined]
            some = np.logical_or.reduceat(risky, first)
            take = leftmost | ~np.repeat(some, lengths)[hit]
            hit, joined = hit[take], joined[take]
            symbols[hit] = joined
            stays = np.ones(symbols.size, bool)
            stays[hit + 1] = False
            symbols, points, word = symbols[stays], points[stays], word[stays]
        return [np.concatenate(x) for x in zip(*done)] if done else (symbols, points, word)

    def _merge_heap(self, symbols: list[int], points: list[int]) -> tuple[list[int], list[int]]:
        """The same merges for one long word, least rank and then leftmost first."""
        n, pairs, size = len(symbols), self.pairs, self.n_symbols
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < n and symbols[a] >= 0 and symbols[b] >= 0:
                found = pairs.get(symbols[a] * size + symbols[b])
                if found:
                    heapq.heappush(heap, (found[0], a, b, symbols[a], symbols[b]))

        for k in range(n - 1):
            offer(k, k + 1)
        gone = bytearray(n)
        while heap:
            _, a, b, x, y = heapq.heappop(heap)
            if gone[a] or gone[b] or symbols[a] != x or symbols[b] != y or after[a] != b:
                continue
            symbols[a] = pairs[x * size + y][1]
            gone[b], after[a] = 1, after[b]
            if after[b] < n:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        left = [k for k in range(n) if not gone[k]]
        return [symbols[k] for k in left], [points[k] for k in left]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and the number of ids of each."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        get = self.chars.get
        whole = "".join(words)
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        symbols = np.fromiter((get(c, -1) for c in whole), np.int64, len(whole))
        word = np.repeat(np.arange(len(words)), sizes)
        long = np.repeat(sizes > LONG_WORD, sizes)
        parts = [self._merge_rounds(symbols[~long], points[~long], word[~long])]
        starts = np.cumsum(sizes) - sizes
        for w in np.flatnonzero(sizes > LONG_WORD):
            own = slice(starts[w], starts[w] + sizes[w])
            s, p = self._merge_heap(symbols[own].tolist(), points[own].tolist())
            parts.append((np.array(s, np.int64), np.array(p, np.int64), np.full(len(s), w)))
        symbols, points, word = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(word, kind="stable")
        symbols, points, word = symbols[order], points[order], word[order]
        # characters that are no piece of their own: their bytes
        odd = np.flatnonzero((symbols < 0) | ~self.is_piece[np.maximum(symbols, 0)])
        if odd.size:
            spelled = [chr(c).encode("utf-8", "surrogatepass") if self.has_bytes else b"\0"
                       for c in points[odd].tolist()]
            widths = np.ones(symbols.size, np.int64)
            widths[odd] = np.fromiter(map(len, spelled), np.int64, odd.size)
            symbols, word = np.repeat(symbols, widths), np.repeat(word, widths)
            ends = np.cumsum(widths)
            if self.has_bytes:
                symbols[_ragged((ends - widths)[odd], widths[odd])] = self.byte_ids[
                    np.frombuffer(b"".join(spelled), np.uint8)]
            else:
                symbols[(ends - widths)[odd]] = self.unk
        return symbols, np.bincount(word, minlength=len(words))

    def split(self, text: str, first: bool = True) -> list[str]:
        """The words of a text, or of a later slice of one."""
        if not text:
            return []
        return self.words.findall((BLANK if self.dummy and first else "") + text.replace(" ", BLANK))

    def encode(self, text: str | None) -> list[int]:
        return self.encode_words(self.split(text or ""))[0].tolist()

    def decode_bytes(self, ids: np.ndarray, first: bool = True) -> bytes:
        """The text of ids in UTF-8, without the dummy blank if ``first``."""
        if not ids.size:
            return b""
        flat, _ = self.text.fetch(ids)
        value = flat.tobytes()
        if self.is_byte[ids].any():
            try:
                value.decode()
            except UnicodeDecodeError:
                value = b"".join(self._runs(ids))
        strip = first and self.dummy and self.is_piece[ids[0]] and value[:1] == b" "
        return value[1:] if strip else value

    def _runs(self, ids: np.ndarray) -> Iterator[bytes]:
        """Pieces, with each broken byte of a run of byte pieces replaced."""
        edges = np.flatnonzero(np.diff(self.is_byte[ids])) + 1
        for part in np.split(ids, edges):
            value = self.text.fetch(part)[0].tobytes()
            while self.is_byte[part[0]] and value:
                try:
                    value.decode()
                    break
                except UnicodeDecodeError as e:
                    yield value[:e.start] + "�".encode()
                    value = value[e.start + 1:]
            yield value

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_bytes(np.fromiter(ids, np.int64)).decode()


@lru_cache(maxsize=2)
def load(name: str) -> Model:
    import public_tokenizers
    return Model(public_tokenizers.path(name))


class Encoder:
    """Ids of many texts, with a cache of words."""

    def __init__(self, model: Model, cache_words: int = CACHE_WORDS):
        self.model, self.cache_words = model, cache_words
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.starts = self.counts

    def __call__(self, slices: list[tuple[str, bool]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all slices (text, is it the first of its text) end to end,
        and the number of ids of each slice."""
        if len(self.index) > self.cache_words:
            self._clear()
        split = [self.model.split(text, first) for text, first in slices]
        new = list(dict.fromkeys(w for words in split for w in words if w not in self.index))
        if new:
            ids, counts = self.model.encode_words(new)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.flat = np.concatenate((self.flat, ids))
            self.counts = np.concatenate((self.counts, counts))
            self.starts = np.cumsum(self.counts) - self.counts
        total = sum(map(len, split))
        get = self.index.__getitem__
        at = np.fromiter((get(w) for words in split for w in words), np.int64, total)
        counts = self.counts[at]
        ends = np.cumsum([0, *map(len, split)])
        sums = np.concatenate(([0], np.cumsum(counts)))
        return self.flat[_ragged(self.starts[at], counts)], sums[ends[1:]] - sums[ends[:-1]]


def _slices(text: str, size: int) -> Iterator[tuple[str, bool]]:
    """A text cut before blanks, so that no word is cut."""
    start = 0
    while start < len(text):
        end = start + size
        if end < len(text):
            found = re.compile(f"(?<=[^ {BLANK}])[ {BLANK}]").search(text, end)
            end = found.start() if found else len(text)
        yield text[start:end], start == 0
        start = end


_FIELDS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL,
                     with_ids: bool = True, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """A row per document: doc_id, n_tokens, the hashes of its ids and of the
    text that they decode to and, if ``with_ids``, ids and decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        encode = Encoder(m)

        def done(ids: list, parts: list[tuple[int, str, bool]], id_type) -> pa.RecordBatch:
            n = np.zeros(len(ids), np.int64)
            hashed = [hashlib.sha256() for _ in ids]
            decoded = [hashlib.sha256() for _ in ids]
            kept: list[list[np.ndarray]] = [[] for _ in ids]
            texts: list[list[bytes]] = [[] for _ in ids]

            def work(group: list[tuple[int, str, bool]]) -> None:
                flat, counts = encode([(t, first) for _, t, first in group])
                digits, at = m.decimal.fetch(flat)
                at = np.concatenate(([0], at))
                ends = np.cumsum(counts)
                for (row, _, first), lo, hi in zip(group, (ends - counts).tolist(), ends.tolist()):
                    if lo == hi:
                        continue
                    # a comma between slices, none at the end
                    hashed[row].update((b"," if n[row] else b"") + digits[at[lo]:at[hi] - 1].tobytes())
                    n[row] += hi - lo
                    text = m.decode_bytes(flat[lo:hi], first)
                    decoded[row].update(text)
                    if with_ids:
                        kept[row].append(flat[lo:hi])
                        texts[row].append(text)

            group, size = [], 0
            for part in parts:
                group.append(part)
                size += len(part[1])
                if size >= slice_chars:
                    work(group)
                    group, size = [], 0
            if group:
                work(group)
            arrays = [pa.array(ids, id_type), pa.array(n), pa.array([h.hexdigest() for h in hashed]),
                      pa.array([h.hexdigest() for h in decoded])]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                arrays += [pa.array([np.concatenate([*k, np.zeros(0, np.int64)]).astype(np.int32) for k in kept],
                                    pa.list_(pa.int32())), pa.array([b"".join(t).decode() for t in texts])]
                names += ["ids", "decoded"]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            ids, parts, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = text.as_py() or ""
                parts += [(len(ids), s, first) for s, first in _slices(value, slice_chars)]
                ids.append(doc_id)
                size += len(value)
                if size >= slice_chars:
                    yield done(ids, parts, batch.column(0).type)
                    ids, parts, size = [], [], 0
            if ids:
                yield done(ids, parts, batch.column(0).type)

    schema = (f"doc_id {docs.schema[id_col].dataType.simpleString()}, {_FIELDS}"
              + ", ids array<int>, decoded string" * with_ids)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
