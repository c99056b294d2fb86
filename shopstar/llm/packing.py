"""Hierarchical multi-length packing of tokenised documents.

A document's whole windows of the longest context are sequences of their own;
its rest is routed to the shortest context size (tier) that holds it. Tiers
are packed from the longest: a window takes a piece of its tier, then its gap
is filled from the shorter tiers, longest fitting piece first, and closed by a
cut of the next piece. What is left at the end fills windows of falling size,
so that a partition pads one sequence at most. Sequences are then dealt to
step groups of near equal cost (their tokens, and length squared for attention).

One narrow pass: each partition tokenises and packs its own rows as they
stream by, in pools of ``pool_tokens``, so nothing is shuffled, memory is
bounded, and a lost task is simply run again. Sequence and group numbers carry
the partition in their upper bits.

Token ids are those of the byte-level BPE file. Its added tokens are cut out of
a text first, as the tokenizers library does, and the text between them is
computed by tiktoken with the same vocabulary as ranks (the same ids, about four
times as fast); a text that tiktoken refuses, and any text of a file whose added
tokens have conditions of their own, goes to the tokenizers library itself.

Defined cases: null and empty texts are the end token alone; repeated rows are
packed each; null ids are kept; an empty table gives no pieces; other columns
are ignored.
"""

from __future__ import annotations

import base64
import heapq
import json
import os
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (128, 256, 512, 1024)
END = 0
TOKENIZER = "byte_bpe_50k"
#: Tokens that a task gathers before it packs them.
POOL_TOKENS = 1 << 20
#: Tokens in a step group.
STEP_TOKENS = 1 << 16


class Encoder:
    """Ids of texts under the tokenizer file ``<name>.json``, with
    add_special_tokens=False: an added token's string in a text is that token."""

    def __init__(self, name: str = TOKENIZER):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN,
                                       mergeable_ranks=ranks, special_tokens={})
        self._json, self._library = public_tokenizers.path(f"{name}.json"), None
        with open(self._json, encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        self._added = {t["content"]: t["id"] for t in added}
        self._plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
        # the longest first, so that none hides behind another that begins it
        self._cut = re.compile(f"({'|'.join(map(re.escape, sorted(self._added, key=len, reverse=True)))})")

    def _exact(self, text: str) -> list[int]:
        if self._library is None:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self._library = Tokenizer.from_file(self._json)
        return self._library.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        try:
            if not any(t in text for t in self._added):
                return np.array(self._fast.encode_ordinary(text), np.uint32)
            if self._plain:
                ids: list[int] = []
                for part in filter(None, self._cut.split(text)):
                    ids += [self._added[part]] if part in self._added else self._fast.encode_ordinary(part)
                return np.array(ids, np.uint32)
        except Exception:  # its pattern engine gives up on some endless runs
            pass
        return np.array(self._exact(text), np.uint32)


class Packer:
    """Packs the pieces of one pool. A piece is (length, order, doc, start)."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = tiers
        self.pools: list[list[tuple[int, int, int, int]]] = [[] for _ in tiers]
        self.order = 0

    def add(self, length: int, doc: int, start: int) -> None:
        tier = next(k for k, c in enumerate(self.tiers) if length <= c)
        insort(self.pools[tier], (length, self.order, doc, start))
        self.order += 1

    def _fill(self, gap: int, below: int) -> list[tuple[int, int, int]]:
        """Pieces of tiers up to ``below`` for a gap, the last one cut to fit."""
        out = []
        for pool in reversed(self.pools[: below + 1]):
            while gap and (k := bisect_right(pool, (gap, self.order, 0, 0))):
                length, _, doc, start = pool.pop(k - 1)
                out.append((doc, start, length))
                gap -= length
        pool = next((p for p in self.pools[: below + 1] if p), None) if gap else None
        if pool:
            length, _, doc, start = pool.pop()
            out.append((doc, start, gap))
            self.add(length - gap, doc, start + gap)
        return out

    def pack(self, last: bool) -> Iterator[list[tuple[int, int, int]]]:
        """Sequences as lists of (doc, start, length). Unless ``last``, only
        full windows are made and the rest stays in the pools."""
        for tier in range(len(self.tiers) - 1, -1, -1):
            window, pool = self.tiers[tier], self.pools[tier]
            while pool and sum(p[0] for q in self.pools[: tier + 1] for p in q[-64:]) >= window:
                length, _, doc, start = pool.pop()
                yield [(doc, start, length), *self._fill(window - length, tier)]
        while last and any(self.pools):
            left = sum(p[0] for q in self.pools for p in q)
            window = max((c for c in self.tiers if c <= left), default=left)
            yield self._fill(window, len(self.tiers) - 1)


def step_groups(lengths: list[int], step_tokens: int) -> list[int]:
    """A group for each sequence, of near equal cost: the costliest first,
    each to the group with the least so far."""
    groups = max(1, -(-sum(lengths) // step_tokens))
    heap = [(0, g) for g in range(groups)]
    out = [0] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        cost, g = heap[0]
        heapq.heapreplace(heap, (cost + lengths[k] * 2048 + lengths[k] ** 2, g))
        out[k] = g
    return out


_PIECE = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
          ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
          ("tier", pa.int32()), ("step_group", pa.int64())]


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   tiers: tuple[int, ...] = TIERS, tokenizer: str = TOKENIZER,
                   pool_tokens: int = POOL_TOKENS, step_tokens: int = STEP_TOKENS,
                   with_ids: bool = True) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, tier (the context size that holds the sequence),
    step_group and, if ``with_ids``, the piece's token ids."""
    tiers = tuple(sorted(tiers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = Encoder(tokenizer), TaskContext.get().partitionId() << 40
        docs_now: list[tuple[object, np.ndarray]] = []
        full: list[list[tuple[int, int, int]]] = []
        packer, pooled, n_seq, n_group = Packer(tiers), 0, 0, 0

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal packer, docs_now, full, pooled, n_seq, n_group
            sequences = [*full, *packer.pack(last)]
            lengths = [sum(x[2] for x in s) for s in sequences]
            groups = step_groups(lengths, step_tokens)
            cols: list[list] = [[] for _ in range(len(_PIECE) + 2)]
            for s, (pieces, total) in enumerate(zip(sequences, lengths)):
                offset, tier = 0, next(c for c in tiers if total <= c)
                for doc, start, length in pieces:
                    doc_id, ids = docs_now[doc]
                    own = ids[start:start + length].astype("<u4")
                    row = (doc_id, start, length, zlib.crc32(own.tobytes()), ids.size,
                           part + n_seq + s, offset, tier, part + n_group + groups[s], own)
                    for col, value in zip(cols, row):
                        col.append(value)
                    offset += length
            n_seq, n_group = n_seq + len(sequences), n_group + max(groups, default=-1) + 1
            keep = [p for q in packer.pools for p in q]  # the rest goes to the next pool
            kept = {doc: k for k, doc in enumerate(sorted({p[2] for p in keep}))}
            docs_now, full, packer = [docs_now[d] for d in kept], [], Packer(tiers)
            for length, _, doc, start in keep:
                packer.add(length, kept[doc], start)
            pooled = sum(p[0] for p in keep)
            arrays = [pa.array(cols[0], id_type), *[pa.array(c, t) for c, (_, t) in zip(cols[1:], _PIECE)]]
            names = ["doc_id", *[n for n, _ in _PIECE]]
            if with_ids:
                ends = np.cumsum([0, *map(len, cols[-1])], dtype=np.int32)
                flat = np.concatenate([*cols[-1], np.zeros(0, "<u4")]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py()), np.uint32(END))
                docs_now.append((doc_id, ids))
                doc, whole = len(docs_now) - 1, ids.size // tiers[-1] * tiers[-1]
                full += [[(doc, k, tiers[-1])] for k in range(0, whole, tiers[-1])]
                if whole < ids.size:
                    packer.add(ids.size - whole, doc, whole)
                pooled += ids.size
                if pooled >= pool_tokens:
                    yield flush(False)
        if id_type is not None:
            yield flush(True)

    schema = (f"doc_id {docs.schema[id_col].dataType.simpleString()}, start bigint, length bigint, "
              "ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, tier int, "
              "step_group bigint" + ", ids array<int>" * with_ids)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
