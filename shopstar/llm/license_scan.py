"""Fuzzy search for short licence notices.

Texts are reduced to lower-case words joined by one blank. A notice that may
differ by ``k`` edits is cut into ``k + 1`` seeds: an occurrence with at most
``k`` edits keeps one seed whole (pigeonhole), so exact search for the seeds
finds every candidate place. At each word near it where an occurrence can
begin, the regex library's bounded-error matching ``(?:notice){e<=k}`` verifies
the edits and gives the least edited span.

One narrow pass over whole texts, no shuffle. Defined cases: null, empty and
wordless texts give a row with no places; repeated rows a row each; an empty
table an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.llm.common import LOWER_WORDS, text_bytes

# Exact phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


@dataclass(frozen=True)
class Notice:
    """A notice as normalised words, its label and the edits it may differ by."""
    label: str
    text: str
    edits: int = 2
    seeds: tuple[tuple[int, bytes], ...] = field(init=False)

    def __post_init__(self):
        n, parts = len(self.text), self.edits + 1
        cuts = [n * k // parts for k in range(parts + 1)]
        object.__setattr__(self, "seeds", tuple(
            (a, self.text[a:b].encode()) for a, b in zip(cuts, cuts[1:])))


NOTICES = (
    Notice("apache-2.0", "licensed under the apache license version 2 0", 4),
    Notice("mit", "released under the mit license", 3),
    Notice("mit", "licensed under the mit license", 3),
    Notice("gpl", "licensed under the gnu general public license", 4),
    Notice("gpl", "gnu general public license version", 3),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("mpl-2.0", "mozilla public license version 2 0", 3),
    Notice("cc-by-nc", "licensed under cc by nc 4 0", 2),
    Notice("cc-by-sa", "licensed under cc by sa 4 0", 2),
    Notice("cc-by", "licensed under cc by 4 0", 2),
    Notice("cc-by", "creative commons attribution", 3),
    Notice("cc0", "released into the public domain", 3),
    Notice("reserved", "all rights reserved", 2),
)


def _pattern(notice: Notice):  # regex keeps what it compiled
    notice_words = regex.escape(notice.text, special_only=True)
    return regex.compile(f"(?be)(?<![^ ])(?:{notice_words}){{e<={notice.edits}}}(?![^ ])")


def _places(data: bytes, part: bytes) -> Iterator[int]:
    at = data.find(part)
    while at >= 0:
        yield at
        at = data.find(part, at + 1)


def _word_starts(joined: bytes, starts: list[int], reach: int) -> Iterator[int]:
    """Places where words begin within ``reach`` of one of ``starts``, in order."""
    done = -1
    for at in starts:
        a = max(done + 1, at - reach)
        a = 0 if a <= 0 else joined.find(b" ", a - 1) + 1
        while a <= at + reach and (a or done < 0):
            yield a
            done = a
            a = joined.find(b" ", a) + 1


def base_places(joined: bytes) -> list[tuple[int, str]]:
    """(start in ``joined``, label) of the exact phrases, word by word."""
    padded = b" " + joined + b" "
    return sorted((at, label) for phrase, label in BASE
                  for at in _places(padded, f" {phrase} ".encode()))


def fuzzy_places(joined: bytes, notices: tuple[Notice, ...] = NOTICES) -> list[tuple[int, int, str, int, float]]:
    """(start, end, label, edits, similarity) of the notices in ``joined``:
byte spans that begin and end at words. Each word at which a notice can begin
is tried by itself, so that no reading hides another. Of readings that overlap,
the least edited (then the longest) stays: a notice one word away from another
is not the other."""
    out = []
    for notice in notices:
        pattern, reach = _pattern(notice), 4 * notice.edits  # an edit moves an end by four bytes at most
        for a in _word_starts(joined, sorted({at - shift for shift, seed in notice.seeds
                                              for at in _places(joined, seed)}), reach):
            end = joined.find(b" ", a + len(notice.text.encode()) + reach)  # whole words
            window = joined[a:len(joined) if end < 0 else end].decode("utf-8", "surrogatepass")
            if (m := pattern.match(window)) is not None:
                b, edits = a + len(m.group().encode("utf-8", "surrogatepass")), sum(m.fuzzy_counts)
                b -= joined[b - 1:b] == b" "
                out.append((a, b, notice.label, edits, 1 - edits / len(notice.text)))
    starts: list[int] = []  # of what is kept: spans that do not overlap, in order
    kept: list[tuple[int, int, str, int, float]] = []
    for x in sorted(set(out), key=lambda x: (x[3], x[0] - x[1], x)):
        k = bisect_left(starts, x[0])
        if (k == 0 or kept[k - 1][1] <= x[0]) and (k == len(kept) or x[1] <= starts[k]):
            starts.insert(k, x[0])
            kept.insert(k, x)
    return kept


def scan_text(text: str | None, notices: tuple[Notice, ...] = NOTICES) -> dict:
    """Words, base places and notice spans (in words) of one text."""
    words = text_bytes(text).translate(LOWER_WORDS).split()
    joined = b" ".join(words)
    base, fuzzy = base_places(joined), fuzzy_places(joined, notices)

    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)

    def word_at(k: int) -> int:
        return int(np.searchsorted(blanks, k))

    starts = [word_at(at) for at, _ in base]
    found = {label for _, label in base}
    return {
        "n_words": len(words), "n_base": len(base), "first_word": min(starts, default=None),
        "last_word": max(starts, default=None), "base_labels": ",".join(sorted(found)),
        "labels": ",".join(sorted(found | {x[2] for x in fuzzy})),
        "score": max([x[4] for x in fuzzy] + [1.0] * bool(base), default=0.0),
        "spans": [{"label": label, "first_word": word_at(a), "last_word": word_at(b), "edits": edits}
                  for a, b, label, edits, _ in fuzzy]}


_SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                   ("edits", pa.int32())])
_TYPES = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
          "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": pa.list_(_SPAN)}


def scan(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """A row per document: counts, labels, score and ``spans``, the verified
    notices as (label, first_word, last_word, edits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan_text(t.as_py(), notices) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[c] for r in rows], t) for c, t in _TYPES.items()]],
                ["doc_id", *_TYPES])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, (
        f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_words bigint, n_base bigint, "
        "first_word bigint, last_word bigint, base_labels string, labels string, score double, "
        "spans array<struct<label:string,first_word:bigint,last_word:bigint,edits:int>>"))
