"""Phrase tries, SentencePiece pieces and conversation prefixes against plain
Python and the sentencepiece library."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from shopstar.llm import collocations, prefix_trie, sentencepiece_bpe
from shopstar.llm.queries import queries

SF = "/root/testdata/sf0.001"


# -- phrases ---------------------------------------------------------------

def plain_collocations(docs, least=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        covered = {q for p, a in found.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * c[q]}
        rows = []
        for p in found.keys() - covered:
            score, k = min((1000000 * c[p] ** 2 // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -c[p], " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -s)
                for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def phrase_docs():
    rng = random.Random(3)
    vocab = ["a", "B", "c d", "é", "the", "of", "in", "x\x00", "日本", "\x1c", "Z\u0085z"]
    joints = [" ", "  ", "\t", " ", " ", ". ", ",", "\n"]
    docs = [(rng.choice(["en", "de", None, "und"]),
             "".join(rng.choice(vocab) + rng.choice(joints) for _ in range(rng.randint(0, 80)))) for _ in range(300)]
    return [*docs, *docs[:40], ("en", None), (None, ""), ("fr", "solo"), ("en", "a b " * 5000), ("en", " .,;\n" * 50)]


@pytest.mark.parametrize("params", [{}, {"run_tokens": 500, "filter_bits": 6, "block": 7, "top": 9}])
def test_collocations_equal_plain_counts(spark, phrase_docs, params):
    df = spark.createDataFrame([(*d, "x", 1) for d in phrase_docs], "lang string, text string, word string, h1 int")
    got = sorted(tuple(r) for r in collocations.collocations(df, **params).collect())
    assert got == plain_collocations(phrase_docs, top=params.get("top", 2000)) and got
    assert collocations.collocations(df.where("false")).count() == 0


def test_no_rare_phrase_is_a_candidate(spark, phrase_docs, monkeypatch):
    """However full the bitmaps are: rare phrases would be counted by as many more passes over all runs."""
    dealt, real = [], collocations.phrase_counts
    monkeypatch.setattr(collocations, "phrase_counts", lambda runs, found, *a: dealt.append(found.count()) or real(runs, found, *a))
    monkeypatch.setattr(collocations, "MOST_FILTER_BITS", 6, raising=False)
    docs = [*phrase_docs, *(("en", f"w{k % 40} v{k % 37} u{k % 31}") for k in range(400))]
    df = spark.createDataFrame(docs, "lang string, text string")
    got = sorted(tuple(r) for r in collocations.collocations(df, run_tokens=500, filter_bits=6).collect())
    assert got == plain_collocations(docs)
    f = Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            f.update((lang or "und", *w[i:i + k]) for k in (2, 3) for i in range(len(w) - k + 1))
    assert dealt == [sum(n >= 10 for n in f.values())]


def test_word_hash_collisions_take_another_seed(spark, phrase_docs, monkeypatch):
    docs = phrase_docs[:60]
    real, seeds = collocations._hash, []

    def colliding(seed):
        seeds.append(seed)
        return real(seed) % 3 if seed == 0 else real(seed)

    monkeypatch.setattr(collocations, "_hash", colliding)
    df = spark.createDataFrame(docs, "lang string, text string")
    assert sorted(tuple(r) for r in collocations.collocations(df).collect()) == plain_collocations(docs)
    assert seeds == [0, 1]


def test_phrases_that_share_a_key_are_all_counted(spark, phrase_docs, monkeypatch):
    """Keys of a few bits: most keys have several phrases, in different runs."""
    real = collocations._key
    monkeypatch.setattr(collocations, "_mixed", lambda hashes: collocations.np.bitwise_xor.reduce(hashes) % 7 << 50
                        if len(hashes) > 1 else hashes[0])
    df = spark.createDataFrame(phrase_docs, "lang string, text string")
    got = sorted(tuple(r) for r in collocations.collocations(df, run_tokens=400).collect())
    assert got == plain_collocations(phrase_docs) and real is collocations._key


def test_double_array_counts_like_a_dictionary():
    rng = np.random.default_rng(4)
    words = rng.integers(1, 1 << 62, 3000).astype(np.uint64)  # more than one digit a word
    tokens = rng.zipf(1.3, 60_000) % 3001
    hashes = np.concatenate((np.zeros(1, np.uint64), words))
    seen = Counter(tuple(tokens[i:i + k]) for k in (2, 3) for i in range(tokens.size - k + 1))
    chosen = [p for p in seen if 0 not in p and rng.random() < 0.5]
    chosen += [(1, 2, 2999), (2999, 2998)]
    phrases = np.zeros((len(chosen), 3), np.uint64)
    for k, p in enumerate(chosen):
        phrases[k, :len(p)] = hashes[list(p)]
    trie = collocations.DoubleArray(phrases)
    assert trie.digits == 2
    firsts = np.unique(np.searchsorted(trie.words, phrases[:, 0]))
    assert trie.count(hashes, tokens, 3, firsts).tolist() == [seen[p] for p in chosen]


# -- pieces ----------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def odd_texts():
    rng = random.Random(1)
    alphabets = ["abtheeinorst  ▁▁\n\t日本語éß<0x>/s=-_.,1230😀\u0000 ̀", "the inaon", "thei  ", "=-"]
    out = ["".join(rng.choice(a) for _ in range(rng.randint(0, 60))) for a in alphabets for _ in range(1500)]
    out += ["".join(rng.choice("theinaors") for _ in range(3000)) for _ in range(5)]
    return [*out, "", None, " ", "▁", "  a", "<s>", "</s>", "<unk>", "<0x0A>", " " * 5000, "=" * 5000, "a" * 3000]


def test_pieces_equal_the_library(library):
    model = sentencepiece_bpe.load(sentencepiece_bpe.MODEL)
    texts = odd_texts()
    flat, counts = sentencepiece_bpe.Encoder(model)([(t or "", True) for t in texts])
    ends = np.cumsum(counts)
    for text, lo, hi in zip(texts, ends - counts, ends):
        want = library.encode(text or "")
        assert flat[lo:hi].tolist() == want, text
        assert model.decode(want) == library.decode(want)
    assert [model.encode(t) for t in texts[:50]] == [library.encode(t) for t in texts[:50]]


@pytest.mark.parametrize("ids", [[3, 4, 200, 201, 202], [1, 2, 300], [0, 5], [230, 231, 500, 197], [35, 35, 400],
                                 [1, 35, 400], [259, 259, 278], [1, 278, 2], []])
def test_any_ids_decode_like_the_library(library, ids):
    assert sentencepiece_bpe.load(sentencepiece_bpe.MODEL).decode(ids) == library.decode(ids)


def test_pieces_of_documents(spark, library):
    texts = [None, "", "Hello  world\n", "x " * 40_000 + "é", "▁ a", "=" * 3000, "Hello  world\n"]
    df = spark.createDataFrame([(k if k else None, t, 5) for k, t in enumerate(texts)],
                               "doc_id int, text string, n_tokens int")
    for size in (1 << 21, 1000):
        got = sentencepiece_bpe.encode_documents(df, slice_chars=size).collect()
        assert len(got) == len(texts)
        for r in got:
            ids = library.encode(texts[r.doc_id or 0] or "")
            back = library.decode(ids)
            assert (r.ids, r.decoded, r.n_tokens) == (ids, back, len(ids))
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    assert sentencepiece_bpe.encode_documents(df.where("false")).count() == 0


def test_piece_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries()["op12_sentencepiece"](spark, SF).collect():
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# -- prefixes --------------------------------------------------------------

def plain_trie(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t, r or "", x or ""))
    original = {c: [v[1:] for v in sorted(vs, key=lambda z: (z[0] is not None, z[0] or 0))] for c, vs in turns.items()}
    rebuilt = {}
    for c, v in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = original.get(c - c % 20, [])[:h] + v[h:]
    members, children = defaultdict(list), Counter()
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    children.update(p[:-1] for p in members if p)
    leaves, saved, out = Counter(), Counter(), []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not children[p]
        if p:
            saved[p] += (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1]))
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(rebuilt[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(n, long):
    rng = random.Random(5)
    texts = ["x y", " hi there z", None, "", "q\x0br"]
    rows = [(c, t if t or rng.random() < 0.8 else None, rng.choice(["user", None, "a"]),
             rng.choice(texts) if t < 20 else f"t{t}")
            for c in range(n) if rng.random() < 0.8 for t in range(rng.randint(0, 9) + (long if c == 77 else 0))]
    rng.shuffle(rows)
    return [*rows, (None, 1, "user", "no conversation")]


@pytest.mark.parametrize("params", [{}, {"part": 3, "spread": 4, "shard": 5}])
def test_trie_equals_plain_python(spark, params):
    rows = conversations(160, 1500)
    df = spark.createDataFrame([(*r, 1, "z") for r in rows],
                               "conv_id bigint, turn bigint, role string, text string, depth int, x string")
    got = prefix_trie.prefix_trie(df, **params)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_trie(rows)


def test_trie_edges(spark):
    kind = "conv_id int, turn int, role string, text string"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], kind)).count() == 0
    only_null = spark.createDataFrame([(None, 1, "a", "b")], kind)
    assert prefix_trie.prefix_trie(only_null).count() == 0
    # one conversation over and over, and repeated rows as turns of their own
    rows = [(c, t, "user", "same words") for c in range(700) for t in (0, 1)] + [(900, None, None, None)] * 3
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, kind), part=16, spread=4)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_trie(rows)


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 63, (3, 50_000)).astype(np.uint64)
    table = prefix_trie.PerfectHash(*keys)
    assert np.array_equal(np.sort(table(*keys)), np.arange(50_000))
    with pytest.raises(ValueError):
        prefix_trie.PerfectHash(*np.repeat(keys[:, :1], 2, axis=1))
