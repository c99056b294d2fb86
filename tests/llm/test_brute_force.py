"""Operators without a SQL form, against plain Python on the smallest tables."""

from __future__ import annotations

import hashlib
import html
import itertools
import json
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from shopstar.llm import (components, decontamination, hash_tree, html_extract, license_scan, line_dedup,
                          packing, pitman_yor, quality_rules, simhash)
from shopstar.llm.html_tree import parse
from shopstar.llm.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def worded(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def fingerprint(text):
    words = spaced(text)
    grams = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps, bits=3):
    """id -> smallest id reachable by links of ``bits`` or fewer, pair by pair."""
    root = {k: k for k in fps}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= bits:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in fps}


def test_simhash(spark, texts):
    fps = {k: fingerprint(t) for k, t in texts.items()}
    expected = {k: (f"{fps[k]:016x}", c) for k, c in classes(fps).items()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries()["op7_simhash"](spark, SF).collect()}
    assert got == expected and len(set(c for _, c in got.values())) < len(got)


def test_simhash_links_of_a_hot_key_in_tiles(spark):
    rng = np.random.default_rng(1)
    centre, fps = int(rng.integers(1 << 62)), set()
    for _ in range(250):  # all within a few bits of one another, and of none else
        fps.add(centre ^ sum(1 << int(b) for b in rng.integers(0, 64, 2)))
    fps |= {int(x) for x in rng.integers(0, 1 << 62, 150)}
    fps = {x - (1 << 64) if x >> 63 else x for x in fps}
    nodes = spark.createDataFrame([(x,) for x in sorted(fps)], "fp bigint")
    expected = classes({x: x & (1 << 64) - 1 for x in fps})
    for tile in (16, 1024):
        links = simhash.links(nodes, tile=tile)
        roots = {r.node: r.root for r in components.connected_components(links).collect()}
        assert {x: roots.get(x, x) for x in fps} == expected
        assert links.count() <= 20 * 60 * len(fps)  # forests, not pairs


def test_any_two_close_fingerprints_share_a_block_choice():
    masks = simhash.block_masks(3)
    assert len(masks) == 20
    rng = np.random.default_rng(2)
    for _ in range(300):
        flip = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(not flip & m for m in masks)


def test_components_of_chains_stars_and_rings(spark):
    links = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(1001, 1100)] + [(5, 5), (None, 3)]
    links += [(2000 + k, 2000 + (k + 1) % 7) for k in range(7)]
    got = components.connected_components(spark.createDataFrame(links, "a int, b int"))
    expected = {**{k: 0 for k in range(61)}, **{k: 1000 for k in range(1000, 1100)},
                **{k: 2000 for k in range(2000, 2007)}}
    assert {r.node: r.root for r in got.collect()} == expected


def test_components_of_random_links(spark):
    rng = np.random.default_rng(3)
    drawn = [(int(c) * 100 + int(a), int(c) * 100 + int(b)) for c, size in enumerate((2, 3, 9, 40, 90))
             for a, b in rng.integers(0, size, (size, 2))]
    low = {x: x for link in drawn for x in link if link[0] != link[1]}
    for _ in low:
        for a, b in drawn:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
    got = components.connected_components(spark.createDataFrame(drawn, "a int, b int")).collect()
    assert {r.node: r.root for r in got} == low and len(got) == len(low)
    none = components.connected_components(spark.createDataFrame([(4, 4), (None, 1)], "a int, b int"))
    assert none.count() == 0


def test_packing(docs, texts, tokenizer):
    got = packing.pack_documents(docs, pool_tokens=20_000).collect()
    ids = {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for k, t in texts.items()}
    pieces, sequences, groups = defaultdict(list), defaultdict(list), Counter()
    for r in got:
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert own == r.ids and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        pieces[r.doc_id] += range(r.start, r.start + r.length)
        sequences[r.sequence_id].append((r.offset, r.length))
        groups[r.step_group] += r.length
    assert {k: sorted(v) for k, v in pieces.items()} == {k: list(range(len(v))) for k, v in ids.items()}
    padding = 0
    for own in sequences.values():
        ends = [0, *itertools.accumulate(length for _, length in sorted(own))]
        assert [o for o, _ in sorted(own)] == ends[:-1] and ends[-1] <= 1024
        padding += 0 if ends[-1].bit_count() == 1 else 1024 - ends[-1]
    assert padding < 1024


def test_step_groups_are_balanced():
    lengths = [1024] * 40 + [512] * 30 + [256] * 20 + [128] * 9
    groups = packing.step_groups(lengths, 8192)
    cost = Counter()
    for length, g in zip(lengths, groups):
        cost[g] += length * 2048 + length ** 2
    assert len(cost) == -(-sum(lengths) // 8192) and max(cost.values()) < 1.2 * min(cost.values())


@pytest.mark.parametrize("text", ["", " ", "a\n\n b  c\t", "l'été — 12,5 % ÄÖ'S 日本語 🙂🙂", "x" * 5000,
                                  "   é́", "don't 'llama'll 123abc", "<|endof text|>"])
def test_token_ids_are_those_of_the_tokenizer_file(tokenizer, text):
    assert packing.Encoder()(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def added_tokens():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return [t["content"] for t in json.load(f)["added_tokens"]]


@pytest.mark.parametrize("form", ["{}", "{0}{0}", "a {} b", "a{}b", " {} ", "{0} {0}\n{0}", "l'été {}'s", "<{}>", "x{0}x{0}"])
@pytest.mark.parametrize("token", added_tokens())
def test_added_tokens_are_cut_out_first(spark, tokenizer, token, form):
    text = form.format(token)
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert packing.Encoder()(text).tolist() == want and tokenizer.token_to_id(token) in want


def test_packed_pieces_of_added_tokens(spark, tokenizer):
    texts = {k: f" {t} ".join("word" * k for _ in range(600)) for k, t in enumerate(added_tokens() * 3)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    pieces = packing.pack_documents(df).collect()
    for k, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        own = sorted((r for r in pieces if r.doc_id == k), key=lambda r: r.start)
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]]
        for r in own:
            assert r.doc_tokens == ids.size
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())


def draws(doc_id, tree):
    """The descent, by plain Python over the same hash."""
    while tree.children:
        best = []
        for child in tree.children:
            h = xxhash.xxh64_intdigest(child.name.encode(),
                                       xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), 42))
            best.append((-math.log(((h >> 11) + 0.5) / 2 ** 53) / child.total, child))
        tree = min(best, key=lambda x: x[0])[1] if len(best) > 1 else tree.children[0]
    return tree.shard


def test_sharding(spark, texts):
    got = {r.doc_id: r for r in queries()["op4_hash_tree"](spark, SF).collect()}
    tree = hash_tree.balanced(8)
    for k, t in texts.items():
        r = got[k]
        assert (r.shard, r.grown_shard) == (draws(k, tree), draws(k, hash_tree.grow(tree)))
        assert r.grown_shard in (r.shard, 8) and r.law == "key"
        assert (r["size"], r.text_crc32) == (len(t.encode()) + 1, zlib.crc32(t.encode()))
    for s in range(8):
        own = sorted(r.slot for r in got.values() if r.shard == s)
        assert own == list(range(len(own)))


def test_a_weight_change_moves_keys_only_within_its_subtrees(spark):
    before = hash_tree.balanced(8)
    r0, r1 = before.children
    rack = r0.children[0]
    heavier = hash_tree.Node(rack.name, children=(rack.children[0],
                                                  hash_tree.Node(rack.children[1].name, 3.0, 1)))
    after = hash_tree.Node("root", children=(hash_tree.Node(r0.name, children=(heavier, r0.children[1])), r1))
    ids = spark.range(20_000)
    moved = ids.select(hash_tree.shard_of(ids.id, before).alias("a"), hash_tree.shard_of(ids.id, after).alias("b"))
    pairs = {(r.a, r.b) for r in moved.where("a <> b").distinct().collect()}
    assert pairs and all(b < 4 for _, b in pairs)  # only into the region that grew
    assert all(b < 2 for a, b in pairs if a < 4)   # within it, only into the rack
    assert all(b == 1 for a, b in pairs if a < 2)  # within that, only into the shard
    counts = {r.b: r["count"] for r in moved.groupBy("b").count().collect()}
    assert abs(counts[1] / 20_000 - 0.3) < 0.02


def brute_notices(text):
    words, found = worded(text), set()
    for notice in license_scan.NOTICES:
        n = len(notice.text.split())
        for k in range(len(words)):
            for size in range(max(1, n - 1), n + 2):
                a, b = notice.text, " ".join(words[k:k + size])
                if abs(len(a) - len(b)) > notice.edits or k + size > len(words):
                    continue
                row = list(range(len(b) + 1))
                for i, x in enumerate(a, 1):
                    row = list(itertools.accumulate(
                        range(1, len(b) + 1), lambda left, j: min(left + 1, row[j] + 1, row[j - 1] + (x != b[j - 1])),
                        initial=i))
                if row[-1] <= notice.edits:
                    found.add(notice.label)
    return found


def test_license_scan(spark, texts):
    got = {r.doc_id: r for r in queries()["op5_license_scan"](spark, SF).collect()}
    for k, t in texts.items():
        words = worded(t)
        base = [(i, label) for phrase, label in license_scan.BASE for i in range(len(words))
                if words[i:i + len(phrase.split())] == phrase.split()]
        r = got[k]
        assert (r.n_words, r.n_base) == (len(words), len(base))
        assert (r.first_word, r.last_word) == (min([i for i, _ in base], default=None), max([i for i, _ in base], default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in base})) and 0 <= r.score <= 1
        assert {x for _, x in base} <= set(r.labels.split(","))


@pytest.mark.parametrize("text", [
    "Licensed under teh Apache Licence, Version 2.0.", "released under the MIT-License", "Realeased under the MIT License!",
    "all right reserved", "Mozila Public License, version 2.0", "gnu leser general public licence", "some other words here",
    "licensed under cc by-nc 4.0", "unreleased under the mit license", "ï all rights reservéd ï", "cc by 4.0 cc by-sa 4.0"])
def test_license_scan_finds_edited_notices(text):
    got = license_scan.scan_text(f"Some words. {text} And others.")
    found = {x["label"] for x in got["spans"]}
    expected = brute_notices(f"Some words. {text} And others.")
    assert found <= expected and bool(found) == bool(expected)
    for x in got["spans"]:
        assert x["first_word"] >= 2 or "unreleased" in text


@pytest.mark.parametrize("edited", ["released under the mit lisense", "relesed under teh mit license"])
@pytest.mark.parametrize("between", [" ", " and ", " or else it is "])
def test_license_scan_finds_edited_notices_before_exact_ones(edited, between):
    exact = "released under the mit license"
    for parts in ([edited, exact], [edited, edited, exact, edited], [exact, edited, exact]):
        got = license_scan.scan_text(f"it is {between.join(parts)} ok")["spans"]
        step = 5 + len(between.split())
        assert [(x["first_word"], x["last_word"], x["edits"] > 0) for x in got] == [
            (2 + k * step, 6 + k * step, p == edited) for k, p in enumerate(parts)]


def test_stirling_numbers_count_seatings():
    d, table = 0.4, pitman_yor.log_stirling(0.4)

    def weights(c):
        out = {1: {(1,): 1.0}}
        seats = {(1,): 1.0}
        for _ in range(c - 1):
            more = defaultdict(float)
            for s, w in seats.items():
                more[(*s, 1)] += w
                for k, n in enumerate(s):
                    more[(*s[:k], n + 1, *s[k + 1:])] += w * (n - d)
            seats = more
        out = defaultdict(float)
        for s, w in seats.items():
            out[len(s)] += w
        return out

    for c in range(1, 7):
        for t, w in weights(c).items():
            assert math.isclose(math.exp(table[c, t]), w)


@pytest.mark.parametrize("c", [30, 49, 300])
def test_tables_follow_their_law(c):
    """Mean tables of many equal dishes against the exact law, in both regimes."""
    d, a = 0.6, 2.5
    log = np.full(c + 1, -np.inf)
    log[1] = 0.0
    t = np.arange(c + 1)
    for n in range(1, c):
        with np.errstate(divide="ignore"):
            log = np.logaddexp(np.concatenate(([-np.inf], log[:-1])), log + np.log(np.maximum(n - d * t, 0)))
    log = log + t * math.log(a)
    law = np.exp(log - log[1:].max())
    mean = (law * t).sum() / law.sum()
    dishes, rng = pitman_yor.Dishes(d), np.random.default_rng(0)
    for _ in range(12):
        drawn = dishes.draw(np.full(4000, c), np.full(4000, a), rng)
    assert abs(drawn.mean() / mean - 1) < 0.05


def test_language_model(spark, texts):
    words = {k: [*spaced(t), None] for k, t in texts.items()}
    held = {k for k in texts if zlib.crc32(str(k).encode()) % 10 == 0}
    count = Counter(w for k, ws in words.items() if k not in held for w in ws)
    n, v = sum(count.values()), len(count)
    got = {r.doc_id: r for r in queries()["op2_pitman_yor"](spark, SF).collect()}
    assert set(got) == set(texts)
    for k, ws in words.items():
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            k in held, len(ws), sum(w in count for w in ws), n)
        assert math.isclose(r.base_score, sum(
            math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel_tol=1e-9)
    tokens = sum(got[k].n_tokens for k in held)
    assert sum(got[k].score for k in held) / tokens > sum(got[k].base_score for k in held) / tokens + 0.05


def test_each_word_is_its_own_context(spark):
    """Words that follow one word each: more contexts than 4,096 classes could keep apart."""
    rows = [(k, f"x{k % 20_000} y{k % 20_000}") for k in range(200_000)]
    got = pitman_yor.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), min_slices=4)
    # the end is near certain, and so is y after x; x alone is one of 20,000
    assert got.agg({"score": "avg"}).first()[0] > -math.log10(20_000) - 0.5


def zipf_rows(n):
    rng = np.random.default_rng(7)
    return [(k, " ".join(f"w{x}" for x in rng.zipf(1.3, 60) % 5000)) for k in range(n)]


def test_scores_do_not_depend_on_the_slices(spark):
    docs = spark.createDataFrame(zipf_rows(3000), "doc_id bigint, text string").repartition(3)
    few, many = (pitman_yor.score_documents(docs, min_slices=n).agg(
        {"score": "sum", "n_tokens": "sum"}).first() for n in (1, 48))
    assert few["sum(n_tokens)"] == many["sum(n_tokens)"] == 183_000
    assert abs(few["sum(score)"] - many["sum(score)"]) / 183_000 < 0.002


def test_a_frequent_word_is_dealt_to_many_slices():
    """Half of all tokens are one word; no slice gets much more than its share of the pairs."""
    rng, hot = np.random.default_rng(5), xxhash.xxh64_intdigest(b"hot", 0)
    words = rng.integers(0, 2**64, 40_000, np.uint64)
    words[1::2] = hot
    rows = list(pitman_yor._block_messages(0, [1], [False], [words], 16))
    pairs = [pitman_yor._pairs(r[4]) for r in rows if r[1] == "p"]
    assert len(pairs) == 16 and sum(int(x[2].sum()) for x in pairs) == 40_000
    assert max((x[0] == np.uint64(hot)).sum() for x in pairs) < 2 * 20_000 / 16


def deliver(messages, receivers, answer):
    """The answers to messages, without Spark."""
    inbox = {k: defaultdict(list) for k in range(receivers)}
    for to, kind, part, block, payload in messages:
        inbox[to][kind].append((part, block, payload))
    out = [m for to, own in inbox.items() if own for m in answer(to, {k: sorted(v) for k, v in own.items()})]
    return {kind: [m for m in out if m[1] == kind] for kind in sorted({m[1] for m in out})}


def test_predictive_probabilities_sum_to_one():
    """The functions of the jobs, handed their messages: in every context the
    probabilities of all words, the end and one unknown word sum to one."""
    rng, v, slices, owners, strength, burn_in, samples = np.random.default_rng(3), 40, 3, 2, 1.0, 2, 3
    word = xxhash.xxh64_intdigest
    names = np.array([word(f"w{k}".encode(), 0) for k in range(v)], np.uint64)
    train = [np.append(names[rng.zipf(1.4, 50) % v], np.uint64(pitman_yor._END)) for _ in range(60)]
    asked = np.array([*sorted({w for t in train for w in t.tolist()}), word(b"unknown", 0)], np.uint64)
    # each (context, word) once, in documents that train nothing
    held = [np.array([c, w], np.uint64) for c in asked.tolist() for w in asked.tolist()]
    blocks = [(train[:30], [False] * 30), (train[30:] + held, [False] * 30 + [True] * len(held))]
    gathered = [m for k, (docs, out) in enumerate(blocks)
                for m in pitman_yor._block_messages(k, [*range(len(docs))], out, docs, slices)]
    as_inbox = lambda f: (lambda me, x: f(me, defaultdict(list, x)))
    parts = deliver([m for m in gathered if m[1] == "p"], slices, as_inbox(
        lambda me, x: pitman_yor._add_up(me, x, owners)))
    told = deliver(parts["m"], owners, as_inbox(pitman_yor._own))

    def sums(messages):
        return [int(sum(x)) for x in zip(*(pitman_yor._unpack(m[4])[0] for m in messages))]

    n1, n2 = sums(parts["t"])
    tokens, words, k1, k2, t_all, s_all = sums(told["t"])
    assert (tokens, words) == (sum(t.size for t in train), asked.size - 1)
    totals = pitman_yor.Totals(tokens, words, (n1, k1), (n2, k2))
    numbers, state, kept, per_sample = told["x"], [], [], []
    for k in range(burn_in + samples):
        on, d0 = k >= burn_in, totals.discount(1)
        moved = deliver(parts["k2"] + told["r"] + state, slices, as_inbox(
            lambda me, x: pitman_yor._sweep(me, x, totals, strength, t_all, s_all, k, on)))
        new0 = (strength + d0 * s_all) / (totals.words + 1)
        told = deliver(numbers + moved["m"], owners, as_inbox(
            lambda me, x: pitman_yor._parent(me, x, new0, d0, k, on)))
        (t_all, s_all), state = sums(told["t"]), moved["s"]
        if on:
            kept += told["h"]
            per_sample.append((t_all, s_all))
    found = deliver(numbers + kept, owners, as_inbox(pitman_yor._samples))["f"]
    scores = deliver(parts["k"] + parts["i"] + found + state, slices, as_inbox(
        lambda me, x: pitman_yor._answer_blocks(me, x, totals, strength, per_sample, slices)))
    held_scores = {}
    for block, (docs, _) in enumerate(blocks):
        replies = sorted((m[2], m[4]) for m in scores["q"] if m[3] == block)
        score = np.concatenate([pitman_yor._unpack(p)[0] for _, p in replies]).astype(float)
        tokens_of = next(m[4] for m in gathered if m[1] == "e" and m[3] == block)
        sizes, ids, _, gaps = pitman_yor._unpack(tokens_of)
        at = 0
        for size, k in zip(sizes, ids):
            pairs = np.cumsum(gaps[at:at + size], dtype=np.int64)
            at += size
            held_scores[block, int(k)] = score[pairs]
    # P(first word c) times the sum over all next words, added up over all c
    assert math.isclose(sum(10 ** x.sum() for (block, k), x in held_scores.items() if block and k >= 30), 1,
                        rel_tol=1e-5)


def test_scores_of_a_text_without_repetition(spark):
    """One text of distinct words: every dish has one table, so nothing is
    drawn and the probabilities follow from the formula."""
    n = 30
    text = " ".join(f"w{k}" for k in range(n - 1))
    df = spark.createDataFrame([(1, text), (2, "w1 w2 other")], "doc_id bigint, text string")
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k in (1, 2)}
    df = df.where("doc_id = 1") if not held[2] else df
    got = {r.doc_id: r for r in pitman_yor.score_documents(df, min_slices=3).collect()}
    d = d0 = 0.95  # all dishes have one customer
    p = (1 - d0 + (1 + d0 * n) / (n + 1)) / (1 + n)
    want = n * math.log10((1 - d) / 2 + (1 + d) / 2 * p)
    assert math.isclose(got[1].score, want, rel_tol=1e-5) and got[1].train_tokens == n



def test_marginals_equal_enumeration():
    model = html_extract.Model(Counter())
    nodes = parse("<div><p>some text here<a href=x>link</a></p><aside>other</aside></div><ul><li>x</ul><main>y</main>")
    grouped, total, yes = html_extract.groups(nodes), 0.0, [0.0] * len(nodes)
    for states in itertools.product((0, 1), repeat=len(nodes)):
        w = -50.0 * states[0]
        for k, node in enumerate(nodes):
            if states[k]:
                w += sum(model.look.get((kind, str(value)), 0.0) for kind, value in html_extract.looks(node))
            if k:
                w += model.tie[grouped[node.parent][1], grouped[k][0], states[node.parent]][states[k]]
        total += math.exp(w)
        for k, s in enumerate(states):
            yes[k] += s * math.exp(w)
    for got, expected in zip(model.marginals(nodes), yes):
        assert math.isclose(got, expected / total, rel_tol=1e-6, abs_tol=1e-15)


def test_html_extraction(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in queries()["op10_html_tree"](spark, SF).collect()}
    assert set(got) == set(pages)
    for k, page in pages.items():
        inside = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        text = " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)>", " ", inside).replace("<b>", "")).split())
        assert (got[k].text, got[k].n_chars) == (text, len(text))


PAGE = """<!doctype html><title>T</title><body><header><h1>Site</h1><nav><a href=/>Home</a></nav></header>
<div class="cookie-notice">We use cookies on this page, as all do.</div><%s><h2>Head</h2><p>A <b>bo</b>ld para&amp;graph,
<a href=x>linked</a> and long enough to be read.<ul><li>one point<li>two points</ul><form><input>Search here</form>
<p>Second&nbsp;one with enough words in it.</p><div class="ad banner">Buy this now</div>
<section id="comments"><p>I think that this is a very good article indeed.</p></section></%s>
<aside><p>Other stories that you may like to read today.</p></aside><script>var a = "<p>no</p>";</script>
<footer><p>All of it is copyright, and so on and so forth for ever.</p></footer>"""


@pytest.mark.parametrize("inside", ["article", "main", 'div id="content"'])
def test_html_regions_that_the_training_pages_lack(inside):
    page = PAGE % (inside, inside.split()[0])
    assert html_extract.extract_text(page, html_extract.Model(Counter())) == (
        "Head A bold para&graph, linked and long enough to be read. one point two points "
        "Second one with enough words in it.")


@pytest.mark.parametrize("odd, text", [
    ('<svg width="9"/>', ""), ("<math/>", ""), ("<svg><path d='M0'/></svg>", ""), ("<svg><title>Icon<path>", ""),
    ("<svg><style/><title/></svg>", ""), ("<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", "x = 2"),
    ("<div><noscript><img src=x></div>", ""), ("<div><template><p>later</div>", ""),
    ("<script>a</script >", ""), ("<svg><foreignObject><p>label</p></foreignObject></svg>", "")])
def test_html_foreign_elements_leave_the_rest_of_the_page(odd, text):
    before, after = "Words that come before it and are read.", "Words that come after it and are read too."
    page = f"<body><article><p>{before}</p>{odd}<p>{after}</p></article><svg><g></g></svg></body>"
    assert html_extract.extract_text(page, html_extract.Model(Counter())) == " ".join(
        x for x in (before, text, after) if x)
    inside = f"<article><p>Where <math><mi>x</mi><mo>&lt;</mo><mn>2</mn></math> it {odd} holds for all.</article>"
    if text:
        assert html_extract.extract_text(inside, html_extract.Model(Counter())) == (
            f"Where x < 2 it {text} holds for all.")


def test_pipeline(spark, texts, tokenizer):
    """The rows of run() against the five stages in plain Python."""
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [worded(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {}
    for k, t in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(zip(words, words[1:], words[2:]))
        repeated = {i + j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(3)}
        own = [x for x in t.split("\n") if x.split()]
        if not (len(words) < 50 or 2 * len(repeated) > len(words) or 10 * len(re.findall(r"[#*$%&|<>]", t)) > len(words)
                or 2 * (len(own) - len(set(own))) > len(own) or not 2 <= sum(map(len, words)) / len(words) <= 20):
            kept[k] = t
    totals, pages = Counter(source[k] for k in kept), Counter()
    for k, t in kept.items():
        pages.update({(source[k], x.strip(" \t\n\r\x0b\x0c")) for x in t.split("\n")})
    for k, t in kept.items():
        kept[k] = "\n".join(x for x in t.split("\n") if not (y := x.strip(" \t\n\r\x0b\x0c")) or (
            pages[source[k], y] < line_dedup.MIN_PAGES or pages[source[k], y] <= line_dedup.MAX_RATIO * totals[source[k]]))
    kept = {k: kept[k] for k, c in classes({k: fingerprint(t) for k, t in kept.items()}).items() if k == c}
    grams = {tuple(w[i:i + 10]) for w in items if w for i in range(max(1, len(w) - 9))}
    sizes = {len(g) for g in grams}
    clean = {k: t for k, t in kept.items() if not any(
        tuple(w[i:i + n]) in grams for w in [worded(t)] for n in sizes for i in range(len(w) - n + 1))}
    assert 0 < len(clean) < len(kept) < len(texts)
    ids = {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for k, t in clean.items()}
    got = defaultdict(dict)
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id][r.start] = r.ids
    assert {k: [i for s in sorted(v) for i in v[s]] for k, v in got.items()} == ids


def test_stages_keep_the_columns_and_take_empty_input(spark, docs):
    rows = docs.where("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert out.count() == 0


def test_windows_of_the_report_equal_the_digest(spark, texts):
    got = {r.doc_id: r for r in queries()["op8_decontamination"](spark, SF).collect()}
    items = {r.item_id: worded(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    for k, t in texts.items():
        words, hit, found = worded(t), set(), set()
        for item, own in items.items():
            for i in range(max(1, len(own) - 9) if own else 0):
                g = own[i:i + 10]
                for j in range(len(words) - len(g) + 1):
                    if words[j] == g[0] and words[j:j + len(g)] == g:
                        hit.update(range(j, j + len(g)))
                        found.add(str(item))
        assert (got[k].n_words, got[k].n_hit, got[k].n_items) == (len(words), len(hit), len(found))
        assert got[k].items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


# -- pages and notices of odd form and great length ---------------------------

ARTICLE = " ".join(f"Word number {k} of a sentence that goes on, as articles do." for k in range(6))


@pytest.fixture(scope="module")
def page_model(spark):
    return html_extract.train(spark.read.parquet(f"{SF}/pages.parquet"))


@pytest.mark.parametrize("page, want", [
    ("<p>one <!-- a --!> two</p><p>three</p>", "one two three"), ("<p>a<!-->b</p>", "ab"), ("<p>c<!--->d</p>", "cd"),
    ("<p>a<!-- x -- > y -->b</p>", "ab"), ("<p>fo<img src=x>o ba<input>r</p>", "foo bar"), ("<p>a<br>b</p>", "a b"),
    (f'<div class="post-social-main"><p>{ARTICLE}</p></div>', ARTICLE),
    (f'<div class="article read-more"><p>{ARTICLE}</p></div>', ARTICLE),
    (f'<article class="post social"><p>{ARTICLE}</p></article>', ARTICLE),
    (f'<article><p>{ARTICLE}</p><div class="post-comments"><p>{ARTICLE.lower()}</p></div></article>', ARTICLE),
    (f'<article><p>{ARTICLE}</p></article><div class="main-nav"><a href=x>Home</a></div>', ARTICLE)])
def test_comments_classes_and_inline_voids(page_model, page, want):
    assert html_extract.extract_text(f"<html><body><main>{page}</main></body></html>", page_model) == want


@pytest.mark.parametrize("unit", ["<div>", "<div>x</b>", "<p>x", "<b><i>x</i>", "<a><div>", "<svg>", "<li>x", "<td>",
                                  "<table><tr>", "</p>", "<!--->", "<math><mi>x"])
def test_a_megabyte_of_tags_takes_seconds(page_model, unit):
    page = unit * (1_000_000 // len(unit))
    began = time.process_time()
    html_extract.extract_text(page, page_model)
    assert time.process_time() - began < 30  # some 5 s; the square of the tags would be hours


def test_a_megabyte_of_notices_takes_seconds():
    began = time.process_time()
    got = license_scan.scan_text("all rights reserved " * 50_000)
    assert time.process_time() - began < 30
    assert len(got["spans"]) == got["n_base"] == 50_000 and got["last_word"] == 3 * 49_999
    assert [x["first_word"] for x in got["spans"][:3]] == [0, 3, 6]
