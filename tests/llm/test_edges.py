"""Nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing extra columns: each operator's defined results."""

from __future__ import annotations

import random
import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from shopstar.llm import (chat_collapse, decontamination, hash_tree, html_extract, license_scan, line_dedup,
                          packing, pitman_yor, quality_rules, simhash)

LONG = "one two three four five six seven " * 30_000
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, words string, fp bigint, "
          "row int, host string, line string, slice int, n_words int, key string, hit string")
ROWS = [(1, "Alpha beta gamma delta.\nsame line", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
        (4, " \t\n ", "en", "a"), (5, LONG, "en", "b"), (None, "no id here", "en", "a"),
        (7, "twice the same row", "en", None), (7, "twice the same row", "en", None)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, len(r[1] or ""), "w", 9, 9, "h", "l", 9, 9, "k", "x") for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "Gamma, DELTA"), (2, None), (3, ""), (None, "three four five"),
                                  (1, "Gamma, DELTA")], "item_id bigint, text string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_quality(docs, none):
    got = quality_rules.ledger(docs)
    assert got.count() == 8 and quality_rules.ledger(none).count() == 0
    by_id = {r.doc_id: r for r in got.collect()}
    assert [by_id[2][c] for c in quality_rules.MEASURES] == [0] * 6
    assert by_id[4].n_words == 0 and by_id[4].n_lines == 0 and by_id[3].n_words == 0
    assert by_id[5].n_repeat_words == by_id[5].n_words == 210_000
    kept = quality_rules.keep_documents(docs, quality_rules.Policy("none", 1, ()))
    assert kept.schema == docs.schema and rows(kept) == rows(docs)
    empty = quality_rules.ablations(quality_rules.ledger(none), quality_rules.WEB).collect()
    assert {r.n_failed for r in empty} == {0} and len(empty) == 5


def test_quality_ablation_counts(spark):
    book = spark.createDataFrame([(0b011,), (0b001,), (0b100,), (0,)], "fail_bits bigint")
    got = {r.rule: r for r in quality_rules.ablations(book, quality_rules.WEB).collect()}
    assert (got["few_words"].n_failed, got["few_words"].n_only) == (2, 1)
    assert (got["few_words"].with_any, got["few_words"].with_all) == (3, 1)
    assert (got["symbols"].n_failed, got["symbols"].n_only) == (1, 1)
    kept = quality_rules.apply_policies(book, (quality_rules.BASE, quality_rules.WEB))
    assert [(r.kept_base_v1, r.kept_web_v1) for r in kept.collect()] == [
        (False, False), (False, False), (True, False), (True, True)]


ENDS = ("\u0085", "\u2028", "\u2029", "\x0b", "\x0c", "\r", "\x1c", "\u00a0", "\u3000")


def test_line_ends_of_other_alphabets_are_word_characters(spark):
    """Only the ASCII blanks separate words and bound lines; others stand in words."""
    rng = random.Random(7)
    parts = [*ENDS, " ", "\t", "\n", "\n", "\n", "a", "foo bar", ""]
    texts = ["\u0085\n\u0085", "foo bar\u2028\n\u2028\nfoo bar\u2028", *(
        "".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(300))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in quality_rules.ledger(df).collect():
        lines = [x for x in texts[r.doc_id].split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_lines, r.n_dup_lines) == (len(lines), len(lines) - len(set(lines)))
        assert r.n_words == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id]))
    pages = [*[(k, f"foo\u2028\nown {k}", "h") for k in range(4)], (4, "foo", "h"), (5, " foo\u2028\t", "h"),
             (6, "foo\u0085", "h")]
    out = line_dedup.drop_boilerplate(spark.createDataFrame(pages, "doc_id int, text string, source string"))
    assert {r.row.doc_id: r.new_text for r in out.collect()} == {
        **{k: f"own {k}" for k in range(4)}, 4: "foo", 5: "", 6: "foo\u0085"}


def test_line_dedup(spark, docs, none):
    got = line_dedup.clean_documents(docs, min_pages=5)
    assert got.columns == docs.columns and rows(got.drop("n_chars")) == rows(docs.drop("n_chars"))
    assert line_dedup.clean_documents(none).count() == 0
    page = [(k, f"menu\n own {k} \n\nmenu ", None) for k in range(6)] + [(9, "menu\nx", "b")]
    out = line_dedup.drop_boilerplate(spark.createDataFrame(page, "doc_id int, text string, source string"))
    assert {(r.row.doc_id, r.new_text, r.n_lines, r.n_dropped) for r in out.collect()} == {
        *((k, f" own {k} \n", 4, 2) for k in range(6)), (9, "menu\nx", 2, 0)}


def test_line_dedup_on_small_hosts(spark):
    """The ratio decides on hosts of any size; a line of one page is never boilerplate."""
    pages = [(k, f"own {k}\nfooter", "four") for k in range(4)] + [(9, "alone\nfooter", "one")]
    pages += [(20 + k, f"p{k}\n" + ("rare" if k < 2 else "x" * k), "thirty") for k in range(30)]
    out = line_dedup.drop_boilerplate(spark.createDataFrame(pages, "doc_id int, text string, source string"))
    got = {r.row.doc_id: r.new_text for r in out.collect()}
    assert [got[k] for k in (0, 3, 9, 20, 21)] == ["own 0", "own 3", "alone\nfooter", "p0\nrare", "p1\nrare"]


def test_simhash(docs, none):
    got = simhash.near_duplicates(docs)
    assert got.count() == 8 and simhash.near_duplicates(none).count() == 0
    assert {r.doc_id: (r.fp, r.component_id) for r in got.collect() if r.doc_id in (2, 3, 4)} == {
        2: (0, 2), 3: (0, 2), 4: (0, 2)}
    kept = simhash.drop_near_duplicates(docs)
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "5", "7", "None"]
    assert simhash.drop_near_duplicates(none).count() == 0


def filler(seed, n=80):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))


def test_near_duplicates_by_row(spark):
    """Rows that share an id, or have none, are judged by their own texts."""
    a, b, c, d = (filler(k) for k in range(4))
    rows = [(5, a, "x"), (5, b, "x"), (2, a + "\n", "x"), (None, c, "x"), (None, c.upper(), "y"), (None, c, "x"),
            (9, d, "z"), (9, d, "z"), (9, d, "y"), (None, d, "x"), (None, None, None), (1, "", "q")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, fp string").withColumn("m", F.create_map("fp", "fp"))
    df = df.where("fp is not null").unionByName(df.where("fp is null").withColumn("m", F.lit(None).cast("map<string,string>")))
    got = simhash.drop_near_duplicates(df)
    assert got.schema == df.schema
    kept = [(r.doc_id, (r.text or "").strip().lower()) for r in got.collect()]
    assert sorted(kept, key=repr) == sorted([(2, a), (5, b), (None, c), (9, d), (1, "")], key=repr)
    again = [(r.doc_id, r.text, r.fp) for r in simhash.drop_near_duplicates(df.repartition(7)).collect()]
    assert sorted(again, key=repr) == sorted([(r.doc_id, r.text, r.fp) for r in got.collect()], key=repr)


def test_decontamination(docs, none, items):
    got = decontamination.decontaminate(docs, items)
    by_id = {r.doc_id: r for r in got.collect()}
    assert got.count() == 8 and decontamination.decontaminate(none, items).count() == 0
    assert (by_id[1].n_hit, by_id[1].n_items) == (2, 1)
    assert (by_id[5].n_hit, by_id[5].n_items) == (90_000, 0) and by_id[2].n_words == 0
    assert by_id[3].items_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    clean = decontamination.decontaminate(docs, items, mode="documents")
    assert clean.columns == docs.columns and sorted(str(r.doc_id) for r in clean.collect()) == [
        "2", "3", "4", "7", "7", "None"]
    cut = decontamination.decontaminate(docs, items, mode="spans")
    by_id = {r.doc_id: r for r in cut.collect()}
    assert by_id[1].text == "Alpha beta .\nsame line" and by_id[1].n_chars == 22 and by_id[2].text is None
    assert not decontamination.decontaminate(docs, items.where("false")).where("contaminated").count()


def test_decontamination_in_blocks_of_windows(docs, items):
    whole = decontamination.decontaminate(docs, items)
    assert rows(decontamination.decontaminate(docs, items, max_windows=1)) == rows(whole)


def test_packing(docs, none):
    got = packing.pack_documents(docs)
    assert got.agg(F.countDistinct("doc_id")).first()[0] == 6 and packing.pack_documents(none).count() == 0
    ends = {r.doc_id: r.doc_tokens for r in got.collect()}
    assert ends[2] == ends[3] == 1 and got.where("doc_id = 7").count() >= 2
    assert all(len(r.ids) == r.length for r in got.collect())


def test_sharding(docs, none):
    got = hash_tree.assign(docs, hash_tree.balanced(8)).collect()
    assert len(got) == 8 and hash_tree.assign(none, hash_tree.balanced(8)).count() == 0
    for s in range(9):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    by_id = {r.doc_id: r for r in got}
    assert (by_id[2]["size"], by_id[2].text_crc32, by_id[3]["size"]) == (1, 0, 1)


def test_license_scan(docs, none):
    got = license_scan.scan(docs).collect()
    assert len(got) == 8 and license_scan.scan(none).count() == 0
    by_id = {r.doc_id: r for r in got}
    assert (by_id[2].n_words, by_id[2].labels, by_id[2].first_word, by_id[2].score) == (0, "", None, 0.0)
    assert by_id[5].n_words == 210_000


def test_scoring(docs, none):
    got = pitman_yor.score_documents(docs, min_slices=4).collect()
    assert len(got) == 8 and pitman_yor.score_documents(none).count() == 0
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].n_tokens == by_id[3].n_tokens == 1 and by_id[5].n_tokens == 210_001
    assert by_id[None].held_out and sum(r.doc_id == 7 for r in got) == 2
    assert all(r.score < 0 and r.base_score < 0 for r in got)
    only_held = docs.where("doc_id is null")
    assert pitman_yor.score_documents(only_held, min_slices=2).first().train_tokens == 0


def test_html(spark):
    pages = spark.createDataFrame(
        [(1, "u", None, 1), (2, None, "", 1), (None, "u", "<p>", 1), (4, "u", "<article>a<", 1),
         (4, "u", "<article>a<", 1)], "page_id int, url string, html string, text int")
    got = {(r.page_id, r.text, r.n_chars) for r in html_extract.extract(pages).collect()}
    assert got == {(1, "", 0), (2, "", 0), (None, "", 0), (4, "a<", 2)}
    assert html_extract.extract(pages.where("false")).count() == 0


def test_chat(spark):
    c = spark.createDataFrame(
        [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (3, 0, "user", "hi"),
         (3, 0, "user", "hi"), (3, 1, "assistant", "yes"), (3, 2, None, None), (4, 0, "user", "h<|im_end|>"),
         (5, 0, "user", "h<|im_end|>"), (None, 0, "user", "lost"), (6, None, "user", "x"), (6, 0, "user", "y")],
        "conv_id int, turn int, role string, text string").withColumn("pos", F.lit(1))
    got = {r.conv_id: r for r in chat_collapse.collapse(c).collect()}
    assert sorted(got) == [3, 4, 6] and (got[3].n_turns, got[4].n_copies) == (3, 2)
    assert got[3].rendered.endswith("<|im_start|>unknown\n<|im_end|>\n")
    assert got[4].rendered == "<|im_start|>user\nh< |im_end|><|im_end|>\n"
    assert got[6].rendered.index("x") < got[6].rendered.index("y")
    assert chat_collapse.collapse(c.where("false")).count() == 0


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    """Null and repeated ids, ties, repeated rows and clashing columns go
    through every stage; each row is judged by its own text."""
    texts, more = [filler(k) for k in range(30)], [filler(k) for k in range(40, 60)]
    item = filler(99, 14)
    rows = [(k, t, "site") for k, t in enumerate(texts)]
    rows += [(3, more[0], "site"), (3, texts[3], "site"), (None, more[1], None), (None, more[1] + " end", "b"),
             (None, more[2], "b"), (50, None, "b"), (None, None, None), (51, "", "b"), (52, "too short", "b"),
             (53, more[3] + " " + item + " " + more[4], "b"), (54, more[5].upper() + " end", "c"),
             (2, more[5] + " end", "d"), (60, more[6] + "\nfooter", "four"), (61, more[7] + "\nfooter", "four")]
    names = ("lang string, n_chars bigint, words array<string>, fp bigint, row string, host string, line string, key "
             "string, component_id int, hit string, ids int")
    df = spark.createDataFrame([(*r, None, len(r[1] or ""), [], 1, "r", None, "l", "k", 2, "h", 3) for r in rows],
                               f"doc_id bigint, text string, source string, {names}")
    spark.createDataFrame([(1, item), (None, None)], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, str(tmp_path))
        assert out.columns == df.columns and stage(spark, df.where("false"), str(tmp_path)).count() == 0
        df = spark.createDataFrame(out.collect(), df.schema)
    want = [*enumerate(texts), (3, more[0]), (None, more[1]), (None, more[2]), (2, more[5] + " end"),
            (60, more[6]), (61, more[7])]
    got = [(r.doc_id, r.text.removesuffix(" end") if r.doc_id is None else r.text) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    pieces = corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path)).collect()
    assert sum(r.length for r in pieces) == sum({(r.doc_id, r.doc_tokens): r.doc_tokens for r in pieces}.values())
