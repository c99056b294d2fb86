"""The registered queries of the training-data operators, with production
parameters, each over its whole table; and their DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstar.llm import (chat_collapse, collocations, decontamination, hash_tree, html_extract, license_scan,
                          line_dedup, packing, pitman_yor, prefix_trie, quality_rules, sentencepiece_bpe, simhash)
from shopstar.llm.common import table, written

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = line_dedup.drop_boilerplate(table(spark, d, "documents"))
    return out.select(F.col("row.doc_id").alias("doc_id"), F.col("new_text").alias("text"),
                      "n_lines", "n_dropped")


def op2_pitman_yor(spark: SparkSession, d: str) -> DataFrame:
    return pitman_yor.score_documents(table(spark, d, "documents"))


def op3_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"), with_ids=False)


def op4_hash_tree(spark: SparkSession, d: str) -> DataFrame:
    out = hash_tree.assign(table(spark, d, "documents"), hash_tree.balanced(8))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                      "grown_shard")


def op5_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return license_scan.scan(table(spark, d, "documents")).drop("spans")


def op6_chat_collapse(spark: SparkSession, d: str) -> DataFrame:
    return chat_collapse.collapse(table(spark, d, "conversations"))


def op7_simhash(spark: SparkSession, d: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, d, "documents"))
    return out.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op8_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark"))


POLICIES = (quality_rules.BASE, quality_rules.WEB)


def op9_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    book = quality_rules.apply_policies(quality_rules.ledger(table(spark, d, "documents")), POLICIES)
    base, web = (F.col(p.column) for p in POLICIES)
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~base).alias("base_failed"), (base & web).alias("kept"),
                       "fail_bits", *[p.column for p in POLICIES])


def quality_ablations(spark: SparkSession, d: str) -> DataFrame:
    """Per policy and rule what the ledger of all documents says of it. The
    ledger is written once; the policies read its bits, not the texts."""
    book = written(quality_rules.ledger(table(spark, d, "documents")), "quality_ledger")
    found = [quality_rules.ablations(book, p).select(F.lit(f"{p.name}_v{p.version}").alias("policy"), "*")
             for p in POLICIES]
    return found[0].unionByName(found[1])


def op10_html_tree(spark: SparkSession, d: str) -> DataFrame:
    return html_extract.extract(table(spark, d, "pages"))


def op11_phrase_tries(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(table(spark, d, "documents"))


def op12_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    return sentencepiece_bpe.encode_documents(table(spark, d, "documents"), with_ids=False)


def op13_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, d, "conversations"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_line_dedup, op2_pitman_yor, op3_packing, op4_hash_tree, op5_license_scan, op6_chat_collapse,
        op7_simhash, op8_decontamination, op9_quality_rules, op10_html_tree, op11_phrase_tries,
        op12_sentencepiece, op13_prefix_trie, quality_ablations)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


_LINES = f"""
WITH lines AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM documents),
trimmed AS (
  SELECT *, regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS t FROM lines),
pages AS (
  SELECT source, t, count(DISTINCT doc_id) AS n FROM trimmed WHERE t <> '' GROUP BY ALL),
totals AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
bad AS (
  SELECT p.source, p.t FROM pages p JOIN totals s ON p.source IS NOT DISTINCT FROM s.source
  WHERE n >= {line_dedup.MIN_PAGES} AND n > {line_dedup.MAX_RATIO} * total),
marked AS (
  SELECT l.*, b.t IS NOT NULL AS dropped
  FROM trimmed l LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND l.t = b.t)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '') AS text,
       CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped
FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, NULL, 0, 0 FROM documents WHERE text IS NULL
"""

_BOOK = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
book AS (
  SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
         + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
         + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END AS BIGINT) AS fail_bits
  FROM m)
"""

_LEDGER = _BOOK + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, fail_bits = 0 AS kept, fail_bits,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS kept_base_v1, fail_bits = 0 AS kept_web_v1
FROM book
"""

_ABLATIONS = _BOOK + """,
rules(policy, mask, rule, bit) AS (VALUES
  ('base_v1', 3, 'few_words', 1), ('base_v1', 3, 'repeated_words', 2), ('web_v1', 31, 'few_words', 1),
  ('web_v1', 31, 'repeated_words', 2), ('web_v1', 31, 'symbols', 4), ('web_v1', 31, 'repeated_lines', 8),
  ('web_v1', 31, 'word_length', 16))
SELECT policy, rule, count(*) FILTER (WHERE fail_bits & bit <> 0) AS n_failed,
       count(*) FILTER (WHERE fail_bits & mask = bit) AS n_only,
       coalesce(bit_or(fail_bits & mask) FILTER (WHERE fail_bits & bit <> 0), 0) AS with_any,
       coalesce(bit_and(fail_bits & mask) FILTER (WHERE fail_bits & bit <> 0), 0) AS with_all
FROM rules LEFT JOIN book ON true GROUP BY ALL
"""

_CHAT = r"""
WITH t AS (
  SELECT conv_id, list((coalesce(role, 'unknown'), coalesce(text, '')) ORDER BY turn) AS turns
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id),
whole AS (SELECT min(conv_id) AS conv_id, turns, count(*) AS n_copies FROM t GROUP BY turns),
inner_prefix AS (
  SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM whole))
SELECT conv_id, CAST(len(turns) AS BIGINT) AS n_turns, CAST(n_copies AS BIGINT) AS n_copies,
       array_to_string(list_transform(turns, lambda x: '<|im_start|>' || replace(x[1], '<|', '< |')
         || chr(10) || replace(x[2], '<|', '< |') || '<|im_end|>' || chr(10)), '') AS rendered
FROM whole w WHERE NOT EXISTS (SELECT 1 FROM inner_prefix p WHERE p.turns = w.turns)
"""

_CONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[i:i + 9], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM grams))),
hits AS (SELECT doc_id, i, p.size, item FROM places p JOIN grams USING (size, g)),
words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM worded, (VALUES (1), (2), (3)) s(size))
  GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 10),
inside AS (
  SELECT lang, part, max(a) AS longer
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part
        FROM candidates WHERE size = 3)
  GROUP BY ALL),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inside i ON c.lang = i.lang AND c.phrase = i.part
  WHERE longer IS NULL OR 100 * longer < 50 * c.a),
cuts AS (
  SELECT k.lang, k.phrase, k.a, cut, x.a AS l, y.a AS r,
         (1000000::HUGEINT * k.a * k.a) // (x.a::HUGEINT * y.a) AS score
  FROM (SELECT *, unnest(range(1, size)) AS cut FROM kept) k
  JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(w[1:cut], ' ')
  JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

_TRIE = r"""
WITH t AS (
  SELECT conv_id, list({'h': md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')),
    'w': len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda y, k: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) % 4 AS h
  FROM t),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(o.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM crc c LEFT JOIN t o ON o.conv_id = c.conv_id - c.conv_id % 20),
prefixes AS (
  SELECT conv_id, len(turns) AS size, d AS depth, turns[d].w AS words,
         md5(array_to_string(list_transform(turns[1:d], lambda x: x.h), '')) AS key,
         md5(array_to_string(list_transform(turns[1:d - 1], lambda x: x.h), '')) AS above
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT depth, key, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(any_value(words), 0) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = depth), ''))
           AS ends_sha256
  FROM prefixes GROUP BY depth, key),
children AS (SELECT depth - 1 AS depth, above AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
whole AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (depth, key)),
sums AS (
  SELECT p.depth, p.key, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved
  FROM whole n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY ALL)
SELECT w.conv_id, w.depth, up.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM whole w JOIN sums s USING (depth, key)
LEFT JOIN nodes up ON w.depth > 0 AND up.depth = w.depth - 1 AND up.key = w.above
"""

ORACLES = {"op11_phrase_tries": _PHRASES, "op13_prefix_trie": _TRIE, "op1_line_dedup": _LINES, "op6_chat_collapse": _CHAT,
           "op8_decontamination": _CONTAMINATION, "op9_quality_rules": _LEDGER, "quality_ablations": _ABLATIONS}
