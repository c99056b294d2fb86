"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one failure bit per rule; policies are versioned masks over those bits, so
a new policy or an ablation reads the ledger and never the texts.

Main path: DataFrame functions only, no shuffle. One row per input row.
Defined cases: a null text has no words (all measurements 0), an empty or
blank text likewise; repeated rows and null ids give a row each; an empty
table gives an empty ledger; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstar.llm.common import WORD_CHAR, let, split_words

SYMBOLS = "[#*$%&|<>]"
WINDOW = 3


@dataclass(frozen=True)
class Rule:
    """``fails`` maps the measurement columns to a condition; ``bit`` is the
    rule's place in the mask and never changes once published."""
    bit: int
    name: str
    fails: Callable[[], Column]


RULES = (
    Rule(0, "few_words", lambda: F.col("n_words") < 50),
    Rule(1, "repeated_words", lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    Rule(2, "symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule(3, "repeated_lines", lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    Rule(4, "word_length", lambda: (F.col("word_chars") < 2 * F.col("n_words"))
         | (F.col("word_chars") > 20 * F.col("n_words"))),
)


@dataclass(frozen=True)
class Policy:
    """A named version: the rules that reject a document."""
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << r.bit for r in RULES if r.name in self.rules)

    @property
    def column(self) -> str:
        return f"kept_{self.name}_v{self.version}"


BASE = Policy("base", 1, ("few_words", "repeated_words"))
WEB = Policy("web", 1, tuple(r.name for r in RULES))


def _n_repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more. Windows are
    64-bit hashes with their places, sorted within the text; only texts that
    hold a repeated hash pay for the sort."""
    def covered(places: Column) -> Column:
        widths = F.transform(places, lambda p, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(widths, F.lit(0), lambda a, x: a + x)

    def repeated(hashes: Column) -> Column:
        keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return let(keyed, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["p"])))

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(repeated(h), covered))))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _measured(docs: DataFrame, key: Column, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    by_words = let(split_words(F.col(text_col)), lambda w: F.struct(
        F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"),
        _n_repeat_words(w).alias("n_repeat_words")))
    by_lines = let(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR)),
                   lambda x: F.struct(F.size(x).alias("n_lines"),
                                      (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    found = docs.select(key.alias("key"), by_words.alias("w"), by_lines.alias("l"),
                        F.struct(F.regexp_count(text, F.lit(SYMBOLS)).alias("n_symbols")).alias("s"))
    return found.select("key", "w.*", "l.*", "s.*").select(
        "key", *[F.col(c).cast("long").alias(c) for c in MEASURES])


def _bits(rules: tuple[Rule, ...]) -> Column:
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit).cast("long"))
                              .otherwise(F.lit(0).cast("long")))
    return bits


def _book(docs: DataFrame, key: Column, text_col: str, rules: tuple[Rule, ...]) -> DataFrame:
    return _measured(docs, key, text_col).withColumn("fail_bits", _bits(rules))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, the measurements, fail_bits): bit ``rule.bit`` is set if it failed."""
    return _book(docs, F.col(id_col), text_col, rules).withColumnRenamed("key", "doc_id")


def keep_documents(docs: DataFrame, policy: "Policy", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass ``policy``, all columns unchanged: the
    policy is applied to a ledger whose key is the whole row."""
    book = apply_policies(_book(docs, F.struct("*"), text_col, RULES), (policy,))
    return book.where(F.col(policy.column)).select(*[F.col("key")[c].alias(c) for c in docs.columns])


def passes(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0


def apply_policies(book: DataFrame, policies: tuple[Policy, ...]) -> DataFrame:
    """The ledger with one boolean ``kept_<name>_v<version>`` per policy."""
    return book.select("*", *[passes(p).alias(p.column) for p in policies])


def ablations(book: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per rule of the policy: documents that fail it, documents that
    only it rejects (they return if the rule is dropped), and the rules that
    fail together with it (``with_any``: or, ``with_all``: and of the masks).
    One pass over the bits; an empty ledger gives counts of 0."""
    own = [r for r in rules if r.name in policy.rules]
    seen = F.col("fail_bits").bitwiseAND(F.lit(policy.mask))
    aggs = []
    for r in own:
        bit = F.lit(1 << r.bit).cast("long")
        hit = seen.bitwiseAND(bit) != 0
        aggs.append(F.struct(
            F.lit(r.name).alias("rule"), F.count(F.when(hit, 1)).alias("n_failed"),
            F.count(F.when(seen == bit, 1)).alias("n_only"),
            F.coalesce(F.bit_or(F.when(hit, seen)), F.lit(0).cast("long")).alias("with_any"),
            F.coalesce(F.bit_and(F.when(hit, seen)), F.lit(0).cast("long")).alias("with_all")))
    return book.agg(F.array(*aggs).alias("a")).select(F.inline("a"))
