"""Boilerplate lines by their frequency within a site.

For each host: pages that contain a line, divided by the host's pages. Lines
above ``max_ratio`` are dropped from every page of that host; other text stays
as it was. A line must stand on two pages at least: a frequency within a site
means nothing for a line that occurs on one page, and the lines of a host with
a single page all have the ratio 1.

Lines are the trimmed parts between newlines; blank lines are never dropped.
They are counted by a 128-bit hash, each page's lines made distinct first and
summed before the shuffle, so a line on every page of a hot host is one row
per task. A host has fewer than ``lines per page / max_ratio`` boilerplate
lines, so its set is one small row; those rows are written and joined by host,
broadcast only if the written size is under Spark's threshold, else by a
shuffle whose hot hosts AQE splits.

Defined cases: a null text stays null; pages of a null host form one group;
repeated rows count as pages each; an empty table gives an empty result; all
columns of the input come back unchanged but for the text (and ``n_chars``,
its new length, where that column exists).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstar.llm.common import SPACES, let, written

#: Production parameters.
MAX_RATIO = 0.08
MIN_PAGES = 2


def _line_hash(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, rf"\A{SPACES}|{SPACES}\z", "")  # $ also matches before U+0085, U+2028, U+2029


def _hashes(text: Column) -> Column:
    """Hash of each line in order; null for a blank line."""
    return F.transform(F.split(text, "\n"), lambda x: let(_trimmed(x), lambda t: F.when(
        t != "", _line_hash(t))))


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): per host the sorted hashes of its boilerplate lines."""
    pages = docs.select(F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    counted = (pages.select("host", F.explode(F.array_distinct(F.concat(
        # the null entry stands for the page itself: totals come from the same scan
        F.array(F.lit(None).cast("struct<a:bigint,b:bigint>")),
        F.coalesce(F.filter(_hashes(F.col("text")), lambda x: x.isNotNull()),
                   F.array().cast("array<struct<a:bigint,b:bigint>>"))))).alias("line"))
        .groupBy("host", "line").agg(F.count("*").alias("pages")))
    totals = counted.where("line is null").select(
        F.col("host").alias("t_host"), F.col("pages").alias("total"))
    frequent = counted.where(F.col("line").isNotNull() & (F.col("pages") >= min_pages))
    return (frequent.join(totals, F.col("host").eqNullSafe(F.col("t_host")))
            .where(F.col("pages") > F.lit(max_ratio) * F.col("total"))
            .groupBy("host").agg(F.sort_array(F.collect_set("line")).alias("lines")))


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                     max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` as (row, new_text, n_lines, n_dropped): the input row as a
    struct, so that no column of it can clash, and its cleaned text."""
    bad = written(boilerplate(docs, host_col, text_col, max_ratio, min_pages), "boilerplate")
    rows = docs.select(F.struct("*").alias("row"))
    text = F.col("row")[text_col]
    lines = F.arrays_zip(F.split(text, "\n").alias("t"), _hashes(text).alias("h"))
    kept = F.when(F.col("lines").isNull(), lines).otherwise(F.filter(
        lines, lambda x: x["h"].isNull() | ~F.array_contains(F.col("lines"), x["h"])))
    joined = rows.join(bad, F.col("row")[host_col].eqNullSafe(F.col("host")), "left")
    cleaned = joined.select("row", let(kept, lambda k: F.struct(
        F.array_join(F.transform(k, lambda x: x["t"]), "\n").alias("text"),
        F.size(k).alias("n"))).alias("k"), F.size(F.split(text, "\n")).alias("n_lines"))
    null = text.isNull()
    return cleaned.select(
        "row", F.when(~null, F.col("k.text")).alias("new_text"),
        F.when(null, 0).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
        F.when(null, 0).otherwise(F.col("n_lines") - F.col("k.n")).cast("long").alias("n_dropped"))


def clean_documents(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with boilerplate lines removed from the text."""
    text_col = params.get("text_col", "text")
    out = drop_boilerplate(docs, **params)
    return out.select(*[
        F.col("new_text").alias(c) if c == text_col
        else F.length("new_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col("row")[c].alias(c) for c in docs.columns])
