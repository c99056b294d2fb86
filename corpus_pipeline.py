"""The corpus pipeline: documents to packed training sequences.

Each stage takes the rows its predecessor kept, written as Parquet and read
again: quality rules, line dedup, SimHash near-duplicates, benchmark
decontamination, packing. All but the last return the columns of the input;
the last returns the pieces of the packed sequences with their token ids.
Nulls, empty texts, repeated rows, empty tables and extra columns: as each
operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopstar.llm import decontamination, line_dedup, packing, quality_rules, simhash
from shopstar.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the current web policy."""
    return quality_rules.keep_documents(docs, quality_rules.WEB)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their site's boilerplate lines."""
    return line_dedup.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), mode="documents")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with token ids."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", benchmark), ("packing", pack)]

#: SimHash components and packing have no SQL form; the tests hold the rows
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
