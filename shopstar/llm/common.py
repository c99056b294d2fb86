"""Pieces shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstar.session import scratch_folder

#: Separators of the two word definitions, as Java and RE2 both read them.
SPACES = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_AZ = bytes(range(ord("A"), ord("Z") + 1))
#: Byte tables: A-Z to a-z; and the same with every separator of NON_WORD a blank.
LOWER = bytes.maketrans(_AZ, _AZ.lower())
LOWER_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isdigit() or 97 <= b <= 122 else 32
    for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_words(text: Column, separators: str = SPACES) -> Column:
    """Words of ``text`` in order; none for null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once. A column referred to
    inside a lambda would otherwise be evaluated for each element."""
    return F.transform(F.array(value), body)[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: the lineage is cut,
    the rows survive lost executors, and a later join knows their size."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_once(df: DataFrame, name: str) -> DataFrame:
    """As ``written``; the job's shuffle files are deleted once it is done."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return written(df, name)
    finally:
        conf.set(key, before)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a written intermediate table that no later step reads."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def text_bytes(value: str | None) -> bytes:
    return (value or "").encode("utf-8", "surrogatepass")
