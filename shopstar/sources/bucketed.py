"""Tables laid out by the hash of one key, so that joins and sums by that key
need no shuffle.

``write_bucketed`` shuffles once and writes one sorted file per bucket. Spark
knows the layout of a table that its catalog describes, so a table is
registered for a moment under a name made from its folder; the frame that was
read by it keeps the layout, the catalog keeps nothing. For later sessions the
layout is kept beside the tables, one row each (``open_bucketed``).

Tables with the same number of buckets meet bucket by bucket. A bucket is one
task and is not split further, so the key must be one whose rows per value are
few by nature, as an order's lines are.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopstar.session import scratch_folder

_LAYOUT = "name string, key string, buckets int, ddl string, version long"


def _table(path: str) -> str:
    return f"bucketed_{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:16]}"


def _lay_out(df: DataFrame, path: str, key: str, buckets: int, *order: str) -> None:
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_table(path)}")
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *order).option("path", path) \
        .saveAsTable(_table(path))


def _known(spark: SparkSession, path: str) -> DataFrame:
    """The registered table; its entry goes, its files stay."""
    df = spark.table(_table(path))
    spark.sql(f"DROP TABLE {_table(path)}")
    return df


def write_bucketed(df: DataFrame, root: str, name: str, key: str, buckets: int) -> int:
    """Overwrite ``root/name`` with ``df`` in ``buckets`` sorted files by the
    hash of ``key``; returns the observed row count."""
    spark, path, obs = df.sparkSession, f"{root}/{name}", Observation()
    _lay_out(df.observe(obs, F.count(F.lit(1)).alias("rows")).repartition(buckets, key), path, key, buckets)
    spark.sql(f"DROP TABLE {_table(path)}")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    version = F.unix_micros(F.current_timestamp()).alias("version")
    spark.range(1).coalesce(1).select(*[F.lit(v).alias(c) for c, v in (
        ("name", name), ("key", key), ("buckets", buckets), ("ddl", ddl))], version) \
        .write.mode("append").parquet(f"{root}/_layout")
    return int(obs.get["rows"])


def open_bucketed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table written last as ``root/name``, its layout known to the planner."""
    path = f"{root}/{name}"
    at = spark.read.schema(_LAYOUT).parquet(f"{root}/_layout").where(F.col("name") == name) \
        .orderBy(F.desc("version")).first()
    spark.sql(f"DROP TABLE IF EXISTS {_table(path)}")
    spark.sql(f"CREATE TABLE {_table(path)} ({at.ddl}) USING parquet OPTIONS (path {_quoted(path)}) "
              f"CLUSTERED BY ({at.key}) SORTED BY ({at.key}) INTO {at.buckets} BUCKETS")
    return _known(spark, path)


def written_bucketed(df: DataFrame, name: str, key: str, *order: str) -> DataFrame:
    """``df``, whose tasks hold the rows of each ``key`` together already, as a
    table in the scratch folder that Spark knows to be so: a window or sum by
    the key then moves no rows."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    _lay_out(df, path, key, int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    return _known(spark, path)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
