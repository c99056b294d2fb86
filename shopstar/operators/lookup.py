"""Left lookup on a nullable key that survives a dominant NULL.

``fact LEFT JOIN lookup ON fact.key = lookup.key``: NULL keys never match,
but when the lookup is not broadcast, a shuffle sends every NULL-key row to
one partition (e.g. most order lines carry no promotion). The join instead
probes with ``coalesce(key, stand-in)``, where the stand-in comes from a
unique column of the row, so NULL-key rows spread over all partitions. A
``key IS NOT NULL`` guard in the join condition keeps a stand-in from ever
matching, so the result equals the plain left join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def left_lookup(df: DataFrame, key: str, lookup: DataFrame, spread_col: str,
                *values: str) -> DataFrame:
    """``df`` with ``values`` of the ``lookup`` row whose ``key`` matches
    (NULLs when none does). ``spread_col`` is unique per row of ``df``."""
    if isinstance(df.schema[key].dataType, T.StringType):
        standin = F.col(spread_col).cast("string")
    else:
        standin = -F.col(spread_col)
    probe = F.coalesce(F.col(key), standin.cast(df.schema[key].dataType))
    right = lookup.select(F.col(key).alias("__lk"), *values)
    return (df.join(right, (probe == F.col("__lk")) & F.col(key).isNotNull(), "left")
            .drop("__lk"))
