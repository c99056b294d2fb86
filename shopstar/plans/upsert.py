"""Keyed upsert of reference rows (S13): rows in ``changes`` replace the
rows of ``target`` with the same key, new keys are added. An anti join plus
a union, so both sides stay distributed. Several changes of one key count as
one: the row whose other columns are smallest, NULLs first (``dedupe_first``),
or, with ``latest_by``, the one where that column is largest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.functions.cleaning import dedupe_first


def upsert(target: DataFrame, changes: DataFrame, keys: list[str],
           latest_by: str | None = None) -> DataFrame:
    rest = [c for c in target.columns if c not in keys]
    if latest_by:
        one = changes.groupBy(*keys).agg(
            F.max_by(F.struct(*rest), F.struct(latest_by, *rest)).alias("__row")).select(
            *keys, "__row.*")
    else:
        one = dedupe_first(changes.select(*target.columns), keys)
    kept = target.join(one.select(*keys), keys, "left_anti")
    return one.select(*target.columns).unionByName(kept)
