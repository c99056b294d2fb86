"""Weighted selection without a sort: at which rank, counted from the largest
value, the running sum of the values reaches a target.

The values' range is cut into ``BINS`` equal parts; one aggregation gives count
and sum of each (a bounded number of rows on the driver). The target is crossed
inside one part, which is cut up in the next round, so a range of 2^63 takes
some seven rounds over the table and no rows move. Equal values need no order:
each adds the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 1024


def rank_reaching(df: DataFrame, value: str, target: int) -> int | None:
    """The least number of the largest values (integers) whose sum is
    ``target`` or more, a positive number; None if all values above zero
    together are less. ``df`` is read once per round: pass a written table."""
    df = df.where(F.col(value) > 0).select(value)
    low, high, total = df.agg(F.min(value), F.max(value), F.sum(value)).first()
    if total is None or total < target:
        return None
    rank, reached = 0, 0  # of the values above ``high``
    while low < high:
        width = -(-(high - low + 1) // BINS)
        part = F.expr(f"({high}L - `{value}`) div {width}L")
        bins = df.where(F.col(value).between(low, high)).groupBy(part.alias("part")).agg(
            F.count("*").alias("n"), F.sum(value).alias("s")).collect()
        for r in sorted(bins, key=lambda r: r.part):
            if reached + r.s >= target:
                high, low = high - r.part * width, max(low, high - (r.part + 1) * width + 1)
                break
            rank, reached = rank + r.n, reached + int(r.s)
    return rank + -(-(target - reached) // low)
