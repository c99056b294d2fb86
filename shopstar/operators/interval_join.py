"""Interval join (J12): a dated row matches every window with
``start <= point <= end`` (both inclusive; a null end or start is open).

A non-equi join would be a nested loop (rows x windows), and a window exploded
into its days grows with its length. Here points are whole numbers (days of a
date, microseconds of a timestamp) and windows are covered by dyadic nodes:
node n of level k holds the numbers from n * 2^k to (n + 1) * 2^k - 1. A
window is the disjoint union of at most two nodes of each level, some
``2 * log2(length)`` rows, and a point lies in one node of each level, so the
match is an equi-join on (level, node) that meets each pair just once. Points
are only looked up on levels that some window uses. AQE broadcasts the windows'
nodes when their measured size is under the threshold, and splits hot nodes of a
sort-merge join otherwise.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Levels of nodes: numbers from -2^LEVELS to 2^LEVELS - 1, all of Spark's dates and timestamps.
LEVELS = 61
_LEAST, _MOST = -(1 << LEVELS), (1 << LEVELS) - 1


def as_number(value: Column, kind: T.DataType) -> Column:
    """A date's day or a timestamp's microsecond; whole numbers stay."""
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, T.TimestampNTZType):
        since = value - F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz")
        return (since.cast("interval second").cast("decimal(20,6)") * 1_000_000).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    return value.cast("long")


def _shift(value: Column, k: Column) -> Column:
    return F.call_function("shiftright", value, k)


def cover(low: Column, high: Column) -> Column:
    """The dyadic nodes whose union is low..high, as an array of (level, node)."""
    def of(k: Column) -> Column:
        # what is left of the window on level k, in nodes: from a to b - 1
        a = _shift(low + (F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1), k)
        b = _shift(high + 1, k)
        left, right = (a % 2) != 0, (b % 2) != 0
        return F.array(F.when((a < b) & left, F.struct(k.alias("level"), a.alias("node"))),
                       F.when((a < b) & right & ((b - 1) >= a + F.abs(a % 2)),
                              F.struct(k.alias("level"), (b - 1).alias("node"))))

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), of)))


def window_nodes(windows: DataFrame, start_col: str, end_col: str, *keep: str) -> DataFrame:
    """(keep, level, node): the cover of each window that is not empty."""
    def bound(col: str, open_: int) -> Column:
        return F.coalesce(as_number(F.col(col), windows.schema[col].dataType), F.lit(open_).cast("long"))

    return windows.select(*keep, bound(start_col, _LEAST).alias("__low"), bound(end_col, _MOST).alias("__high")) \
        .where("__low <= __high").select(*keep, F.inline(cover(F.col("__low"), F.col("__high"))))


def _looked_up(rows: DataFrame, point: str, nodes: DataFrame, kind: T.DataType) -> DataFrame:
    """(__point, level, node): the distinct points of ``rows`` and the nodes
    that they lie in, on the levels that ``nodes`` use (at most 62)."""
    levels = nodes.agg(F.collect_set("level").alias("__levels"))  # one row
    points = rows.select(as_number(rows[point].cast(kind), kind).alias("__point")).dropna().distinct()
    return points.join(F.broadcast(levels)).select("__point", F.inline(F.transform(
        "__levels", lambda k: F.struct(k.alias("level"), _shift(F.col("__point"), k).alias("node")))))


def interval_join(rows: DataFrame, point: str, windows: DataFrame, start_col: str,
                  end_col: str, *window_cols: str) -> DataFrame:
    """All (row, window) pairs where the row's ``point``, taken as the type of
    the windows' bounds, lies in the window."""
    kind = windows.schema[start_col].dataType
    nodes = window_nodes(windows, start_col, end_col, *window_cols)
    met = _looked_up(rows, point, nodes, kind).join(nodes, ["level", "node"]).drop("level", "node")
    return rows.join(met, as_number(rows[point].cast(kind), kind) == met["__point"]).drop("__point")


def lowest_active(rows: DataFrame, point: str, windows: DataFrame, start_col: str,
                  end_col: str, id_col: str, out_col: str) -> DataFrame:
    """Left join each row to the lowest ``id_col`` among windows active at its
    point (NULL when none is). Aggregated per node and per point before the
    join, so the right side has one row per distinct point."""
    kind = windows.schema[start_col].dataType
    nodes = window_nodes(windows, start_col, end_col, id_col).groupBy("level", "node").agg(F.min(id_col).alias(out_col))
    per_point = (_looked_up(rows, point, nodes, kind).join(nodes, ["level", "node"])
                 .groupBy("__point").agg(F.min(out_col).alias(out_col)))
    return (rows.join(per_point, as_number(rows[point].cast(kind), kind) == per_point["__point"], "left")
            .drop("__point"))
