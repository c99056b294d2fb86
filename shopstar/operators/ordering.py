"""Global order without a single-partition window.

``row_number() OVER (ORDER BY k)`` and running sums over a global order move
every row into one task (``Exchange SinglePartition``). Here, at every size:

1. the rows are range-partitioned on the full sort tuple (Spark samples the
   bounds; any orderable type, and a hot leading value is split by the later
   columns), sorted inside each partition and written once with their place:
   partition number and position;
2. counts and sums per partition are read from the written table and prefixed:
   one row per written partition;
3. a row's number is its partition's offset plus its position, a running sum
   its partition's offset plus a window inside the partition.

The input is run twice (bounds, rows) and shuffled once. The written table
cuts the lineage, so places stay the same when tasks are retried; for running
sums it is bucketed by the partition, so their windows need no shuffle. Sums must be
decimals or integers so they do not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstar.sources.bucketed import written_bucketed
from shopstar.sources.store import written

_PLACE, _PART = "__place", "__part"
_POSITION_BITS = 33  # of monotonically_increasing_id
_PARTITION_BITS = 20  # of its 30 for the partition, where rows come in parts: at most 1,024 of them


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def place_rows(df: DataFrame, order_cols: Sequence[str | Column], **values: Column) -> DataFrame:
    """``df`` with ``values``, range-partitioned and sorted (NULLs first), and
    each row's place in that order."""
    # a named column orders as it is: only expressions are columns of their own in the shuffle
    made = {f"__k{i}": c for i, c in enumerate(order_cols) if not isinstance(c, str)}
    keyed = df.select("*", *[c.alias(n) for n, c in made.items()],
                      *[v.alias(n) for n, v in values.items()])
    names = [c if isinstance(c, str) else f"__k{i}" for i, c in enumerate(order_cols)]
    ordering = [F.col(n).asc_nulls_first() for n in names]
    return (keyed.repartitionByRange(*ordering).sortWithinPartitions(*ordering)
            .withColumn(_PLACE, F.monotonically_increasing_id()).drop(*made))


def global_order(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    row_number_col: str | None = None,
    *,
    start: int = 1,
    running_sums: dict[str, str | Column] | None = None,
    keep: Sequence[str] | None = None,
    parts: Sequence[DataFrame] = (),
) -> DataFrame:
    """Add a dense row number (from ``start``) and/or running sums in the
    ascending order of ``order_cols`` (NULLs first). ``parts``: further rows,
    each part's all behind those of the part before; each is shuffled and
    written by itself (see :func:`ranges`).

    Callers sort descending by negating a numeric column; the order must be
    total (end with a unique key) for the numbering to be deterministic. Of
    the columns only ``keep`` (default: all) is written and returned.
    """
    keep = df.columns if keep is None else list(keep)
    running_sums = dict(running_sums or {})
    value_names = {name: f"__v_{name}" for name in running_sums}
    part = F.shiftright(_PLACE, _POSITION_BITS).alias(_PART)
    if parts and running_sums:
        raise ValueError("running sums of rows in parts are not built")
    if len(parts) >> (30 - _PARTITION_BITS):
        raise ValueError(f"{len(parts) + 1} parts are too many")
    each = []
    for k, rows in enumerate((df, *parts)):
        placed = place_rows(rows, order_cols, **{value_names[n]: _as_col(v) for n, v in running_sums.items()})
        placed = placed.withColumn(_PLACE, F.col(_PLACE) + (k << (_POSITION_BITS + _PARTITION_BITS))) if k else placed
        each.append(placed.select(*keep, *value_names.values(), _PLACE))
    if running_sums:  # a partition's rows stay together: its running sums move no rows
        placed = written_bucketed(each[0].select("*", part), "ordered", _PART, _PLACE)
    else:
        placed = written(each[0], "ordered", *each[1:]).select("*", part)
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = (placed.groupBy(_PART).agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(v).alias(v) for v in value_names.values()])
        .select(_PART, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n"),
                *[F.sum(v).over(before).alias(f"{v}_before") for v in value_names.values()]))
    inside = Window.partitionBy(_PART).orderBy(_PLACE) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = placed.select("*", *[F.sum(v).over(inside).alias(f"{v}_own") for v in value_names.values()]) \
        .join(F.broadcast(offsets), _PART)
    if row_number_col:
        position = F.col(_PLACE).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
        out = out.withColumn(row_number_col, (F.col("__n") + position + start).cast("long"))
    for name, value in value_names.items():
        kind = placed.select(F.sum(value)).schema[0].dataType
        so_far, own = F.col(f"{value}_before"), F.col(f"{value}_own")
        out = out.withColumn(name, F.when(so_far.isNull(), own).when(own.isNull(), so_far)
                             .otherwise((so_far + own).cast(kind)))
    added = [c for c in [row_number_col, *running_sums] if c]
    return out.select(*[c for c in keep if c not in added], *added)


def ranges(df: DataFrame, key: str, n: int, beside: str | None = None) -> list[tuple]:
    """(rows, least, most): ``df`` in up to ``n`` parts by ranges of the whole
    number ``key``, nulls first, with the bounds of the column ``beside`` in
    each. Every row is in one part, whatever the bounds; a thousandth of the
    keys, by their hash, makes the parts about equal."""
    some = df.where(F.pmod(F.xxhash64(key), F.lit(1000)) == 0)
    cuts = some.agg(F.percentile_approx(key, [k / n for k in range(1, n)], 10_000)).first()[0] if n > 1 else None
    cuts = sorted(set(cuts or ()))
    part = F.lit(0)
    for cut in cuts:
        part = part + F.coalesce((F.col(key) > cut).cast("int"), F.lit(0))
    at = F.col(beside or key)
    found = {r[0]: r[1:] for r in df.groupBy(part.alias("part")).agg(F.min(at), F.max(at)).collect()}  # n rows at most
    out = []
    for k in range(len(cuts) + 1):
        inside = F.lit(True)
        if k:
            inside = F.col(key) > cuts[k - 1]
        if k < len(cuts):
            inside = inside & (F.col(key) <= cuts[k]) if k else F.col(key).isNull() | (F.col(key) <= cuts[k])
        if k in found:
            out.append((df.where(inside), *found[k]))
    return out or [(df, None, None)]


def dense_key(df: DataFrame, order_cols: Sequence[str | Column], name: str,
              start: int = 1, *parts: DataFrame) -> DataFrame:
    """Dense surrogate key ``start..start+n-1`` in business-key order."""
    out = global_order(df, order_cols, name, start=start, parts=parts)
    return out.select(name, *[c for c in df.columns])


def segmented_exclusive_sum(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_col: str,
    value_col: str,
    name: str,
    bucket_width: int = 4096,
) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY p ORDER BY o ROWS UNBOUNDED PRECEDING
    AND 1 PRECEDING)`` that survives one huge partition value.

    Rows are split into (p, o div bucket_width) segments: one shuffle computes
    each segment's total, a window over the much smaller segment table gives
    the totals of earlier segments of the same p, and the in-segment running
    sum adds to it. ``order_col`` must be an integral column unique within p.
    """
    seg = "__seg"
    with_seg = df.withColumn(seg, F.floor(F.col(order_col) / F.lit(bucket_width)))
    seg_totals = with_seg.groupBy(*partition_cols, seg).agg(F.sum(value_col).alias("__seg_sum"))
    prev = Window.partitionBy(*partition_cols).orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)
    seg_offsets = seg_totals.select(*partition_cols, seg,
                                    F.sum("__seg_sum").over(prev).alias("__seg_off"))
    joined = with_seg.join(seg_offsets, [*partition_cols, seg])
    inner = Window.partitionBy(*partition_cols, seg).orderBy(order_col) \
        .rowsBetween(Window.unboundedPreceding, -1)
    running = F.sum(value_col).over(inner)
    total = F.when(F.col("__seg_off").isNull(), running) \
        .when(running.isNull(), F.col("__seg_off")) \
        .otherwise(running + F.col("__seg_off"))
    return joined.withColumn(name, total).drop(seg, "__seg_off")
