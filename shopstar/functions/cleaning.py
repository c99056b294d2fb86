"""Column-level cleaning helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstar.sources.store import written

# Unicode-aware whitespace (tab, newline, no-break space ...), like str.strip.
_LEADING = r"(?U)^\s+"
_TRAILING = r"(?U)\s+$"


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of every kind."""
    return F.regexp_replace(F.regexp_replace(c, _LEADING, ""), _TRAILING, "")


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip every string column, leave the others untouched."""
    return df.select(*[
        strip(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def dedupe_first(df: DataFrame, key: str | list[str]) -> DataFrame:
    """One row per key (P5), deterministically: the row whose remaining
    columns are smallest (NULL first). An aggregate, not a window, so it
    combines map-side and a hot key never meets in one task."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    return (df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__first"))
            .select(*keys, *[F.col(f"__first.{c}").alias(c) for c in rest]))


def dedupe_rare(df: DataFrame, key: str) -> DataFrame:
    """:func:`dedupe_first` of a table whose keys seldom repeat. A minimum over
    rows sorts them on both sides of a shuffle of whole rows; here only the
    keys are counted and shuffled, those that repeat are written, and only
    their rows meet. The other rows stay where they are, ``df`` itself if no
    key repeats. Any number of repeats gives the same rows."""
    repeated = written(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key), "repeated")
    if repeated.isEmpty():
        return df
    keys = repeated.select(F.col(key).alias("__key"))
    met = F.col(key).eqNullSafe(F.col("__key"))  # a null key is a key
    return df.join(keys, met, "left_anti").unionByName(
        dedupe_first(df.join(keys, met, "left_semi"), key).select(*df.columns))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL (P4), other columns are untouched."""
    return df.select(*[
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def whole_number(text: Column, dtype: T.DataType) -> Column:
    """Integer from text as frames with missing values write it (P4): ``3`` or
    ``3.0``; empty or NaN is NULL; anything else is an error, never a guess."""
    clean = F.trim(text)
    exact = clean.rlike(r"^[+-]?\d+(\.0*)?$")
    return F.when(clean.isNull() | F.lower(clean).isin("", "nan"), F.lit(None)).when(
        exact, F.regexp_replace(clean, r"\..*$", "").cast(dtype)).otherwise(
        F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast(dtype)).cast(dtype)


def date_key(d: Column) -> Column:
    """Date -> yyyymmdd integer."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def utc_naive(ts_text: Column) -> Column:
    """Lenient parse of ISO-8601 text with a zone, to a zone-less UTC
    timestamp; invalid text gives NULL (P10)."""
    instant = F.try_to_timestamp(ts_text)
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"),
                              instant.cast("timestamp_ntz"))
