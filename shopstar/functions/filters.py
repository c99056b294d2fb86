"""Dashboard slice: date range, parent categories, channels.

Sales are filtered on the order date, returns on the return date. The
category and channel lists become semi joins against the filtered (small)
dimension, so the fact is never widened; the date range is a plain
predicate on the fact's own key, which reaches the Parquet scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.functions.cleaning import date_key


def _month(day: dt.date) -> int:
    return day.year * 100 + day.month


@dataclass(frozen=True)
class QueryFilters:
    start_date: dt.date | None = None
    end_date: dt.date | None = None
    categories: tuple[str, ...] = field(default_factory=tuple)
    channels: tuple[str, ...] = field(default_factory=tuple)

    def __post_init__(self):
        if self.start_date and self.end_date and self.start_date > self.end_date:
            raise ValueError(f"the slice ends ({self.end_date}) before it starts ({self.start_date})")
        object.__setattr__(self, "categories", tuple(self.categories))
        object.__setattr__(self, "channels", tuple(self.channels))

    def _dates(self, df: DataFrame, col: str, month: str) -> DataFrame:
        """Bounds as the keys of their days: constants that reach the scan.
        Over a fact written by month they bound the months too, so that other
        months' folders are not listed for reading."""
        by_month = month in df.columns
        if self.start_date:
            df = df.where(F.col(col) >= date_key(F.lit(self.start_date)))
            df = df.where(F.col(month) >= _month(self.start_date)) if by_month else df
        if self.end_date:
            df = df.where(F.col(col) <= date_key(F.lit(self.end_date)))
            df = df.where(F.col(month) <= _month(self.end_date)) if by_month else df
        return df

    def _channels(self, df: DataFrame, star: dict[str, DataFrame]) -> DataFrame:
        if self.channels:
            wanted = star["dim_channel"].where(F.col("channel_name").isin(*self.channels))
            df = df.join(wanted.select("channel_key"), "channel_key", "left_semi")
        return df

    def sales(self, star: dict[str, DataFrame]) -> DataFrame:
        """``fact_sales`` restricted to the slice."""
        f = self._dates(star["fact_sales"], "order_date_key", "order_month")
        if self.categories:
            cats = star["dim_category"].where(F.col("parent_category").isin(*self.categories))
            f = f.join(cats.select("category_key"), "category_key", "left_semi")
        return self._channels(f, star)

    def returns(self, star: dict[str, DataFrame]) -> DataFrame:
        """``fact_returns`` restricted to the slice (category via the product)."""
        r = self._dates(star["fact_returns"], "return_date_key", "return_month")
        if self.categories:
            cats = star["dim_category"].where(F.col("parent_category").isin(*self.categories))
            prods = star["dim_product"].join(cats.select("category_key"), "category_key",
                                             "left_semi")
            r = r.join(prods.select("product_key"), "product_key", "left_semi")
        return self._channels(r, star)


#: The slice that holds everything.
EVERYTHING = QueryFilters()
