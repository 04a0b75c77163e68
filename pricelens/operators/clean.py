"""Cleaning raw rows into a typed price log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(df: DataFrame, item_col: str = "item_name", price_col: str = "price",
          ts_col: str = "collected_at") -> DataFrame:
    """Raw rows → price log.

    * drop rows whose item or price is NULL (B01);
    * keep ``price > 0`` tested on the numeric value *before* the long cast,
      so 0.5 passes and becomes 0 (B02, S6);
    * parse the zone-less timestamp text as TIMESTAMP_NTZ (wall clock, S13),
      unparseable text → NULL instead of an ANSI error (B03, S4);
    * price → long, whole numbers exactly, others by truncation, overflow →
      NULL (B03);
    * ``day_of_week`` 1=Sunday…7=Saturday and ``hour_of_day`` (B04).  Rows
      with a NULL timestamp stay, with NULL calendar columns.

    Other columns pass through unchanged.
    """
    price_num = _c(price_col).try_cast("double")
    ts = _c(ts_col).try_cast("timestamp_ntz")
    return (df.dropna(subset=[item_col, price_col])
              .filter(price_num > 0)
              .withColumn(ts_col, ts)
              .withColumn(price_col, F.coalesce(_c(price_col).try_cast("long"), price_num.try_cast("long")))
              .withColumn("day_of_week", F.dayofweek(ts_col))
              .withColumn("hour_of_day", F.hour(ts_col)))


def in_categories(df: DataFrame, categories: list[str] | None,
                  col: str = "category") -> DataFrame:
    """Set membership on the category (B05); None keeps every row."""
    if categories is None:
        return df
    return df.filter(F.col(col).isin(list(categories)))


def with_calendar(df: DataFrame, ts_col: str = "collected_at") -> DataFrame:
    """Add ``day_of_week`` and ``hour_of_day`` to an already typed log."""
    return (df.withColumn("day_of_week", F.dayofweek(ts_col))
              .withColumn("hour_of_day", F.hour(ts_col)))
