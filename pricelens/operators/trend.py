"""Weekday price trends.

All of these are hash aggregates with map-side partial aggregation, so a hot
item or category is combined inside each map task before the shuffle; the
windows that follow run over at most 7 aggregated rows per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions import day_label
from pricelens.operators.clean import in_categories

WEEKDAYS = list(range(1, 8))


def weekday_trend(log: DataFrame, categories: list[str] | None = None,
                  keep_unrounded: bool = False) -> DataFrame:
    """Q1: per (category, item, weekday) round(avg,0), min, max, count(*)."""
    df = in_categories(log, categories)
    out = (df.groupBy("category", "item_name", "day_of_week")
             .agg(F.avg("price").alias("avg_raw"),
                  F.min("price").alias("min_price"),
                  F.max("price").alias("max_price"),
                  F.count(F.lit(1)).alias("record_count")))
    cols = ["category", "item_name", "day_of_week",
            day_label("day_of_week").alias("day_label"),
            F.round("avg_raw", 0).alias("avg_price"),
            "min_price", "max_price", "record_count"]
    if keep_unrounded:
        cols.append("avg_raw")
    return out.select(*cols)


def category_weekday_avg(log: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """round(avg price, 1) by (category, weekday)."""
    return (in_categories(log, categories)
            .groupBy("category", "day_of_week")
            .agg(F.round(F.avg("price"), 1).alias("avg_price")))


def weekday_delta(trend: DataFrame) -> DataFrame:
    """Change of the weekday average vs the previous weekday, %.

    Input: ``weekday_trend(..., keep_unrounded=True)``.  The window holds the
    ≤7 weekday rows of one (category, item).  Rows without a weekday are left
    out, and after an absent weekday the change is NULL."""
    trend = trend.filter("day_of_week is not null")
    w = Window.partitionBy("category", "item_name").orderBy("day_of_week")
    prev = F.when(F.lag("day_of_week").over(w) == F.col("day_of_week") - 1, F.lag("avg_raw").over(w))
    return trend.select("category", "item_name", "day_of_week",
                        F.round("avg_raw", 0).alias("avg_price"),
                        F.round(F.try_divide(F.col("avg_raw") - prev, prev) * 100, 1)
                        .alias("delta_pct"))


def peak_days(trend: DataFrame) -> DataFrame:
    """Highest and lowest average weekday per (category, item).

    Ties go to the earlier weekday.  ``max(struct(avg, -dow))`` picks the
    highest average and, among equals, the smallest weekday.  Rows without a
    weekday are left out."""
    trend = trend.filter("day_of_week is not null")
    hi = F.max(F.struct(F.col("avg_raw"), (-F.col("day_of_week")).alias("neg_dow")))
    lo = F.min(F.struct(F.col("avg_raw"), F.col("day_of_week")))
    g = trend.groupBy("category", "item_name").agg(hi.alias("hi"), lo.alias("lo"))
    return g.select("category", "item_name",
                    (-F.col("hi.neg_dow")).alias("peak_day"),
                    F.round("hi.avg_raw", 0).alias("peak_avg"),
                    F.col("lo.day_of_week").alias("low_day"),
                    F.round("lo.avg_raw", 0).alias("low_avg"))


def reset_effect(log: DataFrame, reset_dow: int = 4,
                 categories: list[str] | None = None) -> DataFrame:
    """Mean price on the reset weekday vs the other days, per item."""
    d = F.col("day_of_week")
    on = F.avg(F.when(d == reset_dow, F.col("price")))
    off = F.avg(F.when(d != reset_dow, F.col("price")))
    g = (in_categories(log, categories).groupBy("category", "item_name")
         .agg(on.alias("on_raw"), off.alias("off_raw")))
    return g.select("category", "item_name",
                    F.round("on_raw", 0).alias("reset_avg"),
                    F.round("off_raw", 0).alias("other_avg"),
                    F.round(F.try_divide(F.col("on_raw") - F.col("off_raw"),
                                         F.col("off_raw")) * 100, 1).alias("reset_delta_pct"))


def weekday_matrix(log: DataFrame, row_col: str = "item_name", value_col: str = "price",
                   categories: list[str] | None = None, scale: int = 0) -> DataFrame:
    """Row × weekday matrix of round(avg, scale) (K01, chart feed); columns
    d1…d7.

    Seven conditional averages in one aggregate: the same table as
    ``pivot("day_of_week", [1..7])`` but planned as a single partial/final
    aggregate (one shuffle) instead of pivot's two-level aggregate."""
    d = F.col("day_of_week")
    cells = [F.round(F.avg(F.when(d == i, F.col(value_col))), scale).alias(f"d{i}")
             for i in WEEKDAYS]
    return in_categories(log, categories).groupBy(row_col).agg(*cells)
