"""Craft-vs-buy profit by weekday."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions import day_label, share_pct
from pricelens.operators.trend import weekday_matrix


def profit_by_weekday(p: DataFrame) -> DataFrame:
    """Q2: per (result, weekday, route) round(avg(market−cost),0),
    round(avg cost,0), round(avg market,0) and the share of rows with
    market > cost, % to 1 dp (D03, D04)."""
    g = (p.groupBy("result_item", "day_of_week", "route")
          .agg(F.avg(F.col("market_price") - F.col("craft_cost")).alias("p"),
               F.avg("craft_cost").alias("c"),
               F.avg("market_price").alias("m"),
               F.count_if(F.col("market_price") > F.col("craft_cost")).alias("wins"),
               F.count(F.lit(1)).alias("n")))
    return g.select("result_item", "day_of_week",
                    day_label("day_of_week").alias("day_label"),
                    F.round("p", 0).alias("avg_profit"),
                    F.round("c", 0).alias("avg_craft_cost"),
                    F.round("m", 0).alias("avg_market_price"),
                    share_pct("wins", "n").alias("profitable_pct"),
                    "route")


def profit_matrix(p: DataFrame) -> DataFrame:
    """result_item × weekday matrix of round(avg profit, 0) over all routes
    (K02; the aggregation across routes is explicit)."""
    return weekday_matrix(p, row_col="result_item", value_col="profit")
