"""Statistics that are refreshed by date (D05, D09, D10): one row of moments per
item and date, merged when asked.

A date's rows are summed up on their own (count, sums, squared deviations, their
product), so a refresh reads only the dates that changed and publishes only their
moments; the statistics of an item merge its dates' rows, of which there are as
many as dates, not as listings.  Merging adds deviations of the dates' means from
the item's mean to those within the dates, which cancels nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.sources.published import publish_dates, read_published

MOMENTS = ["n", "sum_x", "sum_y", "dev_x", "dev_y", "dev_xy"]


def daily_moments(log: DataFrame, key: str = "item_name", date: str = "date", x: str = "day_of_week",
                  y: str = "price") -> DataFrame:
    """(key, n, sum_x, sum_y, dev_x, dev_y, dev_xy, date) per key and date of rows whose x and y are known."""
    known = log.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    n = F.count(F.lit(1))
    return known.groupBy(key, date).agg(
        n.alias("n"), F.sum(F.col(x).cast("double")).alias("sum_x"), F.sum(F.col(y).cast("double")).alias("sum_y"),
        (F.var_pop(x) * n).alias("dev_x"),
        (F.var_pop(y) * n).alias("dev_y"), (F.covar_pop(F.col(x).cast("double"), F.col(y).cast("double")) * n).alias("dev_xy")) \
        .select(key, *MOMENTS, F.col(date).alias("date"))


def merged_stats(moments: DataFrame, key: str = "item_name") -> DataFrame:
    """(key, n, avg, std (sample), r) from moments of any parts of the rows."""
    own = Window.partitionBy(key)
    total = F.sum("n").over(own)
    m = moments.withColumn("_x", F.col("sum_x") / F.col("n") - F.sum("sum_x").over(own) / total) \
        .withColumn("_all", F.sum("sum_y").over(own) / total) \
        .withColumn("_y", F.col("sum_y") / F.col("n") - F.col("_all"))
    s = m.groupBy(key).agg(
        F.sum("n").alias("n"), F.min("_all").alias("avg"),
        F.sum(F.col("dev_x") + F.col("n") * F.col("_x") * F.col("_x")).alias("_xx"),
        F.sum(F.col("dev_y") + F.col("n") * F.col("_y") * F.col("_y")).alias("_yy"),
        F.sum(F.col("dev_xy") + F.col("n") * F.col("_x") * F.col("_y")).alias("_xy"))
    return s.select(key, "n", "avg", F.sqrt(F.try_divide("_yy", F.when(F.col("n") > 1, F.col("n") - 1))).alias("std"),
                    F.try_divide(F.col("_xy"), F.sqrt(F.col("_xx")) * F.sqrt(F.col("_yy"))).alias("r"))


def refresh_moments(log: DataFrame, path: str, dates: list[str] | None, key: str = "item_name") -> None:
    """Publishes the moments of the given dates of ``log`` (of all rows, added, if None)."""
    rows = log if dates is None else log.filter(F.col("date").isin(list(dates)))
    publish_dates(daily_moments(rows, key), path, dates)


def read_moments(spark: SparkSession, path: str, key_type: T.DataType, key: str = "item_name") -> DataFrame:
    fields = [T.StructField(key, key_type), T.StructField("n", T.LongType()),
              *[T.StructField(c, T.DoubleType()) for c in MOMENTS[1:]], T.StructField("date", T.StringType())]
    return read_published(spark, path, T.StructType(fields))
