"""Weekday/price correlation.

The original ran two Spark jobs per item from a driver loop; here each
grouping is one aggregate (partial + final), whatever the number of groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions import direction, safe_corr, strength
from pricelens.functions.labels import STRONG_ABOVE


def corr_by(df: DataFrame, key: str, x: str = "day_of_week", y: str = "price",
            min_n: int | None = None, scale: int | None = 4) -> DataFrame:
    """Pearson r(x, y) and n per ``key`` (D09, D10), with labels.

    r is NULL where undefined (constant column, n ≤ 1; S7, S9).  With
    ``min_n`` groups with fewer rows are dropped (B19, a HAVING).  ``r`` is
    rounded to ``scale`` places (None keeps it raw); labels use the raw r,
    which ``r_raw`` carries on for ``corr_extremes`` and ``corr_ranked``.
    """
    g = df.groupBy(key).agg(safe_corr(x, y).alias("r_raw"), F.count(F.lit(1)).alias("n"))
    if min_n is not None:
        g = g.filter(F.col("n") >= min_n)
    r = F.col("r_raw") if scale is None else F.round("r_raw", scale)
    return g.select(key, r.alias("r"), "n",
                    direction("r_raw").alias("direction"),
                    strength("r_raw").alias("strength"), "r_raw")


def _raw(c: DataFrame) -> str:
    """The column of ``c`` to rank by: the raw r where it is carried."""
    return "r_raw" if "r_raw" in c.columns else "r"


def distinct_items(df: DataFrame, col: str = "item_name") -> DataFrame:
    """Distinct item names."""
    return df.select(col).distinct()


def min_support(df: DataFrame, min_n: int = 50, col: str = "n") -> DataFrame:
    """Keep groups with at least ``min_n`` rows."""
    return df.filter(F.col(col) >= min_n)


def _top(df: DataFrame, k: int, order, pos_order=None) -> DataFrame:
    """Top-k rows by ``order`` with a 1-based position (by ``pos_order``,
    default ``order``).

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: every task keeps
    its own k best rows and only those are merged, so the position window
    afterwards runs over at most k rows."""
    top = df.orderBy(*order).limit(k)
    return top.withColumn("pos", F.row_number().over(Window.orderBy(*(pos_order or order))))


def corr_extremes(c: DataFrame, k: int = 10, key: str = "item_name") -> DataFrame:
    """Strongest k and weakest k groups by |r|.

    Ranked by the raw r (``r_raw``), so that groups which round alike keep
    their order; ``r`` is shown.  NULL r is excluded (S8).  Both lists are ranked strongest-first like the
    printed report: ``strong`` = top k by |r| desc, ``weak`` = bottom k by
    |r|, listed in descending |r| (they overlap when fewer than 2k groups
    exist).  Ties break on the key.
    """
    base = c.filter(F.col("r").isNotNull()).withColumn("abs_r", F.abs(_raw(c)))
    strong = _top(base, k, [F.desc("abs_r"), F.asc(key)]).withColumn("list", F.lit("strong"))
    weak = (_top(base, k, [F.asc("abs_r"), F.desc(key)], [F.desc("abs_r"), F.asc(key)])
            .withColumn("list", F.lit("weak")))
    cols = ["list", "pos", key, "r", "n", "direction"]
    return strong.select(*cols).unionByName(weak.select(*cols))


def corr_ranked(c: DataFrame, key: str = "item_name",
                strong_above: float = STRONG_ABOVE) -> DataFrame:
    """Groups sorted by signed r with sign class and a strong flag.

    Order, sign and flag use the raw r (``r_raw``); ``r`` is shown.  A range-partitioned sort (no single-task window)."""
    raw = _raw(c)
    return (c.filter(F.col("r").isNotNull())
             .orderBy(raw, key)
             .select(key, "r", "n", F.when(F.col(raw) > 0, "positive")
                     .otherwise("negative").alias("sign"),
                     (F.abs(raw) > strong_above).alias("is_strong")))
