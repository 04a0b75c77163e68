"""Moments by date: merged statistics equal those of all rows, and a refresh reads its dates only."""

import statistics

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.operators import daily_moments, merged_stats, read_moments, refresh_moments


def _log(spark):
    rows = [(f"i{k % 7}", f"2026-05-{1 + k % 20:02d}", 1 + k % 20 % 7, 10 ** 9 + (k * k) % 101) for k in range(700)]
    rows += [("one", "2026-05-01", 3, 5), ("flat", "2026-05-01", 1, 9), ("flat", "2026-05-02", 2, 9), ("none", "2026-05-01", 1, None)]
    return spark.createDataFrame(rows, "item_name string, date string, day_of_week int, price long")


def test_merged_stats_equal_whole(spark):
    log = _log(spark)
    by = {}
    for r in log.collect():
        if r.price is not None:
            by.setdefault(r.item_name, []).append((r.day_of_week, r.price))
    got = {r.item_name: r for r in merged_stats(daily_moments(log)).collect()}
    assert set(got) == set(by)
    for k, pairs in by.items():
        x, y = zip(*pairs)
        assert got[k].n == len(y) and abs(got[k].avg - statistics.mean(y)) < 1e-5
        if len(y) == 1:
            assert got[k].std is None and got[k].r is None
            continue
        assert abs(got[k].std - statistics.stdev(y)) < 1e-6 * (1 + statistics.stdev(y))
        if k == "flat":
            assert got[k].r is None
        else:
            assert abs(got[k].r - statistics.correlation(x, y)) < 1e-6


def test_refresh_replaces_dates(spark, tmp):
    log = _log(spark)
    last = ["2026-05-19", "2026-05-20"]
    wrong = log.withColumn("price", F.when(F.col("date").isin(last), F.lit(1)).otherwise(F.col("price")))
    refresh_moments(wrong, f"{tmp}/m", None)
    refresh_moments(log, f"{tmp}/m", last)
    refresh_moments(log, f"{tmp}/m", last)
    stats = lambda df: sorted((r.item_name, r.n, round(r.avg, 4), round(r.std or -1, 4)) for r in merged_stats(df).collect())
    assert stats(read_moments(spark, f"{tmp}/m", T.StringType())) == stats(daily_moments(log))
    refresh_moments(log.filter("date != '2026-05-20'"), f"{tmp}/m", ["2026-05-20"])      # an emptied date
    assert stats(read_moments(spark, f"{tmp}/m", T.StringType())) == stats(daily_moments(log.filter("date != '2026-05-20'")))
