"""Outliers: B12–B14, C03, D05–D07, D13–D15, F02, F04, K04, K05; S10, S11, S17."""

import datetime as dt
import statistics

import pytest

from pricelens.operators import (anomaly_by_weekday, anomaly_summary, flag_low, low_outliers,
                                 run_counts, top_anomalies, top_discount, top_flags,
                                 weekday_flags, weekday_share, with_stats)

T = dt.datetime(2026, 5, 21)


def _log(spark, rows):
    return spark.createDataFrame([(n, p, d, T) for n, p, d in rows],
                                 "item_name string, price long, day_of_week int, collected_at timestamp_ntz")


def _item(prefix_prices, name, dow=5):
    return [(name, p, dow) for p in prefix_prices]


def test_single_row_item_not_flagged(spark):
    out = flag_low(with_stats(_log(spark, [("solo", 5, 1)]))).collect()[0]
    assert out["std_price"] is None and out["is_anomaly"] is None        # S10
    assert low_outliers(_log(spark, [("solo", 5, 1)])).count() == 0


def test_boundary_is_strict_and_brute_force(spark):
    prices = [100] * 20 + [10, 40]
    rows = _item(prices, "a") + _item([7, 7, 7], "flat") + _item([1, 1000, 1000, 1000, 1000], "b", 4)
    got = sorted((r.item_name, r.price) for r in low_outliers(_log(spark, rows)).collect())
    exp = []
    for name in ("a", "flat", "b"):
        ps = [p for n, p, _ in rows if n == name]
        lb = statistics.mean(ps) - 2 * statistics.stdev(ps)
        exp += [(name, p) for p in ps if p < lb]
    assert got == sorted(exp)
    assert ("flat", 7) not in got       # price == bound is not an outlier (strict)


def test_summaries(spark):
    prices = [100] * 30 + [5, 6]
    rows = _item(prices[:31], "a", 5) + [("a", 6, 1)] + _item([50] * 30 + [1], "b", 5)
    a = low_outliers(_log(spark, rows))
    s = {r.item_name: r for r in anomaly_summary(a).collect()}
    assert s["a"]["anomaly_count"] == 2 and s["a"]["min_anomaly_price"] == 5
    assert s["b"]["anomaly_count"] == 1
    top = top_anomalies(anomaly_summary(a), 1).collect()
    assert [r.item_name for r in top] == ["a"]
    assert top_discount(anomaly_summary(a)).collect()[0]["item_name"] == "b"
    by = {r.day_of_week: r.anomaly_count for r in anomaly_by_weekday(a).collect()}
    assert by == {5: 2, 1: 1}
    share = {r.day_of_week: r.share_pct for r in weekday_share(anomaly_by_weekday(a)).collect()}
    assert share == {5: pytest.approx(66.7), 1: pytest.approx(33.3)}
    flags = {r.day_of_week: (r.day_label, r.is_busy) for r in weekday_flags(anomaly_by_weekday(a)).collect()}
    assert flags[5] == ("목", False)
    tf = top_flags(anomaly_summary(a), 10).collect()
    assert all(r.deep_discount == (r.avg_discount_pct > 30) for r in tf)
    c = run_counts(flag_low(with_stats(_log(spark, rows)))).collect()[0]
    assert (c.total_rows, c.anomaly_rows) == (len(rows), 3)
    assert c.anomaly_pct == pytest.approx(round(3 / len(rows) * 100, 2))
