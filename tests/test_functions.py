"""Column helpers: labels, money arithmetic, fixed-point text, safe ratios."""

import pytest

from pricelens.functions import (day_label, discount_pct, fixed, line_units, lower_bound,
                                 share_pct, unit_cost)


def test_day_label_defaults(spark):
    df = spark.createDataFrame([(1,), (4,), (7,), (0,), (None,)], "d int")
    got = [(r.a, r.b) for r in df.select(day_label("d").alias("a"), day_label("d", "?").alias("b")).collect()]
    assert got == [("일", "일"), ("수", "수"), ("토", "토"), (None, "?"), (None, "?")]


def test_money(spark):
    df = spark.createDataFrame([(110, 64, 172, 30, 100.0, 10.0, 80)],
                               "p long, q int, fee int, out int, avg double, sd double, price long")
    r = df.select(line_units("p", "q").alias("u"),
                  unit_cost(line_units("p", "q"), "fee", "out").alias("c"),
                  lower_bound("avg", "sd", 2.0).alias("lb"),
                  discount_pct("price", "avg").alias("d"),
                  share_pct("price", "avg").alias("s")).collect()[0]
    assert r.u == 7040
    assert r.c == pytest.approx((70.40 + 172) / 30)
    assert r.lb == 80.0 and r.d == 20.0 and r.s == 80.0


def test_zero_denominators_are_null(spark):
    df = spark.createDataFrame([(5, 0, 0.0)], "p long, out int, avg double")
    r = df.select(unit_cost("p", "p", "out").alias("c"), discount_pct("p", "avg").alias("d"),
                  share_pct("p", "out").alias("s")).collect()[0]
    assert r.c is None and r.d is None and r.s is None


def test_fixed(spark):
    df = spark.createDataFrame([(0.35271,), (-0.4119,)], "r double")
    assert [x[0] for x in df.select(fixed("r", 4)).collect()] == ["0.3527", "-0.4119"]
