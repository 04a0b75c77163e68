"""Craft chain: C01, C02, D02, E01, E02, B09–B11 and S1–S3, S5, with the
sample goldens (one snapshot, FIXTURES.md §2)."""

import datetime as dt

import pytest

from pricelens.operators import (cheapest_route, cost_lines, market_prices, material_prices,
                                 profit_rows, route_cost, with_min_cost)

T0 = dt.datetime(2026, 5, 19, 15, 37, 56)
RECIPE_COLS = "result_item string, material_name string, quantity int, craft_fee int, route string, result_quantity int"
LOG_COLS = "collected_at timestamp_ntz, category string, item_name string, price long, day_of_week int"


def _recipe(spark, rows):
    return spark.createDataFrame(rows, RECIPE_COLS)


def _log(spark, rows):
    return spark.createDataFrame([(T0, c, n, p, 3) for c, n, p in rows], LOG_COLS)


def _costs(spark, recipe_rows, log_rows, **kw):
    recipe = _recipe(spark, recipe_rows)
    mats = material_prices(_log(spark, log_rows))
    lines = cost_lines(recipe, mats, collapse=kw.pop("collapse", None))
    return route_cost(lines, recipe, **kw)


def test_sample_worked_check(spark):
    # 1.10·64 + 10.16·8 + 2.18·26 = 208.36; (208.36 + 172) / 30 = 12.67867
    recipe = [("R", "고대 유물", 64, 172, "고고학", 30), ("R", "오레하 유물", 8, 172, "고고학", 30),
              ("R", "희귀한 유물", 26, 172, "고고학", 30)]
    log = [("고고학", "고대 유물", 110), ("고고학", "오레하 유물", 1016), ("고고학", "희귀한 유물", 218)]
    r = _costs(spark, recipe, log).collect()[0]
    assert r["route_material_cost"] == pytest.approx(208.36)
    assert r["route_craft_cost"] == pytest.approx((208.36 + 172) / 30)
    assert r["joined_lines"] == 3


def test_fanout_parity_and_collapse(spark):
    # a material listed twice in one snapshot counts twice in parity
    recipe = [("R", "m1", 10, 0, "a", 1), ("R", "m2", 1, 0, "a", 1)]
    log = [("x", "m1", 100), ("x", "m1", 300), ("x", "m2", 50)]
    par = _costs(spark, recipe, log).collect()[0]
    col = _costs(spark, recipe, log, collapse="min").collect()[0]
    assert par["route_material_cost"] == pytest.approx((100 + 300) / 100 * 10 + 0.5)
    assert par["joined_lines"] == 3
    assert col["route_material_cost"] == pytest.approx(100 / 100 * 10 + 0.5)
    assert par["route_craft_cost"] >= col["route_craft_cost"]


def test_missing_ingredient_parity_and_complete(spark):
    # route b lacks one of its two ingredients: costed (and cheaper) in parity (S3)
    recipe = [("R", "m1", 1, 0, "a", 1), ("R", "m2", 1, 0, "a", 1),
              ("R", "m1", 1, 0, "b", 1), ("R", "m3", 1, 0, "b", 1)]
    log = [("x", "m1", 100), ("x", "m2", 100)]
    best = cheapest_route(_costs(spark, recipe, log)).collect()[0]
    assert best["route"] == "b"
    best_c = cheapest_route(_costs(spark, recipe, log, require_complete=True)).collect()[0]
    assert best_c["route"] == "a"


def test_route_tie_is_deterministic(spark):
    recipe = [("R", "m1", 1, 0, "zeta", 1), ("R", "m1", 1, 0, "alpha", 1)]
    log = [("x", "m1", 100)]
    rows = cheapest_route(_costs(spark, recipe, log)).collect()
    assert len(rows) == 1 and rows[0]["route"] == "alpha"   # S5


def test_window_min_matches_aggregate(spark):
    recipe = [("R", "m1", 2, 5, "a", 2), ("R", "m2", 1, 5, "b", 2)]
    log = [("x", "m1", 100), ("x", "m2", 500)]
    rc = _costs(spark, recipe, log)
    m = with_min_cost(rc).filter("route_craft_cost = min_craft_cost").collect()
    best = cheapest_route(rc).collect()
    assert len(m) == 1 and m[0]["route"] == best[0]["route"] == "a"


def test_profit_rows_strict_and_aligned(spark):
    cost = spark.createDataFrame([("R", T0, 3, 10.0, "a")],
                                 "result_item string, collected_at timestamp_ntz, day_of_week int, craft_cost double, route string")
    log = spark.createDataFrame(
        [(T0, "p", "R", 10, 3), (T0, "p", "R", 11, 3),
         (T0 + dt.timedelta(seconds=1), "p", "R", 50, 3), (T0, "q", "R", 99, 3)], LOG_COLS)
    p = profit_rows(market_prices(log, "p", ["R"]), cost).orderBy("market_price").collect()
    assert [(r.market_price, r.is_profitable) for r in p] == [(10, False), (11, True)]
    assert p[1]["profit"] == pytest.approx(1.0)
