"""NULL weekdays, costs and pairs; whole numbers beyond a double's reach."""

from pyspark.sql import functions as F

from pricelens.functions.stats import safe_corr
from pricelens.operators import cheapest_route, clean, peak_days, route_cost, weekday_delta


def test_corr_skips_rows_with_a_null_side(spark):
    rows = [(i, 2.0 * i + (i % 3)) for i in range(7)] + [(None, 900.0), (5, None)]
    df = spark.createDataFrame(rows, "x int, y double")
    got = df.agg(safe_corr("x", "y").alias("a"), F.corr("x", "y").alias("b")).first()
    assert abs(got["a"] - got["b"]) < 1e-12


def test_cheapest_route_ignores_routes_without_a_cost(spark):
    df = spark.createDataFrame([("p", "d", 1, None, "bad"), ("p", "d", 1, 3.0, "good"), ("q", "d", 1, None, "bad")],
                               "result_item string, collected_at string, day_of_week int, route_craft_cost double, route string")
    assert [(r["result_item"], r["route"], r["craft_cost"]) for r in cheapest_route(df).collect()] == [("p", "good", 3.0)]


def test_complete_routes_count_on_the_same_keys(spark):
    recipe = spark.createDataFrame([("p", "a", 1, 5, "r", 1), ("p", "b", 1, None, "r", 1)],
                                   "result_item string, material_name string, quantity int, craft_fee int, route string, result_quantity int")
    lines = recipe.selectExpr("result_item", "'d' as collected_at", "1 as day_of_week", "craft_fee", "route", "result_quantity",
                              "material_name", "100L as line_units", "1L as line_count")
    assert route_cost(lines, recipe, require_complete=True).count() == 2


def test_trends_leave_out_rows_without_a_weekday(spark):
    rows = [("c", "i", None, 90.0), ("c", "i", 1, 10.0), ("c", "i", 2, 20.0), ("c", "i", 4, 40.0)]
    trend = spark.createDataFrame(rows, "category string, item_name string, day_of_week int, avg_raw double")
    assert {r["day_of_week"]: r["delta_pct"] for r in weekday_delta(trend).collect()} == {1: None, 2: 100.0, 4: None}
    best = peak_days(trend).first()
    assert (best["peak_day"], best["low_day"]) == (4, 1)


def test_whole_prices_are_exact(spark):
    raw = spark.createDataFrame([("2024-01-01T00:00:00", "i", p) for p in ("9007199254740993", "12.9", "0.5")],
                                "collected_at string, item_name string, price string")
    assert sorted(r["price"] for r in clean(raw).collect()) == [0, 12, 9007199254740993]
