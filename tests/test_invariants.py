"""Invariants on the driver tables (SURVEY §5 (4))."""

import os

import pytest
from pyspark.sql import functions as F

from pricelens.plans import driver

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_one_route_per_result_and_snapshot(spark):
    best = driver.q_cheapest_route(spark, SF)
    assert best.count() == best.select("result_item", "collected_at").distinct().count() > 0


def test_parity_cost_not_below_collapsed(spark):
    keys = ["result_item", "collected_at", "route"]
    par = driver.q_route_cost(spark, SF).select(*keys, F.col("route_craft_cost").alias("p"))
    col = driver.q_route_cost_collapsed(spark, SF).select(*keys, F.col("route_craft_cost").alias("c"))
    j = par.join(col, keys)
    assert j.count() == par.count()
    assert j.filter(F.col("p") < F.col("c") - 1e-9).count() == 0


def test_weekday_counts_sum_to_total(spark):
    total = driver.q_outlier_rate(spark, SF).collect()[0].anomaly_rows
    by_day = driver.q_outlier_by_weekday(spark, SF).agg(F.sum("anomaly_count")).collect()[0][0]
    assert by_day == total
    share = driver.q_weekday_share(spark, SF).agg(F.sum("share_pct")).collect()[0][0]
    assert share == pytest.approx(100.0, abs=0.5)


def test_complete_routes_are_a_subset(spark):
    keys = ["result_item", "collected_at"]
    comp = driver.q_cheapest_route_complete(spark, SF)
    allr = driver.q_route_cost(spark, SF)
    assert comp.join(allr, keys + ["route"], "left_anti").count() == 0
