"""The analyses end to end on a small landed snapshot (rows from the one
published sample snapshot; goldens from FIXTURES.md §2)."""

import json
import os

import pytest

from pricelens.plans import jobs
from pricelens.sources import read_log

TS = "2026-05-19T15:37:56"
# fixed values: sample listings (category, keyword, price)
SAMPLE = [
    ("고고학", "고대 유물", 110), ("고고학", "희귀한 유물", 218), ("고고학", "오레하 유물", 1016),
    ("낚시", "생선", 130), ("낚시", "생선", 256), ("낚시", "붉은 살 생선", 256),
    ("재련재료", "오레하 융화 재료", 14), ("재련재료", "오레하 융화 재료", 38),
    ("재련재료", "오레하 융화 재료", 69),
]
# fixed values: recipe lines (one product, three routes)
RECIPE = """result_item,material_name,quantity,craft_fee,route,result_quantity
오레하 융화 재료,고대 유물,64,172,고고학,30
오레하 융화 재료,오레하 유물,8,172,고고학,30
오레하 융화 재료,희귀한 유물,26,172,고고학,30
오레하 융화 재료,생선,80,172,낚시,30
오레하 융화 재료,붉은 살 생선,40,172,낚시,30
오레하 융화 재료,아비도스 태양 잉어,10,172,낚시,30
오레하 융화 재료,두툼한 생고기,80,172,수렵,30
오레하 융화 재료,다듬은 생고기,40,172,수렵,30
오레하 융화 재료,아비도스 두툼한 생고기,10,172,수렵,30
"""


@pytest.fixture()
def landed(tmp):
    d = f"{tmp}/raw/2026-05-19/15"
    os.makedirs(d)
    rows = [{"collected_at": TS, "category": c, "item_name": n, "grade": "일반", "price": p,
             "quantity": 0, "end_date": ""} for c, n, p in SAMPLE]
    with open(f"{d}/auction_20260519_153824.json", "w", encoding="utf-8") as f:
        json.dump(rows, f, ensure_ascii=False, indent=2)
    with open(f"{tmp}/recipe.csv", "w", encoding="utf-8") as f:
        f.write(RECIPE)
    return tmp


def test_prepare_and_analyses(spark, landed):
    out = jobs.prepare(spark, f"{landed}/raw/*/*/*.json", f"{landed}/recipe.csv", f"{landed}/out")
    assert out["auction_log_rows"] == len(SAMPLE)
    profit = spark.read.parquet(out["craft_profit"])
    rows = sorted(profit.collect(), key=lambda r: r.market_price)
    assert out["craft_profit_rows"] == 3 == len(rows)
    assert {r.route for r in rows} == {"고고학"}
    assert [r.market_price for r in rows] == [14, 38, 69]
    for r, p in zip(rows, [1.32133, 25.32133, 56.32133]):
        assert r.craft_cost == pytest.approx(12.678666, abs=1e-5)
        assert r.profit == pytest.approx(p, abs=1e-5) and r.is_profitable

    trend = jobs.daily_trend(spark, out["auction_log"]).collect()
    assert [(r.item_name, r.day_label, r.avg_price, r.min_price, r.max_price, r.record_count)
            for r in trend] == [("오레하 융화 재료", "화", 40.0, 14, 69, 3)]

    q2 = jobs.craft_profit_by_weekday(spark, out["craft_profit"]).collect()
    assert [(r.route, r.avg_profit, r.avg_craft_cost, r.avg_market_price, r.profitable_pct)
            for r in q2] == [("고고학", 28.0, 13.0, 40.0, 100.0)]

    corr = jobs.correlation(spark, out["auction_log"])
    assert all(r.r is None for r in corr["category_corr"].collect())   # one weekday: NULL, no error
    assert corr["item_corr"].count() == 0                               # support < 50
    cwa = corr["category_weekday_avg"].collect()
    assert [(r.category, r.day_of_week, r.avg_price) for r in cwa] == [("재련재료", 3, 40.3)]

    folders = jobs.correlation_report(spark, corr, f"{landed}/q3")
    text = [r.value for f in folders for r in spark.read.text(f).collect()]
    assert "  재련재료: n/a (n/a n/a)" in text
    assert "  재련재료 | 요일3 | 40.3골드" in text

    parts = jobs.anomaly(spark, out["auction_log"], out=f"{landed}/anomaly")
    assert parts["counts"].collect()[0].total_rows == 0                 # category absent
    folders = jobs.anomaly_report(spark, parts, f"{landed}/report")
    assert len(folders) == 3


def test_anomaly_job_on_category(spark, landed):
    out = jobs.prepare(spark, f"{landed}/raw/*/*/*.json", f"{landed}/recipe.csv", f"{landed}/out2")
    parts = jobs.anomaly(spark, out["auction_log"], category="낚시", k=0.5)
    c = parts["counts"].collect()[0]
    assert c.total_rows == 3
    assert c.anomaly_rows == parts["anomalies"].count()


def test_prepare_options(spark, landed):
    # collapse="min": 생선 priced at its cheapest listing; require_complete: the
    # 낚시 route lacks 아비도스 태양 잉어 and is dropped, leaving 고고학.
    out = jobs.prepare(spark, f"{landed}/raw/*/*/*.json", f"{landed}/recipe.csv", f"{landed}/o3",
                       collapse="min", require_complete=True)
    rows = spark.read.parquet(out["craft_profit"]).collect()
    assert {r.route for r in rows} == {"고고학"}
    assert all(r.craft_cost == pytest.approx(12.678666, abs=1e-5) for r in rows)
    from pricelens.operators import cost_lines, material_prices, route_cost
    from pricelens.sources import read_recipe
    log = spark.read.parquet(out["auction_log"])
    recipe = read_recipe(spark, f"{landed}/recipe.csv")
    par = {r.route: r for r in route_cost(cost_lines(recipe, material_prices(log))).collect()}
    col = {r.route: r for r in route_cost(cost_lines(recipe, material_prices(log), "min")).collect()}
    # 낚시 parity: (1.30 + 2.56)·80 + 2.56·40 = 411.2; collapsed: 1.30·80 + 2.56·40 = 206.4
    assert par["낚시"].route_material_cost == pytest.approx(411.2)
    assert col["낚시"].route_material_cost == pytest.approx(206.4)
    assert par["낚시"].joined_lines == 3 and col["낚시"].joined_lines == 2


def test_cli_all_steps(spark, landed):
    from pricelens.plans.cli import run
    done = run(spark, "all", f"{landed}/raw/*/*/*.json", f"{landed}/recipe.csv",
               f"{landed}/cli", f"{landed}/results")
    assert set(done) == {"prepare", "trend", "profit", "correlation", "anomaly"}
    assert spark.read.parquet(done["trend"]).count() == 1
    assert spark.read.parquet(done["profit"]).collect()[0].profitable_pct == 100.0
    assert spark.read.parquet(f"{landed}/results/q3_category_weekday_avg").count() == 1


def test_prepare_dates_matches_full_recompute(spark, landed, tmp):
    # a second day of listings, landed next to the first
    d = f"{landed}/raw/2026-05-20/09"
    os.makedirs(d)
    rows = [{"collected_at": "2026-05-20T09:00:00", "category": c, "item_name": n, "grade": "",
             "price": p + 7, "quantity": 0, "end_date": ""} for c, n, p in SAMPLE]
    with open(f"{d}/auction_20260520_090000.json", "w", encoding="utf-8") as f:
        json.dump(rows, f, ensure_ascii=False)
    full = jobs.prepare(spark, f"{landed}/raw/*/*/*.json", f"{landed}/recipe.csv", f"{tmp}/full")
    inc = f"{tmp}/inc"
    jobs.prepare_dates(spark, full["auction_log"], f"{landed}/recipe.csv", inc, ["2026-05-19"])
    jobs.prepare_dates(spark, full["auction_log"], f"{landed}/recipe.csv", inc, ["2026-05-20"])
    jobs.prepare_dates(spark, full["auction_log"], f"{landed}/recipe.csv", inc, ["2026-05-20"])
    cols = ["result_item", "collected_at", "market_price", "craft_cost", "route", "profit"]
    a = sorted(tuple(r) for r in spark.read.parquet(full["craft_profit"]).select(*cols).collect())
    b = sorted(tuple(r) for r in read_log(spark, inc).select(*cols).collect())
    assert a == b and len(a) == 6


def test_refresh_in_place_after_prepare(spark, landed):
    from pricelens.plans.cli import run
    out = f"{landed}/inplace"
    run(spark, "prepare", f"{landed}/raw/*/*/*.json", f"{landed}/recipe.csv", out, None)
    before = sorted(tuple(r) for r in read_log(spark, f"{out}/craft_profit").collect())
    run(spark, "refresh", None, f"{landed}/recipe.csv", out, None, dates=["2026-05-19"])
    after = sorted(tuple(r) for r in read_log(spark, f"{out}/craft_profit").collect())
    assert before == after and len(after) == 3


def test_prepare_dates_empties_a_date(spark, landed, tmp):
    from pricelens.sources import load_date, write_landing
    from pricelens.sources.published import live_folders
    from pricelens import schemas
    out = jobs.prepare(spark, f"{landed}/raw/*/*/*.json", f"{landed}/recipe.csv", f"{tmp}/out")
    profit = out["craft_profit"]
    assert spark.read.parquet(profit).count() > 0
    fixed = spark.createDataFrame([("2026-05-19T15:00:00", "c", "a", "g", "0", 0, "")], schemas.RAW_AUCTION)
    write_landing(fixed, f"{tmp}/land")
    load_date(spark, f"{tmp}/land", out["auction_log"], ["2026-05-19"])
    jobs.prepare_dates(spark, out["auction_log"], f"{landed}/recipe.csv", profit, ["2026-05-19"])
    assert live_folders(spark, profit) == {}
