"""B01–B05 and the ledger rows S4, S6 (clean_edges table)."""

from pricelens.operators import clean, in_categories
from pricelens import schemas


def _raw(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_AUCTION)


def test_clean_edges(spark):
    ts = "2026-05-19T15:37:56"
    rows = [
        (ts, "c", None, "g", "10", 0, ""),        # item NULL → dropped (B01)
        (ts, "c", "a", "g", None, 0, ""),         # price NULL → dropped (B01)
        (ts, "c", "b", "g", "0", 0, ""),          # price 0 → dropped (B02)
        (ts, "c", "d", "g", "-1", 0, ""),         # negative → dropped (B02)
        (ts, "c", "e", "g", "0.5", 0, ""),        # 0.5 passes, becomes 0 (S6)
        (ts, "c", "f", "g", "7", 0, ""),          # numeric text
        ("not a time", "c", "h", "g", "12", 0, ""),  # bad timestamp → NULL, row kept (S4)
        (ts, "c", "i", "g", "abc", 0, ""),        # non-numeric price → dropped
    ]
    out = {r["item_name"]: r for r in clean(_raw(spark, rows)).collect()}
    assert set(out) == {"e", "f", "h"}
    assert out["e"]["price"] == 0
    assert out["f"]["price"] == 7
    assert out["h"]["collected_at"] is None and out["h"]["day_of_week"] is None
    # 2026-05-19 is a Tuesday: dayofweek 3 (1 = Sunday), hour 15
    assert out["f"]["day_of_week"] == 3 and out["f"]["hour_of_day"] == 15


def test_clean_keeps_wall_clock_independent_of_zone(spark):
    rows = [("2026-05-19T23:59:50", "c", "x", "g", "5", 0, "")]
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = clean(_raw(spark, rows)).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert r["hour_of_day"] == 23 and r["day_of_week"] == 3   # S13


def test_in_categories(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "category string, v int")
    assert [r.category for r in in_categories(df, ["a", "c"]).orderBy("category").collect()] == ["a", "c"]
    assert in_categories(df, None).count() == 3


def test_filter_and_projection_reach_scan(spark, tmp):
    df = spark.createDataFrame([("a", 5, "x")], "category string, price long, other string")
    df.write.parquet(f"{tmp}/p")
    from pricelens.sources import read_log
    plan = read_log(spark, f"{tmp}/p", ["a"], ["price"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "EqualTo(category,a)" in plan.split("PushedFilters:")[1]
    assert "other" not in plan.split("ReadSchema:")[1]
