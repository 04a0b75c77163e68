"""D09–D11, B17–B19, F03, K03 and S7–S9 (const_price table)."""

import pytest
from pyspark.sql import functions as F

from pricelens.functions import safe_corr
from pricelens.operators import corr_by, corr_extremes, corr_ranked, distinct_items


def _rows():
    rows = []
    rows += [("const", d, 100) for d in range(1, 8)]            # zero variance → NULL r
    rows += [("single", 3, 10)]                                 # n = 1 → NULL r
    rows += [("up", d, 10 * d) for d in range(1, 8)]            # r = 1
    rows += [("down", d, -5 * d + 3) for d in range(1, 8)]      # r = -1
    rows += [("n49", 1 + i % 7, i) for i in range(49)]
    rows += [("n50", 1 + i % 7, (i * 37) % 11) for i in range(50)]
    return rows


def _df(spark):
    return spark.createDataFrame(_rows(), "item_name string, day_of_week int, price long")


def test_safe_corr_nulls_and_matches_builtin(spark):
    df = _df(spark)
    r = {x.item_name: x for x in corr_by(df, "item_name").collect()}
    assert r["const"]["r"] is None and r["const"]["direction"] is None    # S7, S9
    assert r["single"]["r"] is None
    assert r["up"]["r"] == pytest.approx(1.0) and r["up"]["direction"] == "양(+)"
    assert r["down"]["r"] == pytest.approx(-1.0) and r["down"]["strength"] == "강"
    # agrees with F.corr where F.corr is defined
    ok = df.filter(F.col("item_name").isin("n49", "n50", "up"))
    a = {x[0]: x[1] for x in ok.groupBy("item_name").agg(F.corr("day_of_week", "price")).collect()}
    b = {x[0]: x[1] for x in ok.groupBy("item_name").agg(safe_corr("day_of_week", "price")).collect()}
    for k in a:
        assert b[k] == pytest.approx(a[k], abs=1e-12)


def test_min_support_boundary(spark):
    names = {x.item_name for x in corr_by(_df(spark), "item_name", min_n=50).collect()}
    assert "n50" in names and "n49" not in names                           # B19


def test_strength_thresholds(spark):
    from pricelens.functions import strength, direction
    df = spark.createDataFrame([(0.3,), (0.31,), (0.1,), (0.11,), (0.0,), (-0.5,)], "r double")
    got = [(x.r, x.s, x.d) for x in df.select("r", strength("r").alias("s"), direction("r").alias("d")).collect()]
    assert got == [(0.3, "중", "양(+)"), (0.31, "강", "양(+)"), (0.1, "약", "양(+)"),
                   (0.11, "중", "양(+)"), (0.0, "약", "음(-)"), (-0.5, "강", "음(-)")]


def test_extremes_exclude_null_and_order(spark):
    c = corr_by(_df(spark), "item_name")
    e = corr_extremes(c, 2).collect()
    strong = [x.item_name for x in sorted(e, key=lambda x: (x.list, x.pos)) if x.list == "strong"]
    weak = [x.item_name for x in sorted(e, key=lambda x: (x.list, x.pos)) if x.list == "weak"]
    assert strong == ["down", "up"]                  # |r| ties → name
    assert "const" not in weak and "single" not in weak   # S8
    assert len(weak) == 2
    absr = {x.item_name: abs(x.r) for x in c.collect() if x.r is not None}
    assert absr[weak[0]] >= absr[weak[1]]            # printed strongest-first
    ranked = [x.item_name for x in corr_ranked(c).collect()]
    assert ranked[0] == "down" and ranked[-1] == "up"


def test_ranked_by_raw_r(spark):
    # All round to 0.9999 or to 0.0; names run against the raw order.
    def rows(name, bump):
        return [(name, d, 1_000_000 * d + (bump if d == 4 else 0)) for d in range(1, 8)]
    def flat(name, bump):      # symmetric but for the bump
        return [(name, d, 1_000_000 * abs(d - 4) + (bump if d == 7 else 0)) for d in range(1, 8)]
    data = [*rows("a", 80_000), *rows("b", 79_000), *rows("c", 78_000), *flat("x", 30), *flat("y", 20), *flat("z", -10)]
    c = corr_by(spark.createDataFrame(data, "item_name string, day_of_week int, price long"), "item_name")
    r = {x.item_name: x.r for x in c.collect()}
    assert len({r[k] for k in "abc"}) == 1 and len({abs(r[k]) for k in "xyz"}) == 1
    got = {(x.list, x.pos): x.item_name for x in corr_extremes(c, 2).collect()}
    assert got == {("strong", 1): "c", ("strong", 2): "b", ("weak", 1): "y", ("weak", 2): "z"}
    ranked = corr_ranked(c).collect()
    assert [x.item_name for x in ranked] == ["z", "y", "x", "a", "b", "c"]
    assert [x.sign for x in ranked] == ["negative"] + ["positive"] * 5
    raw = c.filter("item_name = 'a'").first().r_raw
    strong = {x.item_name: x.is_strong for x in corr_ranked(c, strong_above=raw + 1e-9).collect()}
    assert strong["b"] and not strong["a"]


def test_distinct_items(spark):
    assert distinct_items(_df(spark)).count() == 6
