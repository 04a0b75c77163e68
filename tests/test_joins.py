"""join_checked: broadcast below the bound, plain join above, same rows."""

from pricelens.operators import join_checked


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_checked_both_paths(spark):
    big = spark.range(1000).selectExpr("id % 10 AS k", "id AS v")
    small = spark.range(10).selectExpr("id AS k", "id * 2 AS w")
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    prev = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:      # switch off Spark's own size-based broadcast
            spark.conf.set(k, "-1")
        a = join_checked(big, small, "k", max_bytes=1000)
        b = join_checked(big, small, "k", max_bytes=5)
        assert "BroadcastExchange" in _plan(a) and "SortMergeJoin" not in _plan(a)
        assert "SortMergeJoin" in _plan(b)
        assert sorted(a.collect()) == sorted(b.collect())
        assert a.count() == 1000
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_join_checked_without_materialize(spark):
    big = spark.range(100).selectExpr("id % 4 AS k", "id AS v")
    small = spark.range(4).selectExpr("id AS k", "id * 3 AS w")
    a = join_checked(big, small, "k", max_bytes=1000, materialize=False)
    assert "BroadcastExchange" in _plan(a)
    assert a.count() == 100


def test_sized_conf():
    from pricelens.session import sized_conf
    c = sized_conf(100 * 1024 ** 4, 8000)          # 100 TB over 1000 executors × 8 cores
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(sized_conf(10 ** 6, 8)["spark.sql.shuffle.partitions"]) == 24


def test_value_bytes_are_counted(spark):
    from pricelens.operators.joins import value_bytes
    df = spark.createDataFrame([(1, "abc", [1, 2]), (2, None, None)], "a long, b string, c array<int>")
    assert value_bytes(df.select("a")) == 2 * 16
    assert value_bytes(df.select("a", "b")) == 2 * 16 + (3 + 8) + 8
    assert value_bytes(df) > value_bytes(df.select("a", "b")) and value_bytes(df.limit(0)) == 0


def test_join_split_hot_keys(spark):
    """A third of all rows has one key, another tenth a second; NULL keys, unmatched rows, repeated rows on both sides."""
    from collections import Counter
    from pricelens.operators.joins import SALT, join_split, salted
    big = spark.range(6000).selectExpr("case when id % 3 = 0 then 'hot' when id % 10 = 1 then 'warm' when id % 97 = 0 then null "
                                       "else concat('k', id % 50) end AS k", "id % 1500 AS v")
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("warm", 3), (None, 4), *[(f"k{i}", i) for i in range(40)], ("k1", 99)],
                                  "k string, w int")
    prev = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        for how in ("inner", "left", "left_semi", "left_anti", "full"):
            got = Counter(tuple(r) for r in join_split(big, small, "k", how).collect())
            assert got == Counter(tuple(r) for r in big.join(small, "k", how).collect()), how
        left, right = salted(big, small, ["k"])
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        sizes = [r["count"] for r in left.filter("k is not null").groupBy("k", SALT).count().collect()]
        assert max(sizes) < 1.6 * 6000 / n                      # no part holds more than an even share, by chance a bit more
        assert right.count() < small.count() + 3 * n            # only hot keys are repeated
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", prev)
    assert join_split(big.limit(0), small, "k").count() == 0
