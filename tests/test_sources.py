"""Sources and sinks: A01, A02, A04–A11, H12, H13; S12, S14, S16."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens import schemas
from pricelens.sources import (flatten_response, load_date, read_landing, read_log, read_raw,
                               read_recipe, register_tables, stamp_run, write_landing,
                               write_parquet, write_report, merge_report, read_report)

LOG = T.StructType([*schemas.AUCTION_LOG.fields, T.StructField("date", T.StringType())])


def test_flatten_response_cases(spark):
    resp = [
        ("kw-full", json.dumps({"TotalCount": 2, "Items": [
            {"Name": "n1", "Grade": "g", "CurrentMinPrice": 5, "Quantity": 1, "EndDate": "e"},
            {"Name": "n2", "Grade": None, "CurrentMinPrice": None, "Quantity": None, "EndDate": None}]})),
        ("kw-missing-keys", json.dumps({"TotalCount": 1, "Items": [{"Name": "n3"}]})),
        ("kw-null-items", json.dumps({"TotalCount": 0, "Items": None})),
        ("kw-absent-items", json.dumps({"TotalCount": 0})),
        ("kw-empty", json.dumps({"TotalCount": 0, "Items": []})),
    ]
    df = spark.createDataFrame(resp, "keyword string, response string")
    out = sorted(tuple(r) for r in flatten_response(df).collect())
    assert out == sorted([
        ("kw-full", "g", 5, 1, "e"),
        ("kw-full", "", 0, 0, ""),            # explicit null → default too (S12 documented)
        ("kw-missing-keys", "", 0, 0, ""),    # absent keys → defaults (A10)
    ])


def test_stamp_run_is_one_literal(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("item_name"))
    vals = {r.collected_at for r in stamp_run(df, "2026-05-19T15:37:56").collect()}
    assert vals == {"2026-05-19T15:37:56"}


def _write_run(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        json.dump(rows, f, ensure_ascii=False, indent=2)


def _row(ts, item, price, cat="c"):
    return {"collected_at": ts, "category": cat, "item_name": item, "grade": "일반",
            "price": price, "quantity": 0, "end_date": ""}


def test_read_raw_multiline_and_bad_file(spark, tmp):
    _write_run(f"{tmp}/raw/2026-05-19/15", "a.json",
               [_row("2026-05-19T15:37:56", "x", 10), _row("2026-05-19T15:37:56", "y", 0.5)])
    with open(f"{tmp}/raw/2026-05-19/15/bad.json", "w") as f:
        f.write('[{"collected_at": "2026-05-19T15:40:00", "item_name": "z", "pri')   # truncated (S16)
    df = read_raw(spark, f"{tmp}/raw/*/*/*.json")
    assert set(df.columns) == set(schemas.RAW_AUCTION.fieldNames())     # no _corrupt_record
    from pricelens.operators import clean
    got = sorted((r.item_name, r.price) for r in clean(df).collect())
    assert got == [("x", 10), ("y", 0)]


def test_read_recipe(spark, tmp):
    p = f"{tmp}/recipe.csv"
    with open(p, "w", encoding="utf-8") as f:
        f.write("result_item,material_name,quantity,craft_fee,route,result_quantity\n"
                "오레하 융화 재료,고대 유물,64,172,고고학,30\n")
    r = read_recipe(spark, p).collect()[0]
    assert (r.material_name, r.quantity, r.craft_fee, r.result_quantity) == ("고대 유물", 64, 172, 30)


def test_landing_partitions_and_midnight(spark, tmp):
    rows = [("2026-05-19T23:59:50", "c", "a", "g", "10", 0, ""),
            ("2026-05-20T00:00:05", "c", "b", "g", "11", 0, "")]
    df = spark.createDataFrame(rows, schemas.RAW_AUCTION)
    write_landing(df, f"{tmp}/land")
    back = read_landing(spark, f"{tmp}/land")
    got = sorted((r.item_name, r.date, r.hour) for r in back.collect())
    assert got == [("a", "2026-05-19", "23"), ("b", "2026-05-20", "00")]    # S14: run time decides
    pruned = back.filter(F.col("date") == "2026-05-20")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert pruned.count() == 1


def test_load_date_idempotent_and_missing(spark, tmp):
    rows = [("2026-05-19T10:00:00", "c", "a", "g", "10", 0, ""),
            ("2026-05-20T10:00:00", "c", "b", "g", "11", 0, "")]
    df = spark.createDataFrame(rows, schemas.RAW_AUCTION)
    write_landing(df, f"{tmp}/land")
    load_date(spark, f"{tmp}/land", f"{tmp}/log", ["2026-05-19"])
    load_date(spark, f"{tmp}/land", f"{tmp}/log", ["2026-05-19"])       # re-run replaces
    load_date(spark, f"{tmp}/land", f"{tmp}/log", ["2026-05-20"])
    got = sorted((r.item_name, str(r.date)) for r in read_log(spark, f"{tmp}/log", schema=LOG).collect())
    assert got == [("a", "2026-05-19"), ("b", "2026-05-20")]
    with pytest.raises(FileNotFoundError):
        load_date(spark, f"{tmp}/land", f"{tmp}/log", ["2030-01-01"])


def test_load_date_empties_a_date(spark, tmp):
    rows = [("2026-05-19T10:00:00", "c", "a", "g", "10", 0, ""),
            ("2026-05-20T10:00:00", "c", "b", "g", "11", 0, ""),
            ("2026-05-21T10:00:00", "c", "d", "g", "12", 0, "")]
    fixed = [(ts, c, i, g, "0", q, e) for ts, c, i, g, _, q, e in rows]          # price 0 is cleaned away
    write_landing(spark.createDataFrame(rows, schemas.RAW_AUCTION), f"{tmp}/land")
    write_landing(spark.createDataFrame(fixed[:1], schemas.RAW_AUCTION), f"{tmp}/one")
    write_landing(spark.createDataFrame(fixed[:2], schemas.RAW_AUCTION), f"{tmp}/two")
    load_date(spark, f"{tmp}/land", f"{tmp}/log")
    def left():
        return sorted(r.item_name for r in read_log(spark, f"{tmp}/log", schema=LOG).collect())
    load_date(spark, f"{tmp}/one", f"{tmp}/log", ["2026-05-19"])
    assert left() == ["b", "d"]
    load_date(spark, f"{tmp}/two", f"{tmp}/log")                               # all landed dates
    assert left() == ["d"]
    load_date(spark, f"{tmp}/land", f"{tmp}/log", ["2026-05-19"])
    assert left() == ["a", "d"]


def test_register_tables_and_sql(spark, tmp):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    write_parquet(df, f"{tmp}/t")
    register_tables(spark, {"t_reg_test": f"{tmp}/t"})
    register_tables(spark, {"t_reg_test": f"{tmp}/elsewhere"})    # IF NOT EXISTS keeps the first
    assert spark.sql("SELECT sum(v) AS s FROM t_reg_test").collect()[0].s == 3


def test_write_report(spark, tmp):
    df = spark.createDataFrame([(2, "two"), (1, "one"), (3, "three")], "o int, line string")
    folders = write_report([("title", df, ["o"])], f"{tmp}/rep")
    lines = [r.value for r in spark.read.text(folders[0]).collect()]
    assert sorted(lines) == sorted(["title", "one", "two", "three"])
    files = sorted(f for f in os.listdir(folders[0]) if f.startswith("part-"))
    text = "".join(open(os.path.join(folders[0], f), encoding="utf-8").read() for f in files)
    assert text.split("\n")[:4] == ["title", "one", "two", "three"]


def test_report_read_and_merged_in_order(spark, tmp):
    """Line numbers over sections, many part files and files read in several pieces."""
    body = spark.range(3000).selectExpr("id o", "concat('  line ', id, ' ', repeat('é', 20)) line")
    write_report([("A", body, ["o"]), ("nothing", body.limit(0), ["o"]), ("B", body, [F.desc("o")]),
                  ("blank", spark.createDataFrame([(1, ""), (2, " ")], "o int, line string"), ["o"])], f"{tmp}/rep")
    texts = [f"  line {i} " + "é" * 20 for i in range(3000)]
    want = list(enumerate(["A", *texts, "nothing", "B", *texts[::-1], "blank", "", " "], 1))
    assert sorted(tuple(r) for r in read_report(spark, f"{tmp}/rep").collect()) == want
    merge_report(spark, f"{tmp}/rep", f"{tmp}/whole")
    files = sorted(f for f in os.listdir(f"{tmp}/whole") if f.startswith("part-"))
    whole = "".join(open(os.path.join(f"{tmp}/whole", f), encoding="utf-8").read() for f in files)
    assert whole.split("\n")[:-1] == [x for _, x in want]
    for size in ("4k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        assert sorted(tuple(r) for r in read_report(spark, f"{tmp}/whole").collect()) == want
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_write_runs_one_array_per_file(spark, tmp):
    from pricelens.sources import write_runs
    rows = [(f"2026-05-19T{h:02d}:00:00", "c", f"i{i}", "g", str(i + 1), 0, "")
            for h in (10, 11) for i in range(25)]
    df = spark.createDataFrame(rows, schemas.RAW_AUCTION)
    write_runs(df, f"{tmp}/runs", target_bytes=1000)
    files = [os.path.join(d, f) for d, _, fs in os.walk(f"{tmp}/runs") for f in fs
             if f.endswith(".txt")]
    for f in files:
        arr = json.load(open(f, encoding="utf-8"))        # the whole file is one array
        assert isinstance(arr, list) and 1 <= len(arr) <= 10
        assert len({r["collected_at"][11:13] for r in arr}) == 1
    assert all(("hour=10" in f) or ("hour=11" in f) for f in files)
    back = read_raw(spark, f"{tmp}/runs/*/*/*.txt")
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_load_date_from_collector_arrays(spark, tmp):
    from pricelens.sources import write_runs
    rows = [("2026-05-19T10:00:00", "c", "a", "g", "10", 0, ""),
            ("2026-05-20T11:00:00", "c", "b", "g", "11", 0, "")]
    write_runs(spark.createDataFrame(rows, schemas.RAW_AUCTION), f"{tmp}/runs")
    load_date(spark, f"{tmp}/runs", f"{tmp}/log", ["2026-05-20"], multi_line=True)
    got = [(r.item_name, r.price, str(r.date)) for r in read_log(spark, f"{tmp}/log", schema=LOG).collect()]
    assert got == [("b", 11, "2026-05-20")]


def test_register_tables_database_and_csv(spark, tmp):
    p = f"{tmp}/recipe"
    os.makedirs(p)
    with open(f"{p}/r.csv", "w", encoding="utf-8") as f:
        f.write("result_item,material_name,quantity,craft_fee,route,result_quantity\n"
                "R,m1,64,172,a,30\nR,m2,8,172,a,30\n")
    names = register_tables(spark, {"recipe_t": p}, formats={"recipe_t": "csv"},
                            schemas_by_name={"recipe_t": schemas.RECIPE}, database="pl_test_db")
    assert names == ["pl_test_db.recipe_t"]
    r = spark.sql("SELECT sum(quantity) AS q, max(result_quantity) AS o FROM pl_test_db.recipe_t").collect()[0]
    assert (r.q, r.o) == (72, 30)


def test_load_date_today_missing_raises(spark, tmp):
    rows = [("2020-01-01T10:00:00", "c", "a", "g", "10", 0, "")]
    write_landing(spark.createDataFrame(rows, schemas.RAW_AUCTION), f"{tmp}/land")
    with pytest.raises(FileNotFoundError):
        load_date(spark, f"{tmp}/land", f"{tmp}/log", "today")


def test_publish_is_all_or_nothing(spark, tmp, monkeypatch):
    """A crash between staging and commit leaves the old dates; commits of two writers both hold."""
    from pricelens.sources import publish_dates, published, read_published, vacuum
    rows = lambda *r: spark.createDataFrame(list(r), "item string, date string")
    out = f"{tmp}/log"
    left = lambda: sorted((r.item, str(r.date)) for r in read_published(spark, out).collect())
    publish_dates(rows(("a", "2026-05-19"), ("b", "2026-05-20")), out, ["2026-05-19", "2026-05-20"])
    with monkeypatch.context() as m:
        m.setattr(published, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            publish_dates(rows(("x", "2026-05-19")), out, ["2026-05-19", "2026-05-20"])
    assert left() == [("a", "2026-05-19"), ("b", "2026-05-20")]
    # another writer commits while this one has read the last manifest
    found = published.stage(rows(("c", "2026-05-19")), out, "one")
    last, once = published._last, []
    def interrupted(folder, by):
        got = last(folder, by)
        if not once:
            once.append(1)
            publish_dates(rows(("d", "2026-05-21")), out, ["2026-05-21"])
        return got
    with monkeypatch.context() as m:
        m.setattr(published, "_last", interrupted)
        published.commit(spark, out, "one", found, ["2026-05-19", "2026-05-20"])
    assert left() == [("c", "2026-05-19"), ("d", "2026-05-21")]
    assert read_published(spark, out, dates=["2026-05-21"]).count() == 1
    vacuum(spark, out)
    assert left() == [("c", "2026-05-19"), ("d", "2026-05-21")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_plain_log_is_taken_over(spark, tmp):
    from pricelens.sources import publish_dates
    df = spark.createDataFrame([("a", "2026-05-19"), ("b", "2026-05-20")], "item_name string, date string")
    write_parquet(df, f"{tmp}/log", partition_by=["date"])
    publish_dates(df.filter("item_name = 'b'").withColumn("item_name", F.lit("c")), f"{tmp}/log", ["2026-05-20"])
    assert sorted((r.item_name, str(r.date)) for r in read_log(spark, f"{tmp}/log").collect()) == [("a", "2026-05-19"), ("c", "2026-05-20")]


def test_write_runs_bounds_files_in_bytes(spark, tmp):
    """Rows in random order and a hot hour: ceil(bytes / target) files an hour; an odd time is landed, too."""
    from pricelens.sources import write_runs
    rows = [(f"2026-05-19T{10 + (i % 10 == 0):02d}:00:00", "c", f"item {i:04d}", "g", str(i), 0, "") for i in range(2000)]
    df = spark.createDataFrame(rows + [("no time", "c", "odd", "g", "1", 0, "")], schemas.RAW_AUCTION).orderBy(F.rand(3))
    write_runs(df, f"{tmp}/runs", target_bytes=20_000)
    size = df.select(F.col("collected_at"), F.octet_length(F.to_json(F.struct("*"))).alias("b")).groupBy("collected_at").agg(
        (F.sum("b") + F.count("b")).alias("b"))
    for r in size.collect():
        hour = f"hour={r.collected_at[11:13]}" if r.collected_at != "no time" else "hour=__HIVE"
        files = [os.path.join(d, f) for d, _, fs in os.walk(f"{tmp}/runs") for f in fs if f.endswith(".txt") and hour in d]
        assert len(files) == -(-r.b // 20_000)
        assert all(os.path.getsize(f) < 20_000 * 1.35 for f in files)
    assert read_raw(spark, f"{tmp}/runs/*/*/*.txt").count() == 2001


def test_quarantine_names_bad_files(spark, tmp):
    from pricelens.sources import quarantine
    os.makedirs(f"{tmp}/land")
    good = json.dumps({"collected_at": "2026-05-19T10:00:00", "category": "c", "item_name": "a", "price": "1"})
    for name, lines in (("a.json", [good, good]), ("b.json", [good, good[:20], "nonsense"]), ("c.json", ["{"])):
        with open(f"{tmp}/land/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
    rows, counts = quarantine(spark, f"{tmp}/land", f"{tmp}/bad")
    assert rows.count() == 3 and rows.columns == [f.name for f in schemas.RAW_AUCTION.fields]
    assert sorted((r.file.split("/")[-1], r.n_bad, r.n_rows) for r in counts.collect()) == [("b.json", 2, 3), ("c.json", 1, 1)]
    assert sorted(r.corrupt for r in spark.read.parquet(f"{tmp}/bad").collect()) == sorted([good[:20], "nonsense", "{"])
    os.makedirs(f"{tmp}/runs")
    for name, text in (("a.json", f"[{good},\n{good}]"), ("b.json", f"[{good},"), ("c.json", "[]")):
        with open(f"{tmp}/runs/{name}", "w") as f:
            f.write(text)
    rows, counts = quarantine(spark, f"{tmp}/runs", f"{tmp}/bad-runs", multi_line=True)
    assert rows.count() == 2 and [(r.file.split("/")[-1], r.n_bad) for r in counts.collect()] == [("b.json", 1)]


def test_write_counted(spark, tmp):
    from pricelens.sources.tables import write_counted
    df = spark.range(100).selectExpr("id", "id % 3 AS d")
    assert write_counted(df, f"{tmp}/t", ["d"], big=F.count_if(F.col("id") > 90)) == {"n": 100, "big": 9}
    assert write_counted(df.limit(0), f"{tmp}/u") == {"n": 0} and spark.read.parquet(f"{tmp}/t").count() == 100
