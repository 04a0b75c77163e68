"""The analyses as Spark jobs over landed auction data.

``prepare`` cleans raw JSON into ``auction_log`` and derives ``craft_profit``
(the preparation job); ``daily_trend`` and ``craft_profit_by_weekday`` are the
two SQL analyses; ``correlation`` and ``anomaly`` the two DataFrame analyses.
Each job writes its outputs and later jobs read them back, so lineage is cut
at the written tables and a lost executor only recomputes from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens import schemas
from pricelens.functions import DAY_LABELS, day_label, share_pct
from pricelens.functions import formats as fmt
from pricelens.operators import (anomaly_by_weekday, anomaly_summary, clean, corr_by,
                                 corr_extremes, category_weekday_avg, cost_lines,
                                 cheapest_route, flag_low, market_prices,
                                 material_prices, profit_rows, route_cost, run_counts,
                                 top_anomalies, with_stats, anomalies)
from pricelens.operators.ingest import (ANOMALY_CATEGORY, CORR_CATEGORIES,
                                        MATERIAL_CATEGORIES, PRODUCT_CATEGORY, PRODUCTS,
                                        TREND_CATEGORIES)
from pricelens.sources import read_log, read_raw, read_recipe, write_parquet, write_report
from pricelens.sources.published import is_published, publish_dates, read_published
from pricelens.sources.tables import write_counted

def day_label_sql(col: str) -> str:
    """SQL CASE mapping 1..7 to the fixed weekday labels (NULL otherwise)."""
    whens = " ".join(f"WHEN {i} THEN '{lab}'" for i, lab in enumerate(DAY_LABELS, start=1))
    return f"CASE {col} {whens} END"


# Q1 as SQL over a registered log table.
DAILY_TREND_SQL = (
    "SELECT category, item_name, day_of_week, "
    + day_label_sql("day_of_week") + " AS day_label, "
    "round(avg(price), 0) AS avg_price, min(price) AS min_price, max(price) AS max_price, "
    "count(1) AS record_count "
    "FROM {table} WHERE category IN ({categories}) "
    "GROUP BY category, item_name, day_of_week "
    "ORDER BY category, item_name, day_of_week")

# Q2 as SQL over a registered craft_profit table (D03, D04, F01); the order
# includes the route so equal (item, weekday) rows come out deterministically.
CRAFT_PROFIT_SQL = (
    "SELECT result_item, day_of_week, "
    + day_label_sql("day_of_week") + " AS day_label, "
    "round(avg(market_price - craft_cost), 0) AS avg_profit, "
    "round(avg(craft_cost), 0) AS avg_craft_cost, "
    "round(avg(market_price), 0) AS avg_market_price, "
    "round(count_if(market_price > craft_cost) / count(1) * 100, 1) AS profitable_pct, "
    "route "
    "FROM {table} GROUP BY result_item, day_of_week, route "
    "ORDER BY result_item, day_of_week, route")


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def prepare(spark: SparkSession, raw_path: str, recipe_path: str, out: str,
            collapse: str | None = None, require_complete: bool = False) -> dict:
    """Raw JSON → ``out/auction_log`` (partitioned by date) and
    ``out/craft_profit``.  Returns the written paths and row counts (D13).

    The cost chain reads the *written* log back, so lineage is cut there; the
    writes count their rows themselves."""
    log = clean(read_raw(spark, raw_path)).withColumn(
        "date", F.date_format("collected_at", "yyyy-MM-dd"))
    log_path, profit_path = f"{out}/auction_log", f"{out}/craft_profit"
    log_rows = write_counted(log, log_path, partition_by=["date"])["n"]
    saved = spark.read.parquet(log_path)
    recipe = read_recipe(spark, recipe_path)
    mats = material_prices(saved, MATERIAL_CATEGORIES)
    lines = cost_lines(recipe, mats, collapse=collapse)
    best = cheapest_route(route_cost(lines, recipe, require_complete=require_complete))
    market = market_prices(saved, PRODUCT_CATEGORY, PRODUCTS)
    # partitioned by collection date, like the log, so prepare_dates can
    # later overwrite single dates in place
    profit = profit_rows(market, best).withColumn("date", F.date_format("collected_at", "yyyy-MM-dd"))
    profit_rows_written = write_counted(profit, profit_path, partition_by=["date"])["n"]
    return {"auction_log": log_path, "craft_profit": profit_path,
            "auction_log_rows": log_rows, "craft_profit_rows": profit_rows_written}


def prepare_dates(spark: SparkSession, log_path: str, recipe_path: str, profit_out: str,
                  dates: list[str], collapse: str | None = None,
                  require_complete: bool = False) -> None:
    """Incremental craft profit: recompute only the given collection dates.

    A snapshot's route costs and profit rows depend only on that snapshot's
    listings, so reading the log's ``date`` partitions for ``dates`` (pruned
    at the file listing) and publishing exactly those dates of
    ``profit_out`` in one commit (those that get no row become empty) gives the same rows as
    a full recomputation, at the cost of the new data only.  Pair it with the
    streaming ingest, which appends new dates to the log.
    """
    # The schema is given, as a log whose dates were all emptied has no file to read it from.
    schema = T.StructType(list(schemas.AUCTION_LOG.fields) + [T.StructField("date", T.StringType())])
    log = read_published(spark, log_path, schema, dates) if is_published(spark, log_path) \
        else spark.read.schema(schema).parquet(log_path).filter(F.col("date").isin(list(dates)))
    recipe = read_recipe(spark, recipe_path)
    lines = cost_lines(recipe, material_prices(log, MATERIAL_CATEGORIES), collapse=collapse)
    best = cheapest_route(route_cost(lines, recipe, require_complete=require_complete))
    profit = profit_rows(market_prices(log, PRODUCT_CATEGORY, PRODUCTS), best) \
        .withColumn("date", F.date_format("collected_at", "yyyy-MM-dd"))
    publish_dates(profit, profit_out, list(dates))


def daily_trend(spark: SparkSession, log_path: str,
                categories: list[str] = TREND_CATEGORIES) -> DataFrame:
    """Q1 through ``spark.sql`` over the log registered as a view."""
    read_log(spark, log_path).createOrReplaceTempView("auction_log")
    return spark.sql(DAILY_TREND_SQL.format(table="auction_log",
                                            categories=_sql_list(categories)))


def craft_profit_by_weekday(spark: SparkSession, profit_path: str) -> DataFrame:
    """Q2 through ``spark.sql`` over the craft_profit table."""
    read_log(spark, profit_path).createOrReplaceTempView("craft_profit")
    return spark.sql(CRAFT_PROFIT_SQL.format(table="craft_profit"))


def correlation(spark: SparkSession, log_path: str,
                categories: list[str] = CORR_CATEGORIES, min_n: int = 50,
                k: int = 10) -> dict[str, DataFrame]:
    """Q3: category r, item r with support ≥ min_n, the k strongest/weakest
    items and category averages by weekday — one aggregate each."""
    df = read_log(spark, log_path, categories,
                  ["category", "item_name", "day_of_week", "price"])
    items = corr_by(df, "item_name", min_n=min_n)
    return {"category_corr": corr_by(df, "category").drop("r_raw"),
            "item_corr": items.drop("r_raw"),
            "extremes": corr_extremes(items, k),
            "category_weekday_avg": category_weekday_avg(df)}


def anomaly(spark: SparkSession, log_path: str, category: str = ANOMALY_CATEGORY,
            k: float = 2.0, top_n: int = 20, out: str | None = None) -> dict[str, DataFrame]:
    """Q4: outliers below avg − k·sd per item, summaries, and (with ``out``)
    the anomaly rows written as Parquet.  That write counts all rows and the
    flagged ones as they pass, and the summaries read what it wrote, so the
    log is scanned and joined once; without ``out`` each result scans it."""
    df = read_log(spark, log_path, [category])
    flagged = flag_low(with_stats(df), k)
    a, counts = anomalies(flagged), None
    if out is not None:
        seen = Observation()
        write_parquet(anomalies(flagged.observe(seen, F.count(F.lit(1)).alias("total_rows"),
                                                F.count_if("is_anomaly").alias("anomaly_rows"))), out)
        got = seen.get
        counts = spark.createDataFrame([(got["total_rows"], got["anomaly_rows"])], "total_rows long, anomaly_rows long") \
            .withColumn("anomaly_pct", share_pct("anomaly_rows", "total_rows", 2))
        a = spark.read.parquet(out)
    summary = anomaly_summary(a)
    return {"counts": run_counts(flagged) if counts is None else counts, "anomalies": a,
            "top": top_anomalies(summary, top_n),
            "by_weekday": anomaly_by_weekday(a).withColumn(
                "day_label", day_label("day_of_week", "?"))}


def anomaly_report(spark: SparkSession, parts: dict[str, DataFrame], path: str) -> list[str]:
    """Q4's text report written by executors."""
    counts = parts["counts"].select(F.format_string(
        fmt.ANOMALY_COUNT_LINE, "total_rows", "anomaly_rows").alias("line"))
    top = parts["top"].select("anomaly_count", "item_name", F.format_string(
        "  " + fmt.ANOMALY_ITEM_LINE,
        "item_name", "anomaly_count", F.col("avg_price").cast("long"),
        "avg_discount_pct", "min_anomaly_price").alias("line"))
    by_day = parts["by_weekday"].select("day_of_week", F.format_string(
        fmt.ANOMALY_WEEKDAY_LINE, "day_label", "day_of_week", "anomaly_count").alias("line"))
    return write_report([
        (fmt.ANOMALY_TITLES[0], counts, []),
        (fmt.ANOMALY_TITLES[1], top, [F.desc("anomaly_count"), "item_name"]),
        (fmt.ANOMALY_TITLES[2], by_day, ["day_of_week"]),
    ], path)


def _r_text(col: str = "r") -> "F.Column":
    return F.when(F.col(col).isNull(), F.lit(fmt.R_UNDEFINED)).otherwise(
        F.format_string(fmt.R_FORMAT, col))


def correlation_report(spark: SparkSession, parts: dict[str, DataFrame], path: str) -> list[str]:
    """Q3's text report written by executors (A06, H11): category r with
    direction and strength, the strongest and weakest items, and category
    averages by weekday."""
    na = F.lit(fmt.R_UNDEFINED)
    cat = parts["category_corr"].select("category", F.format_string(
        fmt.CORR_CATEGORY_LINE, "category", _r_text(),
        F.coalesce("direction", na), F.coalesce("strength", na)).alias("line"))
    ext = parts["extremes"]
    line = F.format_string(fmt.CORR_ITEM_LINE, F.col("item_name").cast("string"), _r_text(),
                           F.coalesce("direction", na), "n").alias("line")
    strong = ext.filter(F.col("list") == "strong").select("pos", line)
    weak = ext.filter(F.col("list") == "weak").select("pos", line)
    avg = parts["category_weekday_avg"].select("category", "day_of_week", F.format_string(
        fmt.CATEGORY_AVG_LINE, "category", "day_of_week", "avg_price").alias("line"))
    return write_report([
        (fmt.CORR_TITLES[0], cat, ["category"]),
        (fmt.CORR_TITLES[1], strong, ["pos"]),
        (fmt.CORR_TITLES[2], weak, ["pos"]),
        (fmt.CORR_TITLES[3], avg, ["category", "day_of_week"]),
    ], path)
