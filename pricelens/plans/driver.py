"""The operators mapped onto the driver's TPC-H-like tables.

Price logs derived from the tables (all whole tables, no sampling):

* ``lineitem_log`` — lineitem ⋈ part: snapshot = ship date, category =
  p_type, item = p_brand, price = extended price in cents.
* ``part_price_log`` — lineitem alone: item = l_partkey (outlier detection).
* ``events_log`` — events: category = event_type, item = user_id, price =
  value in cents, with sub-day timestamps.
* ``events_raw`` — events as raw landing rows (text timestamps and prices,
  some unparseable timestamps, some NULL items, non-positive prices).
* ``part_recipe`` / ``monthly_material_log`` / ``monthly_market_log`` — a
  recipe derived from part (result = brand, route = type and size band,
  ingredient = part, quantity = size; every part) priced against monthly
  snapshots of lineitem.

Every function returns a DataFrame (side tables may have been written for it); ``QUERIES`` maps each registered
query name to ``(spark, sf_dir) -> DataFrame``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.operators import (anomalies, anomaly_by_weekday, anomaly_summary, catalog, category_weekday_avg,
                                 cheapest_route, clean, corr_by, corr_extremes, corr_ranked,
                                 cost_lines, distinct_items, first_page, flag_low,
                                 low_outliers, market_prices, match_keywords, material_prices,
                                 peak_days, profit_by_weekday, profit_matrix, profit_rows,
                                 reset_effect, route_cost, run_counts, top_anomalies,
                                 top_discount, top_flags, weekday_delta, weekday_flags,
                                 weekday_matrix, weekday_share, weekday_trend, with_min_cost,
                                 with_stats, keyword_first_page, read_moments, refresh_moments, merged_stats)
from pricelens.functions import day_label, fixed
from pricelens.functions import formats as fmt
from pricelens.plans import jobs
from pricelens.plans.jobs import CRAFT_PROFIT_SQL, DAILY_TREND_SQL, _sql_list
from pricelens.session import scratch_path
from pricelens.sources import (compact, flatten_response, load_date, merge_report, quarantine, read_landing, read_log,
                               read_published, read_raw, read_recipe, read_report, register_tables, stamp_run,
                               write_landing, write_parquet, write_runs)
from pricelens.streaming import stream_clean
from pricelens import schemas

# Query parameters (the same values appear in the oracle SQL).
TREND_TYPES = ["ECONOMY", "PROMO", "STANDARD"]
EVENT_TREND_TYPES = ["click", "purchase", "view"]
SIZE_BAND = 10
RESULT_QUANTITY = 10
FEE_PER_BRAND_NO = 10
MIN_SUPPORT = 50
EXTREMES_K = 10
OUTLIER_K = 2.0
TOP_N = 20
FLAG_TOP_N = 10
PAGE_SIZE = 10
RESET_DOW = 4
RUN_TIME = "2026-05-19T15:00:00"
PRODUCT_TYPE, ECONOMY_TYPE = "PROMO", "ECONOMY"
PRODUCT_BRANDS = ["Brand#11", "Brand#23", "Brand#45"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("long")


# ---- derived price logs -----------------------------------------------------

def lineitem_log(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    j = li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
    return j.select(F.col("l_shipdate").alias("collected_at"),
                    F.col("p_type").alias("category"),
                    F.col("p_brand").alias("item_name"),
                    cents("l_extendedprice").alias("price"),
                    F.dayofweek("l_shipdate").alias("day_of_week"))


def part_price_log(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("item_name"),
                     F.col("l_shipdate").alias("collected_at"),
                     cents("l_extendedprice").alias("price"),
                     F.dayofweek("l_shipdate").alias("day_of_week"))


def customer_price_log(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("item_name"),
                    F.col("o_orderdate").alias("collected_at"),
                    cents("o_totalprice").alias("price"),
                    F.dayofweek("o_orderdate").alias("day_of_week"))


def events_log(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("ts").alias("collected_at"),
                     F.col("event_type").alias("category"),
                     F.col("user_id").alias("item_name"),
                     cents("value").alias("price"),
                     F.dayofweek("ts").alias("day_of_week"),
                     F.hour("ts").alias("hour_of_day"))


def events_raw(spark, sf_dir) -> DataFrame:
    """Events as raw landing rows: text timestamp (unparseable for signups),
    NULL item for errors, price text = value − 5 (some ≤ 0, some in (0,1))."""
    ev = table(spark, sf_dir, "events")
    ts_text = F.when(F.col("event_type") == "signup", F.lit("not a time")) \
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    item = F.when(F.col("event_type") == "error", F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lit("user-"), F.col("user_id").cast("string")))
    return ev.select(ts_text.alias("collected_at"),
                     F.col("event_type").alias("category"),
                     item.alias("item_name"),
                     F.lit("").alias("grade"),
                     (F.col("value") - 5).cast("string").alias("price"),
                     F.lit(0).cast("long").alias("quantity"),
                     F.lit("").alias("end_date"))


def part_recipe(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    fee = F.regexp_extract("p_brand", r"(\d+)$", 1).try_cast("int") * FEE_PER_BRAND_NO
    return p.select(F.col("p_brand").alias("result_item"),
                    F.col("p_partkey").alias("material_name"),
                    F.col("p_size").alias("quantity"),
                    fee.alias("craft_fee"),
                    F.concat("p_type", F.lit(" "), F.expr(f"(p_size - 1) div {SIZE_BAND}").cast("string")).alias("route"),
                    F.lit(RESULT_QUANTITY).alias("result_quantity"))


def _month(c: str) -> Column:
    return F.trunc(F.col(c), "month").cast("timestamp_ntz")


def monthly_material_log(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    snap = _month("l_shipdate")
    return li.select(snap.alias("collected_at"), F.dayofweek(snap).alias("day_of_week"),
                     F.col("l_partkey").alias("item_name"),
                     cents("l_extendedprice").alias("price"))


def monthly_market_log(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    snap = _month("l_shipdate")
    j = li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
    return j.select(snap.alias("collected_at"), F.dayofweek(snap).alias("day_of_week"),
                    F.col("p_type").alias("category"), F.col("p_brand").alias("item_name"),
                    F.round("l_extendedprice").cast("long").alias("price"))


# ---- craft chain --------------------------------------------------------------

def _route_cost(spark, sf_dir, collapse=None, require_complete=False) -> DataFrame:
    recipe = part_recipe(spark, sf_dir)
    mats = material_prices(monthly_material_log(spark, sf_dir))
    return route_cost(cost_lines(recipe, mats, collapse=collapse), recipe,
                      require_complete=require_complete)


def q_route_cost_collapsed(spark, sf_dir):
    """S1/S2 fix: each material priced at its cheapest listing."""
    return _route_cost(spark, sf_dir, collapse="min")


def q_cheapest_route_complete(spark, sf_dir):
    """S3 fix: only routes with every ingredient priced at the snapshot."""
    return cheapest_route(_route_cost(spark, sf_dir, require_complete=True))


def _craft_profit(spark, sf_dir) -> DataFrame:
    best = cheapest_route(_route_cost(spark, sf_dir))
    return profit_rows(market_prices(monthly_market_log(spark, sf_dir)), best)


def q_route_cost(spark, sf_dir):
    return _route_cost(spark, sf_dir)


def q_cheapest_route(spark, sf_dir):
    return cheapest_route(_route_cost(spark, sf_dir))


def q_route_min_cost(spark, sf_dir):
    """E01 + B15: the window form — routes whose cost equals the minimum."""
    m = with_min_cost(_route_cost(spark, sf_dir))
    return (m.filter(F.col("route_craft_cost") == F.col("min_craft_cost"))
             .select("result_item", "collected_at", "route", "route_craft_cost",
                     "min_craft_cost"))


def q_craft_profit(spark, sf_dir):
    return _craft_profit(spark, sf_dir)


def q_profit_by_weekday(spark, sf_dir):
    return profit_by_weekday(_craft_profit(spark, sf_dir))


def q_profit_matrix(spark, sf_dir):
    return profit_matrix(_craft_profit(spark, sf_dir))


# ---- trends -------------------------------------------------------------------

def q_weekday_trend(spark, sf_dir):
    return weekday_trend(lineitem_log(spark, sf_dir), TREND_TYPES)


def q_weekday_trend_sql(spark, sf_dir):
    name = "auction_log_" + uuid.uuid4().hex[:12]
    lineitem_log(spark, sf_dir).createOrReplaceTempView(name)
    return spark.sql(DAILY_TREND_SQL.format(table=name, categories=_sql_list(TREND_TYPES)))


def _trend_raw(spark, sf_dir):
    return weekday_trend(lineitem_log(spark, sf_dir), TREND_TYPES, keep_unrounded=True)


def q_weekday_delta(spark, sf_dir):
    return weekday_delta(_trend_raw(spark, sf_dir))


def q_peak_days(spark, sf_dir):
    return peak_days(_trend_raw(spark, sf_dir))


def q_reset_effect(spark, sf_dir):
    return reset_effect(lineitem_log(spark, sf_dir), RESET_DOW, TREND_TYPES)


def q_weekday_matrix(spark, sf_dir):
    return weekday_matrix(lineitem_log(spark, sf_dir))


def q_category_weekday_avg(spark, sf_dir):
    return category_weekday_avg(events_log(spark, sf_dir))


# ---- correlation ----------------------------------------------------------------

def q_category_corr(spark, sf_dir):
    return corr_by(events_log(spark, sf_dir), "category").drop("r_raw")


def _item_corr(spark, sf_dir):
    return corr_by(events_log(spark, sf_dir), "item_name", min_n=MIN_SUPPORT)


def q_item_corr(spark, sf_dir):
    return _item_corr(spark, sf_dir).drop("r_raw")


def q_corr_extremes(spark, sf_dir):
    return corr_extremes(_item_corr(spark, sf_dir), EXTREMES_K)


def q_corr_ranked(spark, sf_dir):
    return corr_ranked(_item_corr(spark, sf_dir))


def q_distinct_items(spark, sf_dir):
    return distinct_items(events_log(spark, sf_dir))


# ---- outliers -------------------------------------------------------------------

def _flagged(spark, sf_dir, log_fn=part_price_log):
    return flag_low(with_stats(log_fn(spark, sf_dir)), OUTLIER_K)


def _outlier_rows(log: DataFrame) -> DataFrame:
    a = low_outliers(log, k=OUTLIER_K)
    return a.select("item_name", "collected_at", "price", "day_of_week",
                    F.round("avg_price", 2).alias("avg_price"),
                    F.round("std_price", 2).alias("std_price"), "total_count",
                    F.round("lower_bound", 2).alias("lower_bound"), "discount_pct")


def q_low_outliers(spark, sf_dir):
    return _outlier_rows(part_price_log(spark, sf_dir))


def q_low_outliers_orders(spark, sf_dir):
    return _outlier_rows(customer_price_log(spark, sf_dir))


def _summary(spark, sf_dir):
    return anomaly_summary(low_outliers(part_price_log(spark, sf_dir), k=OUTLIER_K))


def q_outlier_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


def q_outlier_top20(spark, sf_dir):
    return top_anomalies(_summary(spark, sf_dir), TOP_N)


def q_top_discount(spark, sf_dir):
    return top_discount(_summary(spark, sf_dir))


def q_outlier_top_flags(spark, sf_dir):
    return top_flags(_summary(spark, sf_dir), FLAG_TOP_N)


def _by_day(spark, sf_dir):
    return anomaly_by_weekday(low_outliers(part_price_log(spark, sf_dir), k=OUTLIER_K))


def q_outlier_by_weekday(spark, sf_dir):
    return _by_day(spark, sf_dir)


def q_weekday_share(spark, sf_dir):
    return weekday_share(_by_day(spark, sf_dir))


def q_weekday_flags(spark, sf_dir):
    return weekday_flags(_by_day(spark, sf_dir))


def q_outlier_rate(spark, sf_dir):
    return run_counts(_flagged(spark, sf_dir))


def q_corr_report_lines(spark, sf_dir):
    """Q3 item lines: r as 4-place fixed text (H11), ``n/a`` when undefined."""
    c = _item_corr(spark, sf_dir)
    na = F.lit(fmt.R_UNDEFINED)
    r_txt = F.when(F.col("r").isNull(), na).otherwise(fixed("r", 4))
    return c.select("item_name", F.format_string(
        fmt.CORR_ITEM_LINE, F.col("item_name").cast("string"), r_txt,
        F.coalesce(F.col("direction"), na), "n").alias("line"))


def q_report_lines(spark, sf_dir):
    s = _summary(spark, sf_dir)
    return s.select("item_name", F.format_string(
        fmt.ANOMALY_ITEM_LINE,
        F.col("item_name").cast("string"), "anomaly_count", F.col("avg_price").cast("long"),
        "avg_discount_pct", "min_anomaly_price").alias("line"))


def q_written_report(spark, sf_dir):
    """Q4's report (A06): its sections written as text, merged into one text, and that read back by line."""
    flagged = _flagged(spark, sf_dir)
    low = anomalies(flagged)
    parts = {"counts": run_counts(flagged), "top": top_anomalies(anomaly_summary(low), TOP_N),
             "by_weekday": anomaly_by_weekday(low).withColumn("day_label", day_label("day_of_week", "?"))}
    sections, whole = scratch_path(spark, "report_sections"), scratch_path(spark, "report")
    jobs.anomaly_report(spark, parts, sections)
    merge_report(spark, sections, whole)
    return read_report(spark, whole)


# ---- cleaning, sources, sinks, streaming ---------------------------------------

_LOG_WITH_DATE = T.StructType(list(schemas.AUCTION_LOG.fields)
                              + [T.StructField("date", T.StringType())])

def q_scan_clean(spark, sf_dir):
    return clean(events_raw(spark, sf_dir))


def _landed(spark, sf_dir) -> str:
    root = scratch_path(spark, "landing")
    write_landing(events_raw(spark, sf_dir), root)
    return root


def q_raw_json_scan(spark, sf_dir):
    """Events landed as one JSON array per file under date/hour
    folders, scanned back with the multi-line raw reader over the glob."""
    root = scratch_path(spark, "runs")
    write_runs(events_raw(spark, sf_dir), root)
    back = read_raw(spark, f"{root}/*/*/*.txt")
    return back.withColumn("price", F.col("price").try_cast("double"))


def q_json_landing(spark, sf_dir):
    back = read_landing(spark, _landed(spark, sf_dir))
    return back.withColumn("price", F.col("price").try_cast("double"))


def q_load_date(spark, sf_dir):
    """All dates are loaded from a landing whose latest date has wrong
    prices and which has a date of its own; both are landed again, corrected
    (all rows of the date of its own clean away), and loaded as chosen dates."""
    raw = events_raw(spark, sf_dir)
    wrong = raw.filter("item_name is null").withColumn("collected_at", F.lit("1900-01-01T00:00:00"))
    day = F.substring("collected_at", 1, 10)
    latest = raw.filter("collected_at != 'not a time'").agg(F.max(day)).first()[0]
    of_latest = F.coalesce(day == F.lit(latest), F.lit(False))
    root, again = scratch_path(spark, "landing"), scratch_path(spark, "landing-again")
    write_landing(raw.withColumn("price", F.when(of_latest, F.lit("1")).otherwise(F.col("price")))
                  .unionByName(wrong.withColumn("item_name", F.lit("wrong")).withColumn("price", F.lit("1"))), root)
    corrected = raw.filter(of_latest).unionByName(wrong)
    write_landing(corrected, again)
    dates = [r[0] for r in corrected.select(day).distinct().collect()]      # at most two
    out = scratch_path(spark, "log")
    load_date(spark, root, out)
    load_date(spark, again, out, dates)
    load_date(spark, again, out, dates)   # idempotent: the re-run replaces, not appends
    return read_published(spark, out, _LOG_WITH_DATE)


def q_parquet_roundtrip(spark, sf_dir):
    out = scratch_path(spark, "parquet")
    log = clean(events_raw(spark, sf_dir)).withColumn(
        "date", F.date_format("collected_at", "yyyy-MM-dd"))
    write_parquet(log, out, partition_by=["date"])
    full = _LOG_WITH_DATE
    return spark.read.schema(full).parquet(out)


def q_table_scan(spark, sf_dir):
    out = scratch_path(spark, "table")
    write_parquet(events_log(spark, sf_dir), out)
    name = "events_log_" + uuid.uuid4().hex[:12]
    register_tables(spark, {name: out})
    return spark.sql(DAILY_TREND_SQL.format(table=name,
                                            categories=_sql_list(EVENT_TREND_TYPES)))


def q_recipe_csv(spark, sf_dir):
    """The part-derived recipe landed as CSV with a header, read back
    with the explicit six-column recipe schema."""
    out = scratch_path(spark, "recipe-csv")
    part_recipe(spark, sf_dir).write.option("header", True).csv(out)
    return read_recipe(spark, out)


def q_log_scan(spark, sf_dir):
    """A Parquet log scanned with a category filter and a projection,
    both pushed into the scan."""
    out = scratch_path(spark, "log-scan")
    write_parquet(events_log(spark, sf_dir), out)
    return read_log(spark, out, EVENT_TREND_TYPES, ["category", "item_name", "day_of_week", "price"])


def q_stream_clean(spark, sf_dir):
    """The landed events in several micro-batches, each published once, then compacted."""
    root = _landed(spark, sf_dir)
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    stream_clean(spark, root, out, ckpt, multi_line=False, max_files_per_trigger=400)
    compact(spark, out, _LOG_WITH_DATE)
    return read_published(spark, out, _LOG_WITH_DATE)


def q_stream_arrays(spark, sf_dir):
    """I01 over the collector's own files: one JSON array a file."""
    root, out, ckpt = (scratch_path(spark, n) for n in ("runs", "stream-out", "stream-ckpt"))
    write_runs(events_raw(spark, sf_dir), root)
    stream_clean(spark, root, out, ckpt, multi_line=True)
    return read_published(spark, out, _LOG_WITH_DATE)


def q_bad_files(spark, sf_dir):
    """Landed JSON lines of which those of errors are cut off; bad records by landing date."""
    ev = table(spark, sf_dir, "events")
    line = F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("collected_at"),
                              F.col("event_type").alias("category"), F.col("user_id").cast("string").alias("item_name"),
                              F.col("value").cast("string").alias("price")))
    lines = ev.select(F.date_format("ts", "yyyy-MM-dd").alias("date"),
                      F.when(F.col("event_type") == "error", F.substring(line, 1, 30)).otherwise(line).alias("value"))
    root = scratch_path(spark, "landing")
    lines.hint("rebalance", "date").write.partitionBy("date").text(root)
    _, counts = quarantine(spark, root, scratch_path(spark, "quarantine"))
    day = F.regexp_extract("file", "date=([^/]+)/", 1)
    return counts.groupBy(day.alias("date")).agg(F.sum("n_bad").alias("n_bad"))


def q_stamped_run(spark, sf_dir):
    """Flattened listings stamped with one run time, landed with their category and read back."""
    flat = q_flatten_response(spark, sf_dir)
    run = stamp_run(flat.withColumn("category", F.concat(F.lit("page "), F.col("page_no").cast("string"))), RUN_TIME)
    root = scratch_path(spark, "landing")
    write_landing(run.select("collected_at", "category", F.col("item_name").cast("string").alias("item_name"), "grade",
                             F.col("price").cast("string").alias("price"), "quantity", "end_date"), root)
    return read_landing(spark, root)


def q_product_filter(spark, sf_dir):
    """The products' market rows, category equal and item in a list, from a log in a table."""
    out = scratch_path(spark, "log-filter")
    write_parquet(lineitem_log(spark, sf_dir), out)
    log = read_log(spark, out)
    both = market_prices(log, PRODUCT_TYPE, PRODUCT_BRANDS)
    one = market_prices(log, ECONOMY_TYPE)
    return both.withColumn("filter", F.lit("products")).unionByName(one.withColumn("filter", F.lit("category")))


def q_profit_by_weekday_sql(spark, sf_dir):
    """Q2 as SQL over the registered craft_profit table."""
    out = scratch_path(spark, "craft-profit")
    write_parquet(_craft_profit(spark, sf_dir), out)
    name = "craft_profit_" + uuid.uuid4().hex[:12]
    register_tables(spark, {name: out})
    return spark.sql(CRAFT_PROFIT_SQL.format(table=name))


def q_incremental_stats(spark, sf_dir):
    """D05, D09, D10 by refresh: moments of all dates, of which the last two had wrong prices;
    these two are read again and published, and the items' statistics merge all dates."""
    log = events_log(spark, sf_dir).withColumn("date", F.date_format("collected_at", "yyyy-MM-dd"))
    last = [r[0] for r in log.select("date").distinct().orderBy(F.desc("date")).limit(2).collect()]
    path = scratch_path(spark, "moments")
    wrong = F.when(F.col("date").isin(last), F.col("price") * 3 + 1).otherwise(F.col("price"))
    refresh_moments(log.withColumn("price", wrong), path, None)
    refresh_moments(log, path, last)
    s = merged_stats(read_moments(spark, path, log.schema["item_name"].dataType))
    return s.select("item_name", "n", F.round("avg", 6).alias("avg_price"), F.round("std", 2).alias("std_price"),
                    F.round("r", 4).alias("r"))


def q_flatten_response(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    o = table(spark, sf_dir, "orders")
    page = (F.expr("(l_linenumber - 1) div 10") + 1).cast("int")
    item = F.struct(
        F.col("p_name").alias("Name"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("Grade"),
        cents("l_extendedprice").alias("CurrentMinPrice"),
        F.col("l_quantity").cast("long").alias("Quantity"),
        F.when(F.col("l_linestatus") != "O",
               F.date_format("l_shipdate", "yyyy-MM-dd")).alias("EndDate"))
    items = (li.join(p, li["l_partkey"] == p["p_partkey"])
               .select(F.col("l_orderkey").alias("keyword"), page.alias("page_no"),
                       item.alias("item")))
    # One response per (keyword, page): at most PAGE_SIZE listings each, so a
    # hot keyword spreads over its pages.  The order status joins afterwards,
    # as the last step, where AQE can split a hot key without an extra shuffle.
    resp = (items.groupBy("keyword", "page_no")
                 .agg(F.count(F.lit(1)).alias("TotalCount"), F.collect_list("item").alias("Items"))
                 .join(o, F.col("keyword") == o["o_orderkey"])
                 .select("keyword", "page_no", F.to_json(F.struct(
                     "TotalCount",
                     F.when(F.col("o_orderstatus") != "P", F.col("Items")).alias("Items")))
                     .alias("response")))
    return flatten_response(resp, "response", keep=["page_no"], keyword_col="keyword")


def q_defaults(spark, sf_dir):
    """A10: the flattened listings whose Grade or EndDate key was absent and
    took its default."""
    flat = q_flatten_response(spark, sf_dir)
    return flat.filter((F.col("grade") == "") | (F.col("end_date") == ""))


def _catalog(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return catalog(p, "p_type", "p_name")


def _part_keywords(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return (p.select(F.col("p_type").alias("category"),
                     F.explode(F.split("p_name", " ")).alias("keyword")).distinct())


def q_catalog(spark, sf_dir):
    return _catalog(spark, sf_dir)


def q_watchlist_match(spark, sf_dir):
    return match_keywords(_catalog(spark, sf_dir), _part_keywords(spark, sf_dir))


def q_first_page(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    listings = (li.join(p, li["l_partkey"] == p["p_partkey"])
                  .select(F.col("p_type").alias("category"), F.col("p_name").alias("item_name"),
                          cents("l_extendedprice").alias("price"), "l_orderkey", "l_linenumber"))
    m = match_keywords(_catalog(spark, sf_dir), _part_keywords(spark, sf_dir))
    page = keyword_first_page(listings, m, PAGE_SIZE, ["category", "item_name"],
                              ["category", "keyword"],
                              ["price", "item_name", "l_orderkey", "l_linenumber"], "price")
    return page.select("category", "keyword", "rank", "item_name", "price", "l_orderkey",
                       "l_linenumber")


QUERIES = {
    # cleaning and sources
    "scan_clean": q_scan_clean,
    "flatten_response": q_flatten_response,
    "defaults": q_defaults,
    "raw_json_scan": q_raw_json_scan,
    "json_landing": q_json_landing,
    "load_date": q_load_date,
    "parquet_roundtrip": q_parquet_roundtrip,
    "table_scan": q_table_scan,
    "recipe_csv": q_recipe_csv,
    "log_scan": q_log_scan,
    "stream_clean": q_stream_clean,
    "stream_arrays": q_stream_arrays,
    "bad_files": q_bad_files,
    "stamped_run": q_stamped_run,
    "product_filter": q_product_filter,
    "catalog": q_catalog,
    "watchlist_match": q_watchlist_match,
    "first_page": q_first_page,
    # Q1 and trend reports
    "weekday_trend": q_weekday_trend,
    "weekday_trend_sql": q_weekday_trend_sql,
    "weekday_delta": q_weekday_delta,
    "peak_days": q_peak_days,
    "reset_effect": q_reset_effect,
    "weekday_matrix": q_weekday_matrix,
    "category_weekday_avg": q_category_weekday_avg,
    # Q2 craft chain
    "route_cost": q_route_cost,
    "cheapest_route": q_cheapest_route,
    "route_cost_collapsed": q_route_cost_collapsed,
    "cheapest_route_complete": q_cheapest_route_complete,
    "route_min_cost": q_route_min_cost,
    "craft_profit": q_craft_profit,
    "profit_by_weekday": q_profit_by_weekday,
    "profit_by_weekday_sql": q_profit_by_weekday_sql,
    "profit_matrix": q_profit_matrix,
    # Q3 correlation
    "category_corr": q_category_corr,
    "item_corr": q_item_corr,
    "incremental_stats": q_incremental_stats,
    "corr_extremes": q_corr_extremes,
    "corr_ranked": q_corr_ranked,
    "distinct_items": q_distinct_items,
    # Q4 outliers
    "low_outliers": q_low_outliers,
    "low_outliers_orders": q_low_outliers_orders,
    "outlier_summary": q_outlier_summary,
    "outlier_top20": q_outlier_top20,
    "top_discount": q_top_discount,
    "outlier_top_flags": q_outlier_top_flags,
    "outlier_by_weekday": q_outlier_by_weekday,
    "weekday_share": q_weekday_share,
    "weekday_flags": q_weekday_flags,
    "outlier_rate": q_outlier_rate,
    "report_lines": q_report_lines,
    "corr_report_lines": q_corr_report_lines,
    "written_report": q_written_report,
}
