"""DuckDB SQL equivalents of ``driver.QUERIES`` (the correctness oracle).

Each statement runs on the driver's tables registered as views and returns
the same columns, names and types as the Spark query.  Weekday in DuckDB is
``dayofweek(x) + 1`` (Spark counts Sunday as 1); DuckDB rounds when casting
a double to an integer, so truncation is written ``trunc``; DuckDB's
``round`` keeps a negative zero where Spark returns 0.0, so rounded values
that can be tiny negatives get ``+ 0.0``.
"""

from __future__ import annotations

from pricelens.functions import formats as fmt
from pricelens.plans import driver as d
from pricelens.plans.jobs import day_label_sql


def _lst(vals) -> str:
    return ", ".join("'" + v + "'" for v in vals)


DOW = "CAST(dayofweek({c}) + 1 AS INTEGER)"
LABEL = day_label_sql("{c}")
CENTS = "CAST(round({c} * 100) AS BIGINT)"

LP = f"""lp AS (
  SELECT l_shipdate AS collected_at, p_type AS category, p_brand AS item_name,
         {CENTS.format(c='l_extendedprice')} AS price, {DOW.format(c='l_shipdate')} AS day_of_week
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

PP = f"""pp AS (
  SELECT l_partkey AS item_name, l_shipdate AS collected_at,
         {CENTS.format(c='l_extendedprice')} AS price, {DOW.format(c='l_shipdate')} AS day_of_week
  FROM lineitem)"""

CP = f"""pp AS (
  SELECT o_custkey AS item_name, o_orderdate AS collected_at,
         {CENTS.format(c='o_totalprice')} AS price, {DOW.format(c='o_orderdate')} AS day_of_week
  FROM orders)"""

EV = f"""ev AS (
  SELECT ts AS collected_at, event_type AS category, user_id AS item_name,
         {CENTS.format(c='value')} AS price, {DOW.format(c='ts')} AS day_of_week,
         CAST(hour(ts) AS INTEGER) AS hour_of_day
  FROM events)"""

# events as raw rows, cleaned (what clean(events_raw) must return)
CLEAN_EV = f"""
SELECT CASE WHEN event_type = 'signup' THEN NULL ELSE date_trunc('second', ts) END AS collected_at,
       event_type AS category,
       'user-' || CAST(user_id AS VARCHAR) AS item_name,
       '' AS grade,
       CAST(trunc(value - 5) AS BIGINT) AS price,
       CAST(0 AS BIGINT) AS quantity,
       '' AS end_date,
       CASE WHEN event_type = 'signup' THEN NULL ELSE {DOW.format(c='ts')} END AS day_of_week,
       CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(hour(ts) AS INTEGER) END AS hour_of_day
FROM events
WHERE event_type <> 'error' AND value - 5 > 0"""

CLEAN_EV_DATED = f"""
SELECT *, strftime(collected_at, '%Y-%m-%d') AS date FROM ({CLEAN_EV})"""

RAW_EV_LANDED = """
SELECT CASE WHEN event_type = 'signup' THEN 'not a time'
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS collected_at,
       event_type AS category,
       CASE WHEN event_type = 'error' THEN NULL ELSE 'user-' || CAST(user_id AS VARCHAR) END AS item_name,
       '' AS grade,
       value - 5 AS price,
       CAST(0 AS BIGINT) AS quantity,
       '' AS end_date,
       CASE WHEN event_type = 'signup' THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS date,
       CASE WHEN event_type = 'signup' THEN NULL ELSE strftime(ts, '%H') END AS hour
FROM events"""

TREND = f"""
SELECT category, item_name, day_of_week, {LABEL.format(c='day_of_week')} AS day_label,
       round(avg(price), 0) AS avg_price, min(price) AS min_price, max(price) AS max_price,
       count(*) AS record_count
FROM {{src}} WHERE category IN ({{cats}})
GROUP BY category, item_name, day_of_week"""

TREND_RAW = f"""tr AS (
  SELECT category, item_name, day_of_week, avg(price) AS avg_raw
  FROM lp WHERE category IN ({_lst(d.TREND_TYPES)})
  GROUP BY category, item_name, day_of_week)"""

# recipe from part, monthly snapshots of lineitem
CRAFT = f"""recipe AS (
  SELECT p_brand AS result_item, p_partkey AS material_name, p_size AS quantity,
         CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) * {d.FEE_PER_BRAND_NO} AS craft_fee,
         p_type || ' ' || CAST((p_size - 1) // {d.SIZE_BAND} AS VARCHAR) AS route, {d.RESULT_QUANTITY} AS result_quantity
  FROM part),
mat AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS collected_at,
         l_partkey AS material_name, {CENTS.format(c='l_extendedprice')} AS material_price
  FROM lineitem),
rc0 AS (
  SELECT r.result_item, m.collected_at, r.craft_fee, r.route, r.result_quantity,
         CAST(sum(m.material_price * r.quantity) AS BIGINT) AS units, count(*) AS joined_lines
  FROM recipe r JOIN mat m ON r.material_name = m.material_name
  GROUP BY r.result_item, m.collected_at, r.craft_fee, r.route, r.result_quantity),
rc AS (
  SELECT result_item, collected_at, {DOW.format(c='collected_at')} AS day_of_week,
         CAST(craft_fee AS INTEGER) AS craft_fee, route, CAST(result_quantity AS INTEGER) AS result_quantity,
         units / 100 AS route_material_cost,
         (units + 100 * craft_fee) / (100 * result_quantity) AS route_craft_cost,
         joined_lines
  FROM rc0),
best AS (
  SELECT result_item, collected_at, day_of_week, route_craft_cost AS craft_cost, route
  FROM rc
  QUALIFY row_number() OVER (PARTITION BY result_item, collected_at
                             ORDER BY route_craft_cost, route) = 1),
market AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS collected_at,
         p_brand AS result_item, CAST(round(l_extendedprice) AS BIGINT) AS market_price,
         {DOW.format(c="date_trunc('month', l_shipdate)")} AS day_of_week
  FROM lineitem JOIN part ON l_partkey = p_partkey),
profit AS (
  SELECT m.result_item, m.collected_at, m.market_price, m.day_of_week, b.craft_cost, b.route,
         m.market_price - b.craft_cost AS profit, (m.market_price - b.craft_cost) > 0 AS is_profitable
  FROM market m JOIN best b ON m.result_item = b.result_item AND m.collected_at = b.collected_at)"""

CRAFT_MIN = CRAFT.replace(
    "CAST(sum(m.material_price * r.quantity) AS BIGINT) AS units, count(*) AS joined_lines\n"
    "  FROM recipe r JOIN mat m ON r.material_name = m.material_name",
    "CAST(sum(m.material_price * r.quantity) AS BIGINT) AS units, count(*) AS joined_lines\n"
    "  FROM recipe r JOIN (SELECT collected_at, material_name, min(material_price) AS material_price\n"
    "                      FROM mat GROUP BY collected_at, material_name) m\n"
    "    ON r.material_name = m.material_name")
assert CRAFT_MIN != CRAFT

COMPLETE = """,
present AS (
  SELECT r.result_item, m.collected_at, r.route, count(DISTINCT r.material_name) AS n_present
  FROM recipe r JOIN mat m ON r.material_name = m.material_name
  GROUP BY r.result_item, m.collected_at, r.route),
needed AS (SELECT result_item, route, count(*) AS n_needed FROM recipe GROUP BY result_item, route),
rc_complete AS (
  SELECT rc.* FROM rc
  JOIN present p ON rc.result_item = p.result_item AND rc.collected_at = p.collected_at
                AND rc.route = p.route
  JOIN needed n ON rc.result_item = n.result_item AND rc.route = n.route
  WHERE p.n_present = n.n_needed)"""

CORR = """
  SELECT {key}, round(r, 4) + 0.0 AS r, n, r AS r_raw,
         CASE WHEN r IS NULL THEN NULL WHEN r > 0 THEN '양(+)' ELSE '음(-)' END AS direction,
         CASE WHEN r IS NULL THEN NULL WHEN abs(r) > 0.3 THEN '강' WHEN abs(r) > 0.1 THEN '중'
              ELSE '약' END AS strength
  FROM (SELECT {key},
               covar_pop(CAST(day_of_week AS DOUBLE), CAST(price AS DOUBLE))
                 / NULLIF(stddev_pop(CAST(day_of_week AS DOUBLE)) * stddev_pop(CAST(price AS DOUBLE)), 0) AS r,
               count(*) AS n
        FROM ev GROUP BY {key}) {having}"""

ITEM_CORR = f"ic AS ({CORR.format(key='item_name', having=f'WHERE n >= {d.MIN_SUPPORT}')})"

FLAGGED = """st AS (
  SELECT item_name, avg(price) AS avg_price, stddev_samp(price) AS std_price, count(*) AS total_count
  FROM pp GROUP BY item_name),
fl AS (
  SELECT pp.*, st.avg_price, st.std_price, st.total_count,
         st.avg_price - 2.0 * st.std_price AS lower_bound,
         pp.price < st.avg_price - 2.0 * st.std_price AS is_anomaly,
         round((1.0 - pp.price / st.avg_price) * 100, 1) + 0.0 AS discount_pct
  FROM pp JOIN st ON pp.item_name = st.item_name),
an AS (SELECT * FROM fl WHERE is_anomaly)"""

OUTLIER_ROWS = """
SELECT item_name, collected_at, price, day_of_week, round(avg_price, 2) AS avg_price,
       round(std_price, 2) AS std_price, total_count, round(lower_bound, 2) AS lower_bound,
       discount_pct
FROM an"""

SUMMARY = """sm AS (
  SELECT item_name, count(*) AS anomaly_count, round(avg(discount_pct), 1) AS avg_discount_pct,
         round(avg(avg_price), 0) AS avg_price, min(price) AS min_anomaly_price
  FROM an GROUP BY item_name)"""

BYDAY = """bd AS (SELECT day_of_week, count(*) AS anomaly_count FROM an GROUP BY day_of_week)"""

CATALOG = """cat AS (
  SELECT c.category, c.item_name, n.item_count
  FROM (SELECT DISTINCT p_type AS category, p_name AS item_name FROM part) c
  JOIN (SELECT p_type AS category, count(DISTINCT p_name) AS item_count FROM part GROUP BY p_type) n
    ON c.category = n.category),
kw AS (SELECT DISTINCT p_type AS category, unnest(string_split(p_name, ' ')) AS keyword FROM part),
mk AS (
  SELECT DISTINCT kw.category, kw.keyword, cat.item_name
  FROM kw JOIN cat ON kw.category = cat.category AND contains(cat.item_name, kw.keyword))"""


SQL = {
    "scan_clean": CLEAN_EV,
    "flatten_response": f"""
SELECT CAST((l_linenumber - 1) // 10 + 1 AS INTEGER) AS page_no, l_orderkey AS item_name,
       coalesce(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, '') AS grade,
       {CENTS.format(c='l_extendedprice')} AS price, CAST(trunc(l_quantity) AS BIGINT) AS quantity,
       coalesce(CASE WHEN l_linestatus <> 'O' THEN strftime(l_shipdate, '%Y-%m-%d') END, '') AS end_date
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderstatus <> 'P'""",
    "defaults": """SELECT * FROM ({flat}) WHERE grade = '' OR end_date = ''""",
    "json_landing": RAW_EV_LANDED,
    "raw_json_scan": f"""SELECT * EXCLUDE (date, hour) FROM ({RAW_EV_LANDED})""",
    "load_date": CLEAN_EV_DATED,
    "parquet_roundtrip": CLEAN_EV_DATED,
    "table_scan": f"WITH {EV}" + TREND.format(src="ev", cats=_lst(d.EVENT_TREND_TYPES)),
    "stream_clean": CLEAN_EV_DATED,
    "stream_arrays": CLEAN_EV_DATED,
    "bad_files": """SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n_bad FROM events
WHERE event_type = 'error' GROUP BY 1""",
    "stamped_run": f"""SELECT '{d.RUN_TIME}' AS collected_at, 'page ' || page_no AS category,
       CAST(item_name AS VARCHAR) AS item_name, grade, CAST(price AS VARCHAR) AS price, quantity, end_date,
       '{d.RUN_TIME[:10]}' AS date, '{d.RUN_TIME[11:13]}' AS hour FROM ({{flat}})""",
    "product_filter": f"""WITH {LP}
SELECT collected_at, item_name AS result_item, price AS market_price, day_of_week, 'products' AS filter FROM lp
WHERE category = '{d.PRODUCT_TYPE}' AND item_name IN ({_lst(d.PRODUCT_BRANDS)})
UNION ALL
SELECT collected_at, item_name AS result_item, price AS market_price, day_of_week, 'category' AS filter FROM lp
WHERE category = '{d.ECONOMY_TYPE}'""",
    "recipe_csv": f"""
SELECT p_brand AS result_item, CAST(p_partkey AS VARCHAR) AS material_name, p_size AS quantity,
       CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) * {d.FEE_PER_BRAND_NO} AS craft_fee,
       p_type || ' ' || CAST((p_size - 1) // {d.SIZE_BAND} AS VARCHAR) AS route, {d.RESULT_QUANTITY} AS result_quantity
FROM part""",
    "log_scan": f"""WITH {EV}
SELECT category, item_name, day_of_week, price FROM ev
WHERE category IN ({_lst(d.EVENT_TREND_TYPES)})""",
    "catalog": f"WITH {CATALOG} SELECT category, item_name, item_count FROM cat",
    "watchlist_match": f"WITH {CATALOG} SELECT category, keyword, item_name FROM mk",
    "first_page": f"""WITH {CATALOG},
li AS (SELECT p_type AS category, p_name AS item_name, {CENTS.format(c='l_extendedprice')} AS price,
              l_orderkey, l_linenumber
       FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT category, keyword, rank, item_name, price, l_orderkey, l_linenumber FROM (
  SELECT mk.category, mk.keyword, li.item_name, li.price, li.l_orderkey, li.l_linenumber,
         CAST(row_number() OVER (PARTITION BY mk.category, mk.keyword
              ORDER BY li.price, li.item_name, li.l_orderkey, li.l_linenumber) AS INTEGER) AS rank
  FROM mk JOIN li ON mk.category = li.category AND mk.item_name = li.item_name)
WHERE rank <= {d.PAGE_SIZE}""",
    "weekday_trend": f"WITH {LP}" + TREND.format(src="lp", cats=_lst(d.TREND_TYPES)),
    "weekday_trend_sql": f"WITH {LP}" + TREND.format(src="lp", cats=_lst(d.TREND_TYPES)),
    "weekday_delta": f"""WITH {LP}, {TREND_RAW}
SELECT category, item_name, day_of_week, round(avg_raw, 0) AS avg_price,
       round((avg_raw - lag(avg_raw) OVER w) / NULLIF(lag(avg_raw) OVER w, 0) * 100, 1) + 0.0 AS delta_pct
FROM tr WINDOW w AS (PARTITION BY category, item_name ORDER BY day_of_week)""",
    "peak_days": f"""WITH {LP}, {TREND_RAW}
SELECT category, item_name,
       first(day_of_week ORDER BY avg_raw DESC, day_of_week) AS peak_day,
       round(max(avg_raw), 0) AS peak_avg,
       first(day_of_week ORDER BY avg_raw, day_of_week) AS low_day,
       round(min(avg_raw), 0) AS low_avg
FROM tr GROUP BY category, item_name""",
    "reset_effect": f"""WITH {LP}
SELECT category, item_name, round(on_raw, 0) AS reset_avg, round(off_raw, 0) AS other_avg,
       round((on_raw - off_raw) / NULLIF(off_raw, 0) * 100, 1) + 0.0 AS reset_delta_pct
FROM (SELECT category, item_name,
             avg(CASE WHEN day_of_week = {d.RESET_DOW} THEN price END) AS on_raw,
             avg(CASE WHEN day_of_week <> {d.RESET_DOW} THEN price END) AS off_raw
      FROM lp WHERE category IN ({_lst(d.TREND_TYPES)}) GROUP BY category, item_name)""",
    "weekday_matrix": f"WITH {LP} SELECT item_name, "
                      + ", ".join(f"round(avg(CASE WHEN day_of_week = {i} THEN price END), 0) AS d{i}"
                                  for i in range(1, 8))
                      + " FROM lp GROUP BY item_name",
    "category_weekday_avg": f"""WITH {EV}
SELECT category, day_of_week, round(avg(price), 1) AS avg_price FROM ev GROUP BY category, day_of_week""",
    "route_cost": f"WITH {CRAFT} SELECT * FROM rc",
    "route_cost_collapsed": f"WITH {CRAFT_MIN} SELECT * FROM rc",
    "cheapest_route_complete": f"""WITH {CRAFT}{COMPLETE}
SELECT result_item, collected_at, day_of_week, route_craft_cost AS craft_cost, route
FROM rc_complete
QUALIFY row_number() OVER (PARTITION BY result_item, collected_at
                           ORDER BY route_craft_cost, route) = 1""",
    "cheapest_route": f"WITH {CRAFT} SELECT * FROM best",
    "route_min_cost": f"""WITH {CRAFT}
SELECT result_item, collected_at, route, route_craft_cost, min_craft_cost FROM (
  SELECT *, min(route_craft_cost) OVER (PARTITION BY result_item, collected_at) AS min_craft_cost
  FROM rc) WHERE route_craft_cost = min_craft_cost""",
    "craft_profit": f"WITH {CRAFT} SELECT * FROM profit",
    "profit_by_weekday": f"""WITH {CRAFT}
SELECT result_item, day_of_week, {LABEL.format(c='day_of_week')} AS day_label,
       round(avg(market_price - craft_cost), 0) + 0.0 AS avg_profit,
       round(avg(craft_cost), 0) AS avg_craft_cost,
       round(avg(market_price), 0) AS avg_market_price,
       round(count_if(market_price > craft_cost) / count(*) * 100, 1) AS profitable_pct,
       route
FROM profit GROUP BY result_item, day_of_week, route""",
    "profit_matrix": f"WITH {CRAFT} SELECT result_item, "
                     + ", ".join(f"round(avg(CASE WHEN day_of_week = {i} THEN profit END), 0) + 0.0 AS d{i}"
                                 for i in range(1, 8))
                     + " FROM profit GROUP BY result_item",
    "category_corr": f"WITH {EV}, cc AS (" + CORR.format(key="category", having="") + ") SELECT * EXCLUDE (r_raw) FROM cc",
    "item_corr": f"WITH {EV}, {ITEM_CORR} SELECT * EXCLUDE (r_raw) FROM ic",
    "incremental_stats": f"""WITH {EV}
SELECT item_name, n, round(avg_price, 6) AS avg_price, round(std_price, 2) AS std_price, round(r, 4) + 0.0 AS r
FROM (SELECT item_name, count(*) AS n, avg(price) AS avg_price, stddev_samp(price) AS std_price,
             covar_pop(CAST(day_of_week AS DOUBLE), CAST(price AS DOUBLE))
               / NULLIF(stddev_pop(CAST(day_of_week AS DOUBLE)) * stddev_pop(CAST(price AS DOUBLE)), 0) AS r
      FROM ev GROUP BY item_name)""",
    "corr_extremes": f"""WITH {EV}, {ITEM_CORR}, b AS (SELECT * FROM ic WHERE r IS NOT NULL)
SELECT 'strong' AS list, CAST(row_number() OVER (ORDER BY abs(r_raw) DESC, item_name) AS INTEGER) AS pos,
       item_name, r, n, direction
FROM (SELECT * FROM b ORDER BY abs(r_raw) DESC, item_name LIMIT {d.EXTREMES_K})
UNION ALL
SELECT 'weak' AS list, CAST(row_number() OVER (ORDER BY abs(r_raw) DESC, item_name) AS INTEGER) AS pos,
       item_name, r, n, direction
FROM (SELECT * FROM b ORDER BY abs(r_raw), item_name DESC LIMIT {d.EXTREMES_K})""",
    "corr_ranked": f"""WITH {EV}, {ITEM_CORR}
SELECT item_name, r, n, CASE WHEN r_raw > 0 THEN 'positive' ELSE 'negative' END AS sign,
       abs(r_raw) > 0.3 AS is_strong
FROM ic WHERE r IS NOT NULL""",
    "distinct_items": f"WITH {EV} SELECT DISTINCT item_name FROM ev",
    "low_outliers": f"WITH {PP}, {FLAGGED}" + OUTLIER_ROWS,
    "low_outliers_orders": f"WITH {CP}, {FLAGGED}" + OUTLIER_ROWS,
    "outlier_summary": f"WITH {PP}, {FLAGGED}, {SUMMARY} SELECT * FROM sm",
    "outlier_top20": f"""WITH {PP}, {FLAGGED}, {SUMMARY}
SELECT * FROM sm ORDER BY anomaly_count DESC, item_name LIMIT {d.TOP_N}""",
    "top_discount": f"""WITH {PP}, {FLAGGED}, {SUMMARY}
SELECT * FROM sm ORDER BY avg_discount_pct DESC, item_name LIMIT 1""",
    "outlier_top_flags": f"""WITH {PP}, {FLAGGED}, {SUMMARY}
SELECT *, avg_discount_pct > 30 AS deep_discount
FROM (SELECT * FROM sm ORDER BY anomaly_count DESC, item_name LIMIT {d.FLAG_TOP_N})""",
    "outlier_by_weekday": f"WITH {PP}, {FLAGGED}, {BYDAY} SELECT * FROM bd",
    "weekday_share": f"""WITH {PP}, {FLAGGED}, {BYDAY}
SELECT day_of_week, anomaly_count,
       round(anomaly_count / sum(anomaly_count) OVER () * 100, 1) AS share_pct
FROM bd""",
    "weekday_flags": f"""WITH {PP}, {FLAGGED}, {BYDAY}
SELECT day_of_week, anomaly_count,
       round(anomaly_count / sum(anomaly_count) OVER () * 100, 1) AS share_pct,
       coalesce({LABEL.format(c='day_of_week')}, '?') AS day_label,
       anomaly_count > 200 AS is_busy
FROM bd""",
    "outlier_rate": f"""WITH {PP}, {FLAGGED}
SELECT count(*) AS total_rows, CAST(count_if(is_anomaly) AS BIGINT) AS anomaly_rows,
       round(count_if(is_anomaly) / count(*) * 100, 2) AS anomaly_pct
FROM fl""",
    "corr_report_lines": f"""WITH {EV}, {ITEM_CORR}
SELECT item_name,
       printf('{fmt.CORR_ITEM_LINE}', CAST(item_name AS VARCHAR),
              coalesce(printf('{fmt.R_FORMAT}', r), '{fmt.R_UNDEFINED}'),
              coalesce(direction, '{fmt.R_UNDEFINED}'), n) AS line
FROM ic""",
    "written_report": f"""WITH {PP}, {FLAGGED}, {SUMMARY}, {BYDAY},
top AS (SELECT *, row_number() OVER (ORDER BY anomaly_count DESC, item_name) AS pos FROM sm),
lines AS (
  SELECT 0 AS section, 0 AS pos, '{fmt.ANOMALY_TITLES[0]}' AS line
  UNION ALL SELECT 0, 1, printf('{fmt.ANOMALY_COUNT_LINE}', count(*), CAST(count_if(is_anomaly) AS BIGINT)) FROM fl
  UNION ALL SELECT 1, 0, '{fmt.ANOMALY_TITLES[1]}'
  UNION ALL SELECT 1, pos, printf('  {fmt.ANOMALY_ITEM_LINE}', CAST(item_name AS VARCHAR), anomaly_count,
              CAST(trunc(avg_price) AS BIGINT), avg_discount_pct, min_anomaly_price) FROM top WHERE pos <= 20
  UNION ALL SELECT 2, 0, '{fmt.ANOMALY_TITLES[2]}'
  UNION ALL SELECT 2, day_of_week, printf('{fmt.ANOMALY_WEEKDAY_LINE}', coalesce({LABEL.format(c='day_of_week')}, '?'),
              day_of_week, anomaly_count) FROM bd)
SELECT row_number() OVER (ORDER BY section, pos) AS line_no, line FROM lines""",
    "report_lines": f"""WITH {PP}, {FLAGGED}, {SUMMARY}
SELECT item_name,
       printf('{fmt.ANOMALY_ITEM_LINE}',
              CAST(item_name AS VARCHAR), anomaly_count, CAST(trunc(avg_price) AS BIGINT),
              avg_discount_pct, min_anomaly_price) AS line
FROM sm""",
}

for _name in ("defaults", "stamped_run"):
    SQL[_name] = SQL[_name].format(flat=SQL["flatten_response"])
SQL["profit_by_weekday_sql"] = SQL["profit_by_weekday"]
