"""DataFrame → DataFrame operators."""

from pricelens.operators.clean import clean, in_categories, with_calendar
from pricelens.operators.craft import (material_prices, material_snapshot, cost_lines,
                                       route_cost, with_min_cost, cheapest_route,
                                       market_prices, profit_rows, craft_chain)
from pricelens.operators.trend import (weekday_trend, category_weekday_avg, weekday_delta,
                                       peak_days, reset_effect, weekday_matrix)
from pricelens.operators.profit import profit_by_weekday, profit_matrix
from pricelens.operators.correlate import (corr_by, distinct_items, min_support,
                                           corr_extremes, corr_ranked)
from pricelens.operators.anomaly import (item_stats, with_stats, flag_low, anomalies,
                                         low_outliers, anomaly_summary, top_anomalies,
                                         top_discount, anomaly_by_weekday, weekday_share,
                                         run_counts, top_flags, weekday_flags)
from pricelens.operators.ingest import (catalog, watchlist, match_keywords, first_page,
                                        keyword_first_page, page_bounds)
from pricelens.operators.joins import join_checked, join_split
from pricelens.operators.moments import daily_moments, merged_stats, read_moments, refresh_moments

__all__ = [n for n in dir() if not n.startswith("_")]
