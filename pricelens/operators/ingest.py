"""Catalogue, watch-list and keyword search, first result page (A12, C04,
C05, F05) — the collector's row logic as Spark jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelens.operators.joins import join_checked, max_broadcast_bytes, value_bytes
from pricelens.session import scratch_path

# ---- fixed values: market category codes and the watch-list ----------------
CATEGORY_CODES = {
    "식물채집": 90200, "벌목": 90300, "채광": 90400, "수렵": 90500,
    "낚시": 90600, "고고학": 90700, "재련재료": 50010, "재련추가": 50020,
    "유물각인서": 40000, "젬": 230000,
}
WATCHLIST = {
    "식물채집": ["들꽃", "수줍은 들꽃", "아비도스 들꽃", "화사한 들꽃"],
    "벌목": ["목재", "부드러운 목재", "튼튼한 목재", "아비도스 목재"],
    "채광": ["철광석", "묵직한 철광석", "단단한 철광석", "아비도스 철광석"],
    "수렵": ["진귀한 가죽", "두툼한 생고기", "수렵의 결정", "다듬은 생고기",
           "아비도스 두툼한 생고기", "오레하 두툼한 생고기"],
    "낚시": ["낚시의 결정", "생선", "붉은 살 생선", "오레하 태양 잉어", "아비도스 태양 잉어"],
    "고고학": ["진귀한 유물", "고대 유물", "희귀한 유물", "고고학의 결정", "오레하 유물",
            "아비도스 유물"],
    "재련재료": ["수호석 조각", "수호석 결정", "수호강석", "파괴석 조각", "파괴석 결정",
             "정제된 수호강석", "조화의 돌파석", "위대한 명예의 돌파석", "운명의 수호석",
             "운명의 돌파석", "파괴강석", "위대한 운명의 돌파석", "상급 오레하 융화 재료",
             "파괴석", "명예의 돌파석", "경이로운 명예의 돌파석", "생명의 돌파석",
             "운명의 수호석 결정", "오레하 융화 재료", "수호석", "정제된 파괴강석",
             "최상급 오레하 융화 재료", "아비도스 융화 재료", "상급 아비도스 융화 재료",
             "찬란한 명예의 돌파석", "운명의 파괴석", "운명의 파괴석 결정"],
    "재련추가": ["별의 숨결", "태양의 은총", "태양의 축복", "태양의 가호", "달의 숨결",
             "빙하의 숨결", "용암의 숨결"],
    "유물각인서": ["유물 탈출의 명수 각인서", "유물 실드관통 각인서", "유물 굳은 의지 각인서",
              "유물 강화 방패 각인서", "유물 여신의 가호 각인서", "유물 에테르 포식자 각인서",
              "유물 불굴 각인서", "유물 최대 마나 증가 각인서", "유물 번개의 분노 각인서",
              "유물 부러진 뼈 각인서", "유물 약자 무시 각인서", "유물 강령술 각인서",
              "유물 위기 모면 각인서", "유물 시선 집중 각인서", "유물 폭발물 전문가 각인서",
              "유물 달인의 저력 각인서", "유물 분쇄의 주먹 각인서", "유물 추진력 각인서",
              "유물 긴급구조 각인서", "유물 선수필승 각인서", "유물 급소 타격 각인서",
              "유물 승부사 각인서", "유물 정밀 단도 각인서", "유물 정기 흡수 각인서",
              "유물 안정된 상태 각인서", "유물 마나 효율 증가 각인서", "유물 바리케이드 각인서",
              "유물 중갑 착용 각인서", "유물 속전속결 각인서", "유물 구슬동자 각인서",
              "유물 마나의 흐름 각인서", "유물 결투의 대가 각인서", "유물 슈퍼 차지 각인서",
              "유물 전문의 각인서", "유물 타격의 대가 각인서", "유물 각성 각인서",
              "유물 저주받은 인형 각인서", "유물 기습의 대가 각인서", "유물 질량 증가 각인서",
              "유물 아드레날린 각인서", "유물 예리한 둔기 각인서", "유물 원한 각인서",
              "유물 돌격대장 각인서"],
    "젬": ["혼돈의 젬 : 침식", "질서의 젬 : 안정", "혼돈의 젬 : 왜곡", "질서의 젬 : 불변",
          "혼돈의 젬 : 붕괴", "질서의 젬 : 견고"],
}
# Categories whose rows are crafting materials, and the crafted products.
MATERIAL_CATEGORIES = ["식물채집", "벌목", "채광", "수렵", "낚시", "고고학"]
PRODUCT_CATEGORY = "재련재료"
PRODUCTS = ["오레하 융화 재료", "상급 오레하 융화 재료", "최상급 오레하 융화 재료",
            "아비도스 융화 재료", "상급 아비도스 융화 재료"]
TREND_CATEGORIES = ["유물각인서", "재련재료", "재련추가"]
CORR_CATEGORIES = ["재련재료", "재련추가"]
ANOMALY_CATEGORY = "유물각인서"
# ---------------------------------------------------------------------------


def catalog(items: DataFrame, category_col: str = "category",
            name_col: str = "item_name") -> DataFrame:
    """Catalogue listing (A12): one row per distinct (category, name) with the
    number of distinct names in its category.

    The names are kept as rows, not collected into one array per category:
    a category may be arbitrarily large.  The per-category count is a small
    aggregate joined back with a size-checked broadcast."""
    names = items.select(F.col(category_col).alias("category"),
                         F.col(name_col).alias("item_name")).distinct()
    counts = names.groupBy("category").agg(F.count(F.lit(1)).alias("item_count"))
    return join_checked(names, counts, "category", "inner")


def watchlist(spark: SparkSession) -> DataFrame:
    """The watch-list as a DataFrame: (category, category_code, keyword).

    Category name → code is an inner join of two literal tables (a dropped
    category code drops its keywords)."""
    codes = spark.createDataFrame(list(CATEGORY_CODES.items()), "category string, category_code int")
    kws = spark.createDataFrame([(c, k) for c, ks in WATCHLIST.items() for k in ks],
                                "category string, keyword string")
    return kws.join(F.broadcast(codes), "category", "inner")


#: Length of the indexed substrings.
GRAM = 3


def _grams(df: DataFrame, col: str, size: int) -> DataFrame:
    """``df`` with ``gram``: the distinct substrings of ``size`` characters of a column, a row each."""
    n = F.length(F.col(col))
    starts = F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)))
    grams = F.array_distinct(F.transform(starts, lambda s: F.substring(F.col(col), s, F.lit(size))))
    return df.filter(n >= size).withColumn("gram", F.explode(grams))


def match_keywords(catalog_df: DataFrame, watch: DataFrame, category_col: str = "category",
                   name_col: str = "item_name", keyword_col: str = "keyword") -> DataFrame:
    """Keyword search within a category (C05): a keyword selects every
    catalogue name that *contains* it.  Returns distinct (category, keyword, item_name).

    A substring test is a theta join; rather than pairing every name with
    every keyword of its category, names are searched through an inverted
    index of their substrings of ``GRAM`` characters.  Only the grams that occur in
    keywords are indexed and counted; of a keyword's grams the one with the
    fewest names is its key (any name that contains the keyword has them all), so
    common grams are never joined, and the few candidates are verified in full.
    Shorter keywords are grams themselves: those of one or two characters join the
    names' distinct substrings of that length, and the empty one, which every
    name contains, joins on the category alone.  No length is cut off.
    """
    names = catalog_df.select(F.col(category_col).alias("category"),
                              F.col(name_col).alias("item_name")).filter("item_name is not null").distinct()
    kw = watch.select(F.col(category_col).alias("category"),
                      F.col(keyword_col).alias("keyword")).filter("keyword is not null").distinct()
    key = ["category", "gram"]
    wanted = _grams(kw, "keyword", GRAM)
    postings = join_checked(_grams(names, "item_name", GRAM), wanted.select(key).distinct(), key, "left_semi")
    held = postings.groupBy(*key).agg(F.count(F.lit(1)).alias("names"))
    # A gram that no name has is the rarest: its keyword finds nothing.
    rarest = (wanted.join(held, key, "left").groupBy("category", "keyword")
              .agg(F.min(F.struct(F.coalesce("names", F.lit(0)).alias("names"), "gram")).alias("least"))
              .filter("least.names > 0").select("category", "keyword", F.col("least.gram").alias("gram")))
    found = [join_checked(postings, rarest, key).filter(F.contains("item_name", "keyword"))]
    for size in range(1, GRAM):
        short = kw.filter(F.length("keyword") == size).withColumn("gram", F.col("keyword"))
        found.append(join_checked(_grams(names, "item_name", size), short, key))
    found.append(join_checked(names, kw.filter("keyword = ''"), "category"))
    return reduce(DataFrame.unionByName, [f.select("category", "keyword", "item_name") for f in found])


def first_page(listings: DataFrame, page_size: int, key_cols: list[str],
               order_cols: list) -> DataFrame:
    """The first page per search keyword: the ``page_size`` cheapest
    listings, ordered by ``order_cols`` (price first, then tie-breaks) (F05).

    ``row_number() <= page_size`` is planned with a map-side group limit
    (WindowGroupLimit) before the shuffle, so a hot keyword sends at most
    ``page_size`` rows per task to its reducer."""
    w = Window.partitionBy(*key_cols).orderBy(*order_cols)
    return (listings.withColumn("rank", F.row_number().over(w))
                    .filter(F.col("rank") <= page_size))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def page_bounds(listings: DataFrame, matches: DataFrame, page_size: int, name_cols: list[str],
                keyword_cols: list[str], price_col: str) -> DataFrame:
    """(*name_cols, bound): the highest price with which a name's listing can
    reach the first page of any of its keywords; NULL where nothing bounds it.

    Each name offers one listing at its least price, so the ``page_size``-th
    smallest of the least prices of a keyword's names is a price that at least
    ``page_size`` listings don't exceed: a dearer one is on no page of that keyword.  A
    keyword of fewer names bounds nothing, and a name is held to the highest bound
    of its keywords.  The least prices are partial sums in the scan; what is
    joined and ranked has one row per name and per match, not per listing.
    """
    least = listings.groupBy(*name_cols).agg(F.min(price_col).alias("_least"))
    kth = (first_page(join_checked(matches, least, name_cols), page_size, keyword_cols, ["_least", *name_cols])
           .filter(F.col("rank") == page_size).select(*keyword_cols, F.col("_least").alias("_kth")))
    return (join_checked(matches, kth, keyword_cols, "left").groupBy(*name_cols)
            .agg(F.when(F.count(F.lit(1)) == F.count("_kth"), F.max("_kth")).alias("bound")))


def keyword_first_page(listings: DataFrame, matches: DataFrame, page_size: int,
                       name_cols: list[str], keyword_cols: list[str],
                       order_cols: list, price_col: str | None = None) -> DataFrame:
    """First page per search keyword over the listings of every name the
    keyword matches (C05 + F05), without pairing all listings with keywords.

    A keyword's ``page_size`` cheapest listings are each among the
    ``page_size`` cheapest of their own name (otherwise that many listings
    of the same name, all matching the keyword, would rank ahead of them).
    So the listings are first cut to a page per name — a top-k per group
    with a partial limit before its shuffle — and only those rows meet the
    keyword matches and the final per-keyword page.  Exact for a total
    order (``order_cols`` must break all ties).

    With ``price_col`` (the column that ``order_cols`` starts with, rising) listings over their name's
    :func:`page_bounds`, and those of names without a keyword, leave in the scan's own stage, before that shuffle, where
    the bounds are small enough to be broadcast.  That costs another scan of the names and prices, and changes no result.
    """
    if price_col is not None:
        matches = _stored(matches, "matches")
        bounds = _stored(page_bounds(listings, matches, page_size, name_cols, keyword_cols, price_col), "page-bounds")
        if value_bytes(bounds) <= max_broadcast_bytes(listings):
            listings = listings.join(F.broadcast(bounds), name_cols).filter(
                F.col("bound").isNull() | F.col(price_col).isNull() | (F.col(price_col) <= F.col("bound"))).drop("bound")
    per_name = first_page(listings, page_size, name_cols, order_cols).drop("rank")
    j = join_checked(per_name, matches, name_cols, "inner")
    return first_page(j, page_size, keyword_cols, order_cols)
