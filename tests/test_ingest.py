"""A12, C04, C05, F05 — checked against brute force on small fixtures."""

from pricelens.operators import catalog, first_page, match_keywords, watchlist
from pricelens.operators.ingest import CATEGORY_CODES, WATCHLIST


def test_catalog(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "z")],
                               "category string, item_name string")
    got = sorted(tuple(r) for r in catalog(df).collect())
    assert got == [("a", "x", 2), ("a", "y", 2), ("b", "z", 1)]


def test_watchlist(spark):
    w = watchlist(spark)
    assert w.count() == sum(len(v) for v in WATCHLIST.values())
    codes = {r.category: r.category_code for r in w.select("category", "category_code").distinct().collect()}
    assert codes == {k: v for k, v in CATEGORY_CODES.items() if k in WATCHLIST}


def test_match_keywords_brute_force(spark):
    names = [("c1", "수줍은 들꽃"), ("c1", "들꽃"), ("c1", "아비도스 들꽃"), ("c1", "earring"),
             ("c2", "ring"), ("c2", "들꽃 씨앗"), ("c1", "")]
    kws = [("c1", "들꽃"), ("c1", "수줍은 들꽃"), ("c1", "ring"), ("c2", "ring"), ("c2", "없는")]
    cat = spark.createDataFrame(names, "category string, item_name string")
    kw = spark.createDataFrame(kws, "category string, keyword string")
    got = sorted(tuple(r) for r in match_keywords(cat, kw).collect())
    exp = sorted({(c, k, n) for c, k in kws for c2, n in names if c == c2 and k in n})
    assert got == exp


def test_first_page_brute_force(spark):
    rows = [("k1", p, f"n{p % 3}", i) for i, p in enumerate([5, 3, 9, 3, 1, 7, 2])] + \
           [("k2", p, "m", i) for i, p in enumerate([4, 4, 4])]
    df = spark.createDataFrame(rows, "keyword string, price long, item_name string, id int")
    got = sorted((r.keyword, r.rank, r.price, r.item_name, r.id)
                 for r in first_page(df, 3, ["keyword"], ["price", "item_name", "id"]).collect())
    exp = []
    for k in ("k1", "k2"):
        ordered = sorted([r for r in rows if r[0] == k], key=lambda r: (r[1], r[2], r[3]))[:3]
        exp += [(k, i + 1, r[1], r[2], r[3]) for i, r in enumerate(ordered)]
    assert got == sorted(exp)


def test_match_keywords_long_keywords_exact(spark):
    names = [("c", "아비도스 두툼한 생고기 특상품"), ("c", "두툼한 생고기"), ("c", "x" * 40),
             ("c", "y" + "x" * 39)]
    kws = [("c", "두툼한 생고기 특상"), ("c", "x" * 30), ("c", "두툼한"), ("c", "y" + "x" * 25)]
    cat = spark.createDataFrame(names, "category string, item_name string")
    kw = spark.createDataFrame(kws, "category string, keyword string")
    got = sorted(tuple(r) for r in match_keywords(cat, kw).collect())
    exp = sorted({(c, k, n) for c, k in kws for c2, n in names if c == c2 and k in n})
    assert got == exp


def test_match_keywords_of_every_length(spark):
    """Empty, one, two, three characters and more; NULLs, repeats, absent grams, code points beyond the BMP."""
    import random
    rnd = random.Random(5)
    letters = "ab가😀 %_"
    names = [(rnd.choice("cd"), "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 9)))) for _ in range(80)] + [("c", None), (None, "ab")]
    kws = [(rnd.choice("cd"), "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 5)))) for _ in range(120)]
    kws += [("c", ""), ("d", ""), ("e", ""), ("c", None), (None, "a"), ("c", "zzz"), ("c", "ab") , ("c", "ab")]
    cat = spark.createDataFrame(names, "category string, item_name string")
    kw = spark.createDataFrame(kws, "category string, keyword string")
    got = sorted(tuple(r) for r in match_keywords(cat, kw).collect())
    exp = sorted({(c, k, n) for c, k in kws for c2, n in names if c and c == c2 and k is not None and n is not None and k in n})
    assert got == exp and any(k == "" for _, k, _ in got)
    assert match_keywords(cat.limit(0), kw).count() == 0 and match_keywords(cat, kw.limit(0)).count() == 0


def test_first_page_bounds_cut_listings_exactly(spark):
    """Same pages with bounds: null prices (first), ties at the bound, keywords of few names, names of no keyword."""
    import random
    from pricelens.operators import keyword_first_page, page_bounds
    rnd = random.Random(11)
    names = [f"n{i}" for i in range(30)]
    listings = [(n, rnd.choice([None, *range(1, 40)]) if n != "n3" else None, i)
                for i, n in enumerate(rnd.choice(names) for _ in range(900))]
    matches = [(k, n) for k, ns in (("many", names[:20]), ("some", names[3:9]), ("few", names[20:22]), ("both", names[18:29]))
               for n in ns]
    ldf = spark.createDataFrame(listings, "item_name string, price long, id int")
    mdf = spark.createDataFrame(matches, "keyword string, item_name string")
    args = [mdf, 5, ["item_name"], ["keyword"]]
    order = ["price", "item_name", "id"]
    cols = ["item_name", "price", "id", "keyword", "rank"]
    plain = sorted(map(str, keyword_first_page(ldf, *args, order).select(cols).collect()))
    assert sorted(map(str, keyword_first_page(ldf, *args, order, "price").select(cols).collect())) == plain
    bound = {r["item_name"]: r["bound"] for r in page_bounds(ldf, *args, "price").collect()}
    assert set(bound) == {n for _, n in matches} and bound["n20"] is None and bound["n21"] is None
    left = [x for x in listings if x[0] in bound and (bound[x[0]] is None or x[1] is None or x[1] <= bound[x[0]])]
    assert len(left) < len(listings) / 2
    none = keyword_first_page(ldf.limit(0), *args, order, "price")
    assert none.count() == 0 and keyword_first_page(ldf, mdf.limit(0), *args[1:], order, "price").count() == 0


def test_keyword_first_page_brute_force(spark):
    import random
    from pricelens.operators import keyword_first_page
    rnd = random.Random(7)
    names = ["a", "b", "c", "d"]
    listings = [(n, rnd.randint(1, 30), i) for i, n in enumerate(rnd.choice(names) for _ in range(120))]
    matches = [("k1", "a"), ("k1", "b"), ("k2", "b"), ("k2", "c"), ("k2", "d"), ("k3", "d")]
    ldf = spark.createDataFrame(listings, "item_name string, price long, id int")
    mdf = spark.createDataFrame(matches, "keyword string, item_name string")
    got = sorted((r.keyword, r.rank, r.item_name, r.price, r.id) for r in
                 keyword_first_page(ldf, mdf, 5, ["item_name"], ["keyword"],
                                    ["price", "item_name", "id"]).collect())
    exp = []
    for k in ("k1", "k2", "k3"):
        ns = {n for kk, n in matches if kk == k}
        rows = sorted([r for r in listings if r[0] in ns], key=lambda r: (r[1], r[0], r[2]))[:5]
        exp += [(k, i + 1, r[0], r[1], r[2]) for i, r in enumerate(rows)]
    assert got == sorted(exp)
