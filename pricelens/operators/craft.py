"""Crafting cost against each snapshot, cheapest route, profit.

Recipe: (result_item, material_name, quantity, craft_fee, route,
result_quantity) — one line per ingredient of a route.  Material prices are
listed per bundle of 100, so a line costs price/100 × quantity, a route
costs (Σ line cost + fee) / result_quantity per unit (B09, B10).

Parity with the original job (the default, ``collapse=None``): every price
row of a material at a snapshot meets every recipe line for that material,
so a material listed k times in one snapshot is counted k times (S1, S2),
and a route whose ingredients are missing from a snapshot is still costed
from the ingredients that are present (S3).  ``collapse="min"`` prices a
material at its cheapest listing instead; ``require_complete=True`` drops
routes with a missing ingredient.

Scale: because Σ_rows price·qty = qty·Σ_rows price, the material rows are
first reduced to one row per (snapshot, material) — a partial aggregate that
shuffles almost nothing — and only then joined with the recipe.  The result
is exactly the fan-out join's sum, in integers, without materialising the
fan-out.  The recipe and the chosen costs are joined with ``join_checked``:
broadcast only after their row count is checked, otherwise a shuffle join
that AQE can split on skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions import line_units, unit_cost
from pricelens.operators.joins import join_checked


def material_prices(log: DataFrame, categories: list[str] | None = None,
                    item_col: str = "item_name", price_col: str = "price") -> DataFrame:
    """Material price rows from the log (B05, B08): one row per listing."""
    df = log
    if categories is not None:
        df = df.filter(F.col("category").isin(list(categories)))
    return df.select("collected_at", "day_of_week",
                     F.col(item_col).alias("material_name"),
                     F.col(price_col).alias("material_price"))


def material_snapshot(mats: DataFrame) -> DataFrame:
    """One row per (snapshot, material): Σ price, listing count, min price."""
    return (mats.groupBy("collected_at", "day_of_week", "material_name")
                .agg(F.sum(F.col("material_price").cast("long")).alias("price_sum"),
                     F.count(F.lit(1)).alias("listings"),
                     F.min(F.col("material_price").cast("long")).alias("price_min")))


def cost_lines(recipe: DataFrame, mats: DataFrame, collapse: str | None = None) -> DataFrame:
    """Recipe ⋈ material prices on material_name.

    One row per (recipe line, snapshot) with ``line_units`` = Σ price·qty
    over the material's listings (parity) or min price·qty (collapse="min")
    and ``line_count`` = number of listings that met the line (the fan-out
    row count of the plain join).
    """
    snap = material_snapshot(mats)
    # the recipe is the small side (a dimension scan): broadcast once counted
    j = join_checked(snap, recipe, "material_name", "inner", materialize=False)
    if collapse is None:
        units = line_units("price_sum", "quantity")
        n = F.col("listings")
    elif collapse == "min":
        units = line_units("price_min", "quantity")
        n = F.lit(1).cast("long")
    else:
        raise ValueError(f"collapse must be None or 'min', not {collapse!r}")
    return j.select("result_item", "material_name", "quantity", "craft_fee", "route",
                    "result_quantity", "collected_at", "day_of_week",
                    units.alias("line_units"), n.alias("line_count"))


ROUTE_KEYS = ["result_item", "collected_at", "day_of_week", "craft_fee", "route",
              "result_quantity"]


def route_cost(lines: DataFrame, recipe: DataFrame | None = None,
               require_complete: bool = False) -> DataFrame:
    """Σ line cost per (result, snapshot, route) and unit cost.

    ``route_material_cost`` = Σ line cost; ``route_craft_cost`` =
    (Σ line cost + fee) / result_quantity.  With ``require_complete`` (needs
    ``recipe``) routes missing an ingredient at that snapshot are dropped.
    """
    rc = (lines.groupBy(*ROUTE_KEYS)
               .agg(F.sum("line_units").alias("route_units"),
                    F.count(F.lit(1)).alias("ingredients_present"),
                    F.sum("line_count").alias("joined_lines")))
    if require_complete:
        if recipe is None:
            raise ValueError("require_complete needs the recipe")
        # Needed and present lines are counted on the same keys; a NULL fee or
        # quantity is a key of its own, as structs compare NULL fields equal.
        key = F.struct("result_item", "route", "craft_fee", "result_quantity").alias("route_key")
        need = recipe.select(key).groupBy("route_key").agg(F.count(F.lit(1)).alias("ingredients_needed"))
        rc = (join_checked(rc.select("*", key), need, ["route_key"], "inner", materialize=False)
                .filter(F.col("ingredients_present") == F.col("ingredients_needed"))
                .drop("ingredients_needed", "route_key"))
    return rc.select(*ROUTE_KEYS,
                     (F.col("route_units") / 100).alias("route_material_cost"),
                     unit_cost("route_units", "craft_fee", "result_quantity")
                     .alias("route_craft_cost"),
                     "joined_lines")


def with_min_cost(rc: DataFrame) -> DataFrame:
    """min(unit cost) over (result, snapshot), whole-partition frame.

    A window over the routes of one snapshot — a group is bounded by the
    number of routes of one result."""
    w = Window.partitionBy("result_item", "collected_at")
    return rc.withColumn("min_craft_cost", F.min("route_craft_cost").over(w))


def cheapest_route(rc: DataFrame) -> DataFrame:
    """Exactly one route per (result, snapshot): the cheapest.

    An aggregate of ``min(struct(cost, route))`` — ties go to the smaller
    route name (S5) — so it is a partial/final hash aggregate, not a window
    sort, and no double equality test is needed (S20).  A route without a cost
    is never the cheapest; a group without any costed route gives no row.
    """
    cost = F.col("route_craft_cost")
    best = F.min(F.when(cost.isNotNull(), F.struct(cost, F.col("route")))).alias("best")
    return (rc.groupBy("result_item", "collected_at", "day_of_week").agg(best).filter("best is not null")
              .select("result_item", "collected_at", "day_of_week",
                      F.col("best.route_craft_cost").alias("craft_cost"),
                      F.col("best.route").alias("route")))


def market_prices(log: DataFrame, category: str | None = None,
                  items: list[str] | None = None, item_col: str = "item_name",
                  price_col: str = "price") -> DataFrame:
    """Market rows of the crafted products."""
    df = log
    if category is not None:
        df = df.filter(F.col("category") == category)
    if items is not None:
        df = df.filter(F.col(item_col).isin(list(items)))
    return df.select("collected_at", F.col(item_col).alias("result_item"),
                     F.col(price_col).alias("market_price"), "day_of_week")


def profit_rows(market: DataFrame, cost: DataFrame) -> DataFrame:
    """Market ⋈ chosen cost on (result_item, collected_at).

    Exact snapshot alignment (not as-of).  ``profit`` = market − cost,
    ``is_profitable`` = profit > 0 (strict).
    """
    c = cost.select("result_item", "collected_at", "craft_cost", "route")
    return (join_checked(market, c, ["result_item", "collected_at"], "inner")
                  .withColumn("profit", F.col("market_price") - F.col("craft_cost"))
                  .withColumn("is_profitable", F.col("profit") > 0))


def craft_chain(log_or_mats: DataFrame, recipe: DataFrame, market: DataFrame,
                collapse: str | None = None, require_complete: bool = False):
    """Convenience: material rows → route cost → cheapest → profit rows."""
    lines = cost_lines(recipe, log_or_mats, collapse=collapse)
    rc = route_cost(lines, recipe, require_complete=require_complete)
    best = cheapest_route(rc)
    return rc, best, profit_rows(market, best)
