"""Price arithmetic.

Prices are whole units of a currency sold in bundles of 100 (a listed price
is for 100 pieces).  Sums are taken in integers and divided once, so a cost is
exact up to one final rounding and does not depend on summation order.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_units(price, quantity) -> Column:
    """price × quantity in hundredths (the line cost is this / 100)."""
    return _c(price).cast("long") * _c(quantity).cast("long")


def unit_cost(units, fee, result_quantity) -> Column:
    """(Σ line cost + fee) / output quantity, with Σ line cost = units / 100.

    Written as (units + 100·fee) / (100·out) so there is one division.
    """
    return F.try_divide(_c(units) + F.lit(100) * _c(fee).cast("long"),
                        (F.lit(100) * _c(result_quantity).cast("long")).cast("double"))


def lower_bound(avg, std, k: float = 2.0) -> Column:
    return _c(avg) - F.lit(float(k)) * _c(std)


def discount_pct(price, avg) -> Column:
    """round((1 − price/avg)·100, 1); NULL when avg is 0."""
    return F.round((F.lit(1.0) - F.try_divide(_c(price), _c(avg))) * 100, 1)


def share_pct(part, whole, scale: int = 1) -> Column:
    """round(part / whole · 100, scale); NULL when whole is 0."""
    return F.round(F.try_divide(_c(part).cast("double"), _c(whole)) * 100, scale)
