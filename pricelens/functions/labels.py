"""Label columns: weekday names, correlation direction and strength."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the published reports) -----------------------
# Weekday labels for dayofweek 1..7 (Sunday first).
DAY_LABELS = ["일", "월", "화", "수", "목", "금", "토"]
# Correlation direction labels: positive, negative.
POSITIVE, NEGATIVE = "양(+)", "음(-)"
# Correlation strength labels and their |r| thresholds (strictly greater).
STRONG, MEDIUM, WEAK = "강", "중", "약"
STRONG_ABOVE, MEDIUM_ABOVE = 0.3, 0.1
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_label(dow, default: str | None = None) -> Column:
    """1..7 → weekday label; anything else → ``default`` (NULL like a CASE
    without ELSE, or e.g. ``"?"`` like a dict lookup with a default)."""
    d = _c(dow)
    expr = None
    for i, lab in enumerate(DAY_LABELS, start=1):
        expr = F.when(d == i, lab) if expr is None else expr.when(d == i, lab)
    return expr.otherwise(F.lit(default))


def direction(r) -> Column:
    """Positive iff r > 0; zero is negative; NULL r stays NULL."""
    r = _c(r)
    return F.when(r.isNull(), F.lit(None).cast("string")) \
        .when(r > 0, POSITIVE).otherwise(NEGATIVE)


def strength(r) -> Column:
    """|r| > 0.3 strong, > 0.1 medium, else weak; NULL r stays NULL."""
    a = F.abs(_c(r))
    return F.when(a.isNull(), F.lit(None).cast("string")) \
        .when(a > STRONG_ABOVE, STRONG).when(a > MEDIUM_ABOVE, MEDIUM) \
        .otherwise(WEAK)
