"""Column-level helpers (all JVM-side built-ins, codegen friendly)."""

from pricelens.functions.labels import (DAY_LABELS, day_label, direction,
                                        strength, STRONG, MEDIUM, WEAK,
                                        POSITIVE, NEGATIVE)
from pricelens.functions.stats import safe_corr
from pricelens.functions.money import (line_units, unit_cost, discount_pct,
                                       lower_bound, share_pct)
from pricelens.functions.text import fixed

__all__ = ["DAY_LABELS", "day_label", "direction", "strength", "STRONG",
           "MEDIUM", "WEAK", "POSITIVE", "NEGATIVE", "safe_corr",
           "line_units", "unit_cost", "discount_pct", "lower_bound",
           "share_pct", "fixed"]
