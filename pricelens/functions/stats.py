"""Statistics that must not raise under ANSI mode."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_corr(x, y) -> Column:
    """Pearson r as an aggregate; NULL when either side has zero variance.

    ``F.corr`` raises DIVIDE_BY_ZERO on a constant column with ANSI on; the
    population covariance over the product of population deviations is the
    same coefficient and ``try_divide`` turns 0/0 into NULL.  Both inputs are
    cast to double so integer columns are accepted.  A row with a NULL on
    either side counts in neither deviation.
    """
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    y = (F.col(y) if isinstance(y, str) else y).cast("double")
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
