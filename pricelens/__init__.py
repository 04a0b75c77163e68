"""pricelens — PySpark operators for marketplace price snapshots.

A price log is a DataFrame of observations (snapshot time, category, item,
price).  Everything here is a pure ``DataFrame -> DataFrame`` function built
from Spark built-ins, so Catalyst prunes, pushes down and plans the work and
AQE re-plans joins and skew at runtime.
"""

__version__ = "0.1.0"
