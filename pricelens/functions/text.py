"""Text formatting of numbers for reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(c, places: int) -> Column:
    """Fixed-point text with ``places`` decimals (``%.{places}f``)."""
    return F.format_string(f"%.{places}f", F.col(c) if isinstance(c, str) else c)
