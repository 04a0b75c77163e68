"""Composed jobs: the four analyses and the preparation job over auction
data (``jobs``), and the same operators mapped onto the driver's TPC-H-like
tables (``driver``) with their DuckDB oracle SQL (``oracle``)."""
