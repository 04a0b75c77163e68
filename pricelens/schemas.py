"""Explicit schemas: nothing is inferred at scale (no inference job, no drift)."""

from pyspark.sql import types as T

# Raw landing rows (one JSON array per collection run).  ``price`` is read as
# text: a fractional price must survive until the ``price > 0`` test runs
# before the long cast, and a non-numeric price must null one
# field, not corrupt the whole record.  ``collected_at`` has no zone.
RAW_AUCTION = T.StructType([
    T.StructField("collected_at", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("grade", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("end_date", T.StringType()),
])

# Six-column recipe (the DDL's four columns lack route/result_quantity).
RECIPE = T.StructType([
    T.StructField("result_item", T.StringType()),
    T.StructField("material_name", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("craft_fee", T.IntegerType()),
    T.StructField("route", T.StringType()),
    T.StructField("result_quantity", T.IntegerType()),
])

# Market API response: one page of listings for one search keyword.
API_ITEM = T.StructType([
    T.StructField("Name", T.StringType()),
    T.StructField("Grade", T.StringType()),
    T.StructField("CurrentMinPrice", T.LongType()),
    T.StructField("Quantity", T.LongType()),
    T.StructField("EndDate", T.StringType()),
])
API_RESPONSE = T.StructType([
    T.StructField("TotalCount", T.LongType()),
    T.StructField("Items", T.ArrayType(API_ITEM)),
])

# Cleaned price log.
AUCTION_LOG = T.StructType([
    T.StructField("collected_at", T.TimestampNTZType()),
    T.StructField("category", T.StringType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("grade", T.StringType()),
    T.StructField("price", T.LongType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("end_date", T.StringType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("hour_of_day", T.IntegerType()),
])
