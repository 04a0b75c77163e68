"""Recipe CSV, Parquet logs, named tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens import schemas


def read_recipe(spark: SparkSession, path: str,
                schema: T.StructType = schemas.RECIPE) -> DataFrame:
    """Recipe CSV with a header row (A02), explicit six-column schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_log(spark: SparkSession, path: str, categories: list[str] | None = None,
             columns: list[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Parquet price log, filtered by category and projected.

    Both the filter and the projection reach the Parquet scan
    (``PushedFilters: [In(category, …)]`` and a pruned ``ReadSchema``).  Of a
    published log only the live folders are read.
    """
    from pricelens.sources.published import is_published, read_published
    if is_published(spark, path):
        df = read_published(spark, path, schema)
    else:
        df = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    if categories is not None:
        df = df.filter(F.col("category").isin(list(categories)))
    if columns is not None:
        df = df.select(*columns)
    return df


def balanced_for_write(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rebalance rows on the partition columns before a partitioned write.

    Without it every task writes one file per partition value it meets
    (tasks × values small files).  A plain hash repartition on the partition
    columns would put a hot value (a third of the rows in one hour) into
    one task, and a range repartition needs a sampling pass that computes
    the whole input once more.  The ``REBALANCE`` hint hash-partitions on
    the columns and lets AQE split oversized partitions (a hot value spans
    several tasks and files) and merge small ones, from the measured shuffle
    sizes, so files stay near ``advisoryPartitionSizeInBytes``.
    """
    return df.hint("rebalance", *partition_by)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite", balance: bool = True) -> None:
    """Parquet sink (A05); optionally partitioned so later scans prune."""
    if partition_by and balance:
        df = balanced_for_write(df, partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_counted(df: DataFrame, path: str, partition_by: list[str] | None = None, **metrics: Column) -> dict:
    """:func:`write_parquet` that returns the rows it wrote as ``n``, and further aggregates.

    They are observed after the shuffle of the write, in the tasks that write the
    files, so nothing is read a second time and a map task that runs again counts once.
    """
    seen = Observation()
    if partition_by:
        df = balanced_for_write(df, partition_by)
    df = df.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in metrics.items()])
    write_parquet(df, path, partition_by=partition_by, balance=False)
    return seen.get


def register_tables(spark: SparkSession, locations: dict[str, str],
                    formats: dict[str, str] | None = None,
                    options: dict[str, dict] | None = None,
                    schemas_by_name: dict[str, T.StructType] | None = None,
                    database: str | None = None) -> list[str]:
    """Name Parquet/CSV locations as tables so SQL can scan them.

    ``CREATE TABLE IF NOT EXISTS … USING <fmt> LOCATION …`` in the session
    catalog (no metastore service needed), optionally inside ``database``
    (created if absent); an existing table is kept, which mirrors the DDL's
    ``IF NOT EXISTS``.  Returns the qualified table names.
    """
    formats = formats or {}
    options = options or {}
    schemas_by_name = schemas_by_name or {}
    prefix = ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        prefix = f"`{database}`."
    made = []
    for name, loc in locations.items():
        fmt = formats.get(name, "parquet")
        opts = dict(options.get(name, {}))
        if fmt == "csv":
            opts.setdefault("header", "true")
        schema = schemas_by_name.get(name)
        cols = ""
        if schema is not None:
            cols = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                                   for f in schema.fields) + ")"
        opt_sql = ""
        if opts:
            opt_sql = " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in opts.items()) + ")"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}`{name}` {cols} USING {fmt}{opt_sql} "
                  f"LOCATION '{loc}'")
        made.append(f"{database}.{name}" if database else name)
    return made
