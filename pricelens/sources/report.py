"""UTF-8 text reports written by executors, not the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelens.operators.joins import join_checked


def write_report(sections: list[tuple[str, DataFrame, list]], path: str) -> list[str]:
    """Write report sections as UTF-8 text.

    ``sections`` is a list of ``(title, lines_df, sort_exprs)``; ``lines_df``
    has a string column ``line`` plus the columns the sort expressions use.  Section ``i`` is written to
    ``path/section=i/``: its title line, then its lines sorted by
    ``sort_exprs`` (a range-partitioned sort, so part files are in order and
    no section passes through the driver).  Returns the section folders.
    """
    folders = []
    for i, (title, df, sort_exprs) in enumerate(sections):
        folder = f"{path}/section={i:03d}"
        head = df.sparkSession.range(1).select(F.lit(0).alias("_h"), F.lit(title).alias("line"))
        body = df.withColumn("_h", F.lit(1))
        out = head.unionByName(body, allowMissingColumns=True)
        out.orderBy("_h", *sort_exprs).select("line").write.mode("overwrite").text(folder)
        folders.append(folder)
    return folders


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line): a written report with its global line numbers, from 1.

    Section folders follow their number, part files theirs, pieces of a file their
    offset, and lines of a piece are read in order.  So the lines of every
    piece are counted, a running sum over the pieces (one row for each piece of a
    file that one task reads, not one per line) says where each begins, and a line's number is
    that plus its place in the piece: no sort and no single task over the lines.
    A path without section folders is read as one section; an empty one gives no rows.
    """
    def number(pattern: str):
        return F.coalesce(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).try_cast("long"), F.lit(0))

    lines = spark.read.option("recursiveFileLookup", "true").schema("value string").text(path).select(
        number(r"/section=(\d+)/[^/]*$").alias("section"), number(r"part-(\d+)[^/]*$").alias("part"),
        number(r"-c(\d+)[^/]*$").alias("chunk"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))
    key = ["section", "part", "chunk", "block"]
    pieces = lines.groupBy(*key).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(*key, "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return join_checked(lines, pieces, key).select(
        (F.col("before") + F.col("id") - F.col("first") + 1).alias("line_no"), "line")


def merge_report(spark: SparkSession, path: str, out: str) -> None:
    """Write the sections of a report under ``path`` as one text under ``out``,
    whose part files in the order of their names are the whole report."""
    read_report(spark, path).orderBy("line_no").select("line").write.mode("overwrite").text(out)
