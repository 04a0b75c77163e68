"""Raw landing data: API responses, JSON files under date/hour folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens import schemas


def read_raw(spark: SparkSession, path, schema: T.StructType = schemas.RAW_AUCTION,
             multi_line: bool = True) -> DataFrame:
    """Scan raw landing JSON.

    Each landed file is one JSON array; every element becomes a row.  The
    schema is explicit, so there is no inference pass over all files, and a
    malformed file yields one all-NULL row that ``clean`` removes (S16).
    ``path`` may be a glob such as ``raw/*/*/*.json`` or a partitioned root.
    """
    return (spark.read.schema(schema)
            .option("multiLine", multi_line)
            .option("mode", "PERMISSIVE")
            .json(path))


# ---- fixed values: defaults for keys absent from one listing --------------
# Grade → "", CurrentMinPrice → 0, Quantity → 0, EndDate → "".
ITEM_DEFAULTS = {"Grade": "", "CurrentMinPrice": 0, "Quantity": 0, "EndDate": ""}
# ---------------------------------------------------------------------------


def flatten_response(df: DataFrame, response_col: str = "response",
                     keep: list[str] | None = None,
                     keyword_col: str = "keyword") -> DataFrame:
    """Turn API responses into one row per listing.

    ``response_col`` is JSON text (parsed with ``from_json``) or an already
    parsed struct.  A NULL or absent ``Items`` array yields zero rows.  The
    stored item name is the *search keyword* (``keyword_col``), not the
    listing's own name (S1).  Absent (or NULL) fields get the defaults above
    (S12: NULL and absent are treated alike) and are renamed to snake_case.
    """
    keep = list(keep or [])
    col = F.col(response_col)
    if isinstance(df.schema[response_col].dataType, T.StringType):
        col = F.from_json(col, schemas.API_RESPONSE)
    items = F.coalesce(col.getField("Items"), F.array().cast(T.ArrayType(schemas.API_ITEM)))
    exploded = df.select(*keep, F.col(keyword_col), F.explode(items).alias("it"))
    it = F.col("it")
    return exploded.select(
        *keep,
        F.col(keyword_col).alias("item_name"),
        F.coalesce(it.Grade, F.lit(ITEM_DEFAULTS["Grade"])).alias("grade"),
        F.coalesce(it.CurrentMinPrice, F.lit(ITEM_DEFAULTS["CurrentMinPrice"]).cast("long")).alias("price"),
        F.coalesce(it.Quantity, F.lit(ITEM_DEFAULTS["Quantity"]).cast("long")).alias("quantity"),
        F.coalesce(it.EndDate, F.lit(ITEM_DEFAULTS["EndDate"])).alias("end_date"),
    )


def stamp_run(df: DataFrame, collected_at: str, col: str = "collected_at") -> DataFrame:
    """Stamp every row of one collection run with one second-precision,
    zone-less timestamp text (A11).  It is a literal: never a per-row clock."""
    return df.withColumn(col, F.lit(collected_at))


def landing_parts(ts: Column) -> tuple[Column, Column]:
    """``YYYY-MM-DD`` and ``HH`` landing folder parts of a timestamp."""
    return F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH")


def write_landing(df: DataFrame, root: str, ts_col: str = "collected_at",
                  max_records_per_file: int = 1_000_000) -> None:
    """Land raw rows as JSON under ``root/date=YYYY-MM-DD/hour=HH/``.

    The folder parts come from the run timestamp (the reference used the
    save-time clock, S14: a run over midnight would land under the earlier
    date here).  ``partitionBy`` makes the folders prunable partitions.
    Files are capped in rows so a hot hour never becomes one huge file.
    """
    from pricelens.sources.tables import balanced_for_write
    ts = F.col(ts_col).try_cast("timestamp_ntz")
    date_part, hour_part = landing_parts(ts)
    landed = df.withColumn("date", date_part).withColumn("hour", hour_part)
    (balanced_for_write(landed, ["date", "hour"])
       .write.mode("append")
       .option("maxRecordsPerFile", max_records_per_file)
       .partitionBy("date", "hour").json(root))


def write_runs(df: DataFrame, root: str, ts_col: str = "collected_at",
               target_bytes: int = 8 * 1024 * 1024) -> None:
    """Land raw rows the way the collector does: each file holds one JSON
    array, under ``root/date=YYYY-MM-DD/hour=HH/`` (A07, read by A01).

    An hour of b bytes becomes ceil(b / ``target_bytes``) files, whatever the
    order of the input.  First the bytes of each hour are counted, then a
    histogram of them over hash buckets (``BUCKETS`` for each file to come);
    running offsets over an hour's buckets tell the file of each bucket.  A
    bucket may run over its file's end, so a file holds about the target and
    one bucket more.  A hot hour is many files and as many tasks' work.
    """
    from pricelens.operators.joins import join_checked
    ts = F.col(ts_col).try_cast("timestamp_ntz")
    date_part, hour_part = landing_parts(ts)
    rows = df.select(date_part.alias("date"), hour_part.alias("hour"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("_row"))
    hour = ["date", "hour"]
    rows = rows.withColumn("_bytes", (F.octet_length("_row") + 1).cast("long"))
    # A row without a time is landed, too: its null folder joins null-safely by a text key.
    rows = rows.withColumn("_hour", F.concat_ws("/", F.coalesce("date", F.lit("-")), F.coalesce("hour", F.lit("-"))))
    files = rows.groupBy("_hour").agg(F.ceil(F.sum("_bytes") / target_bytes).cast("int").alias("_files"), F.sum("_bytes").alias("_all"))
    rows = join_checked(rows, files, "_hour").withColumn(
        "_bucket", F.when(F.col("_files") > 1, F.pmod(F.xxhash64("_row"), F.col("_files") * BUCKETS)).otherwise(F.lit(0)).cast("int"))
    sizes = rows.groupBy("_hour", "_bucket", "_files", "_all").agg(F.sum("_bytes").alias("_size"))
    before = F.sum("_size").over(Window.partitionBy("_hour").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    place = F.coalesce(before, F.lit(0)) * F.col("_files") / F.col("_all")
    place = F.least(F.floor(place), F.col("_files") - 1).cast("int")
    of = sizes.withColumn("_file", place).select("_hour", "_bucket", "_file")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The explicit count keeps AQE from folding the file writes into one task.
    arrays = (join_checked(rows.select(*hour, "_hour", "_bucket", "_row"), of, ["_hour", "_bucket"])
              .repartition(n, *hour, "_file").groupBy(*hour, "_file")
              .agg(F.concat(F.lit("["), F.array_join(F.collect_list("_row"), ","), F.lit("]")).alias("value")))
    (arrays.select(*hour, "value").write.mode("append")
           .option("maxRecordsPerFile", 1).partitionBy(*hour).text(root))


#: Hash buckets for each file of an hour.
BUCKETS = 16


def read_checked(spark: SparkSession, root: str, schema: T.StructType = schemas.RAW_AUCTION,
                 multi_line: bool = False) -> DataFrame:
    """Landed rows with the file they come from and, where they don't parse, their text (S16):
    the schema's columns, ``file`` and ``corrupt``."""
    files = spark.read.option("recursiveFileLookup", True).text(root, wholetext=multi_line) \
        .select("value", F.col("_metadata.file_path").alias("file"))
    if multi_line:      # a file is one array of rows, and bad as a whole
        parsed = files.withColumn("rows", F.from_json("value", T.ArrayType(schema), {"mode": "PERMISSIVE"}))
        bad = F.when(F.col("rows").isNull(), F.col("value"))
        rows = parsed.select("file", bad.alias("corrupt"), F.explode(F.coalesce("rows", F.array(F.lit(None).cast(schema)))).alias("row"))
    else:
        full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
        parsed = files.withColumn("row", F.from_json("value", full, {"columnNameOfCorruptRecord": "_corrupt"}))
        rows = parsed.select("file", F.col("row._corrupt").alias("corrupt"), "row")
    return rows.select(*[F.col(f"row.{f.name}").alias(f.name) for f in schema.fields], "file", "corrupt")


def quarantine(spark: SparkSession, root: str, out: str, schema: T.StructType = schemas.RAW_AUCTION,
               multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, (file, n_bad, n_rows) of the files with bad records); the bad records themselves
    are written to ``out`` with their files (S16)."""
    back = read_checked(spark, root, schema, multi_line)
    bad = back.filter("corrupt is not null")
    bad.select("file", "corrupt").write.mode("append").parquet(out)
    counts = back.groupBy("file").agg(F.count("corrupt").alias("n_bad"), F.count(F.lit(1)).alias("n_rows")).filter("n_bad > 0")
    return back.filter("corrupt is null").drop("file", "corrupt"), counts


LANDING_PARTITIONS = [T.StructField("date", T.StringType()),
                      T.StructField("hour", T.StringType())]


def read_landing(spark: SparkSession, root: str,
                 schema: T.StructType = schemas.RAW_AUCTION,
                 multi_line: bool = False) -> DataFrame:
    """Read a partitioned landing root: JSON lines from ``write_landing``, or
    one array per file from ``write_runs`` (``multi_line=True``).
    ``date``/``hour`` are string partition columns, so a filter on them
    prunes folders before any file is opened."""
    full = T.StructType(list(schema.fields) + LANDING_PARTITIONS)
    return (spark.read.schema(full).option("basePath", root)
            .option("multiLine", multi_line).json(root))


def load_date(spark: SparkSession, landing_root: str, out: str,
              dates: list[str] | str | None = None, clean_fn=None,
              multi_line: bool = False) -> None:
    """Idempotent, date-scoped load of landing rows into a published log.

    Reads only the requested ``date`` partitions (all when ``dates`` is
    None, the current date for ``"today"``), cleans them, and publishes
    exactly those dates of ``out`` in one commit, so re-running a date
    replaces its rows instead of appending duplicates, one whose rows all clean
    away becomes empty, and a crash leaves the dates as they were.  A requested
    date with no landing folder raises, like the shell loader's "directory
    missing" error.
    """
    from pricelens.operators.clean import clean
    from pricelens.sources.published import _Folder, publish_dates
    clean_fn = clean_fn or clean
    if dates == "today":      # the shell loader's default: the run date
        import datetime as _dt
        dates = [_dt.date.today().isoformat()]
    landed = [n[len("date="):] for n in _Folder(spark, landing_root).names(start="date=")]
    wanted = landed if dates is None else list(dates)
    missing = sorted(set(wanted) - set(landed))
    if missing:
        raise FileNotFoundError(f"no landing folder for date(s): {missing}")
    raw = read_landing(spark, landing_root, multi_line=multi_line)
    if dates is not None:
        raw = raw.filter(F.col("date").isin(wanted))
    publish_dates(clean_fn(raw.drop("hour")), out, wanted)
