"""Incremental landing → price log.

The original re-read and overwrote all history on every cron run.  Here a
Structured Streaming file source picks up only files it has not seen (the
checkpoint's file log makes each file exactly-once), applies ``clean`` and
publishes each micro-batch as one run of a log partitioned by collection date:
rows are rebalanced on the date, so a batch makes files of bounded bytes, and
committed by manifest under the batch's own name, so a batch that is replayed after
a crash adds nothing.  ``availableNow`` processes everything present and stops, so
the same job serves cron-style runs; a restart after a lost executor or driver
resumes from the checkpoint.  ``sources.compact`` merges the runs of a date later.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricelens import schemas
from pricelens.operators.clean import clean
from pricelens.sources.published import live_folders, publish_dates


def stream_clean(spark: SparkSession, raw_root: str, out: str, checkpoint: str,
                 multi_line: bool = True, available_now: bool = True,
                 max_files_per_trigger: int | None = 10_000, glob: str | None = None,
                 wait: bool = True) -> StreamingQuery:
    """Start (and by default finish) the incremental clean of ``raw_root``.

    ``max_files_per_trigger`` bounds each micro-batch (``availableNow``
    still drains the whole backlog, in bounded batches).  ``raw_root`` holds
    landed JSON (``multi_line`` for one-array-per-file
    runs, False for JSON lines; files starting with ``_`` or ``.`` are
    skipped, ``glob`` narrows further); ``checkpoint`` must be on shared
    storage.
    """
    reader = (spark.readStream.schema(schemas.RAW_AUCTION)
              .option("multiLine", multi_line)
              .option("recursiveFileLookup", True))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    cleaned = clean(reader.json(raw_root)).withColumn(
        "date", F.date_format("collected_at", "yyyy-MM-dd"))
    name = f"stream-{zlib.crc32(checkpoint.encode()):08x}"
    w = (cleaned.writeStream.foreachBatch(lambda rows, batch: publish_batch(rows, out, f"{name}-{batch}"))
         .option("checkpointLocation", checkpoint)
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if wait:
        q.awaitTermination()
    return q


def publish_batch(rows: DataFrame, out: str, run: str) -> None:
    """Adds one micro-batch to a published log, once: a run that is live already is left as it is."""
    live = live_folders(rows.sparkSession, out)
    if not any(f.startswith(f"run={run}/") for fs in live.values() for f in fs):
        publish_dates(rows, out, None, run=run)
