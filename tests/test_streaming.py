"""Incremental landing → log, exactly once per file."""

import json
import os

from pricelens.sources import read_published
from pricelens.streaming import stream_clean


def _write(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        json.dump(rows, f)


def _row(ts, item, price):
    return {"collected_at": ts, "category": "c", "item_name": item, "grade": "", "price": price,
            "quantity": 0, "end_date": ""}


def test_stream_clean_exactly_once(spark, tmp):
    raw, out, ck = f"{tmp}/raw", f"{tmp}/out", f"{tmp}/ck"
    _write(f"{raw}/2026-05-19/15", "a.json", [_row("2026-05-19T15:00:00", "x", 5),
                                              _row("2026-05-19T15:00:00", "y", -1)])
    stream_clean(spark, raw, out, ck)
    assert read_published(spark, out).count() == 1
    stream_clean(spark, raw, out, ck)                     # nothing new → nothing added
    assert read_published(spark, out).count() == 1
    _write(f"{raw}/2026-05-20/09", "b.json", [_row("2026-05-20T09:00:00", "z", 7)])
    stream_clean(spark, raw, out, ck)
    got = sorted((r.item_name, r.price, str(r.date)) for r in read_published(spark, out).collect())
    assert got == [("x", 5, "2026-05-19"), ("z", 7, "2026-05-20")]


def test_stream_clean_over_collector_arrays(spark, tmp):
    from pyspark.sql import functions as F
    from pricelens import schemas
    from pricelens.sources import write_runs
    rows = [("2026-05-19T10:00:00", "c", f"i{i}", "g", str(i), 0, "") for i in range(30)]
    write_runs(spark.createDataFrame(rows, schemas.RAW_AUCTION), f"{tmp}/runs", target_bytes=700)
    stream_clean(spark, f"{tmp}/runs", f"{tmp}/out", f"{tmp}/ck", multi_line=True)
    back = read_published(spark, f"{tmp}/out")
    assert back.count() == 29                                   # price "0" is dropped
    assert back.agg(F.sum("price")).collect()[0][0] == sum(range(30))


def test_replayed_batch_adds_nothing_and_compaction(spark, tmp):
    """A batch that is run again after a crash (before or after its commit) leaves the same rows."""
    from pricelens.sources import compact, published, vacuum
    from pricelens.streaming.ingest import publish_batch
    day = lambda d, items: spark.createDataFrame([(i, d) for i in items], "item string, date string")
    out = f"{tmp}/log"
    publish_batch(day("2026-05-19", "ab"), out, "s-0")
    publish_batch(day("2026-05-19", "ab"), out, "s-0")                       # replay after the commit
    published.stage(day("2026-05-19", "cd"), out, "s-1")                     # crash before the commit
    left = lambda: sorted(r.item for r in read_published(spark, out).collect())
    assert left() == ["a", "b"]
    publish_batch(day("2026-05-19", "cd"), out, "s-1")
    publish_batch(day("2026-05-20", "e"), out, "s-2")
    publish_batch(day("2026-05-20", ""), out, "s-3")                         # an empty batch
    assert left() == list("abcde")
    assert compact(spark, out) == ["2026-05-19"] and left() == list("abcde") and compact(spark, out) == []
    assert all(len(f) == 1 for f in published.live_folders(spark, out).values())
    assert {g.split("/")[0] for g in vacuum(spark, out)} >= {"run=s-0", "run=s-1"} and left() == list("abcde")
    assert sorted(d for d in os.listdir(out) if d.startswith("run=s")) == ["run=s-2"]


def test_stream_arrays_in_many_batches(spark, tmp):
    raw, out, ck = f"{tmp}/raw", f"{tmp}/out", f"{tmp}/ck"
    for k in range(6):
        _write(f"{raw}/2026-05-{19 + k % 2}/15", f"{k}.json", [_row(f"2026-05-{19 + k % 2}T15:00:00", f"i{k}", 5), _row("bad", "x", -5)])
    stream_clean(spark, raw, out, ck, max_files_per_trigger=2)
    assert sorted(r.item_name for r in read_published(spark, out).collect()) == [f"i{k}" for k in range(6)]
