"""Removing byte strings that start earlier in the corpus.

Method: distributed prefix doubling, on a sparse set of positions.  In each
round Spark sorts positions by the pair (name of the next h bytes, name of the
h bytes after them); equal pairs share a rank, a unique position is done
with, and the next round looks at longer prefixes of what is left, until the
threshold of 100 bytes.  Names are hashes of the bytes.

Doubling from single bytes would sort every byte of the corpus several times.
Instead windows are ranked by runs.  A window's anchor is the start of its
least-hashed 32 bytes (on a tie the leftmost); it depends on the window's bytes
alone, so equal windows have equal anchors at equal places.  The windows of
one anchor form a run of up to 69 starts.  All windows of a run share their middle,
its core; a run covers a whole, from its first byte to its last.  In each
round Spark ranks runs by the name of the core: a run whose core is unique has
unique windows and leaves.  Among equal cores it ranks by the name of the
whole: every run but the first of its kind starts earlier elsewhere
and is settled as one row.  First runs whose core has other wholes (the edges of
repeats) are parted by distance from the anchor and go on: runs of ``WIDTHS``
windows have cores of 32, 89 and at last 100 bytes, the threshold.  The result is that
of ranking every position.

Documents with equal texts are one: later copies are covered wholly.  Ranks are
aggregates with partial results before the shuffle and are joined back, so one
string in a third of all documents is a skewed join that is split.  Lists are
per document and no longer than it.  Texts travel packed, dealt by doc_id.

Defined results: a null text is empty; texts under 100 bytes lose nothing; a
null doc_id is left out; rows that repeat a doc_id are one document (the greatest
packed text stands); an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import arrow_map, arrow_types, copies, documents, packed, record, release, written
from pricelens.llm.substrings import lists, unpacked
from pricelens.llm.text import Chunk, byte_table, chunks, mix, prefix, signed, span_hash

WINDOW = 100
WIDTHS = (69, 12, 1)
GRAM = WINDOW - WIDTHS[0] + 1
PLACE_BITS = 28
RUNS = "core long, whole long, doc_id long, start int, stop int, anchor int"


def runs(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first start, last start, anchor) of a chunk's runs of windows
    with one anchor, as byte places in the chunk; and the prefix sums used."""
    data, offs = c.data, c.offsets
    sums = prefix(byte_table(3)[data], 3)
    empty = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return empty, empty, empty, empty, sums
    least = anchors(sums, len(data) - WINDOW + 1)
    # least[p]: the anchor of the window at p, for every window inside one document
    doc = np.repeat(np.arange(len(c)), np.diff(offs))[:len(least)]
    start = np.flatnonzero(np.arange(len(least)) + WINDOW <= offs[doc + 1])
    anchor = least[start]
    doc = doc[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return doc[first], start[first], start[last], anchor[first], sums


def anchors(sums: np.ndarray, n: int) -> np.ndarray:
    """The place of the least-hashed gram, the leftmost on a tie, of each of ``n`` windows one after the other.

    Places are counted from the start of a stretch of at most 2**``PLACE_BITS`` grams, so that
    they fit beside the same bits of the hashes in a text of any length.
    """
    wide = WINDOW - GRAM + 1
    low = np.uint64((1 << PLACE_BITS) - 1)
    out = np.empty(n, np.int64)
    step = (1 << PLACE_BITS) - wide + 1
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        at = np.arange(lo, hi + wide - 1)
        least = (span_hash(sums, at, at + GRAM, 3) & ~low) | (at - lo).astype(np.uint64)
        width = 1
        while 2 * width <= wide:
            least = np.minimum(least[:len(least) - width], least[width:])
            width *= 2
        least = np.minimum(least[:len(least) - (wide - width)], least[wide - width:])
        out[lo:hi] = lo + (least & low).astype(np.int64)
    return out


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): the bytes that stay.

    ``spans`` are the maximal removed runs as start, end, start, end ... in bytes.
    """
    docs = documents(docs)
    found = cores(docs)
    # Aggregates are written before they are joined back: with both sides read, a hot string is split.
    twice = written(found.groupBy("core").count().filter("count > 1").select("core"), "repeated-cores")
    left = found.join(twice, "core").groupBy("doc_id").agg(F.collect_set("start").alias("starts"))
    left = written(left, "anchors")
    later = written(copies(docs), "copies")
    texts = packed(docs)
    release(docs)
    rows = written(whole_runs(texts.join(left, "doc_id").join(later, "doc_id", "left_anti")), "runs")
    settled = []
    for width in WIDTHS[1:]:
        done, edges = rerank(rows)
        settled.append(done)
        release(docs)
        rows = written(parted_runs(texts.join(edges, "doc_id"), width), "runs")
    settled.append(rerank(rows, last=True)[0])
    covered = reduce(DataFrame.unionByName, settled).groupBy("doc_id").agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    covered = written(covered, "covered-bytes")
    release(docs)
    out = texts.join(covered, "doc_id", "left").join(later.withColumn("copy", F.lit(True)), "doc_id", "left")
    return _rewrite(out.select("doc_id", "z", "starts", "ends", F.coalesce("copy", F.lit(False)).alias("copy")))


def rerank(rows: DataFrame, last: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """One round over runs: (doc_id, start, end) of the bytes settled as starting
    earlier, and per document the first runs that are not."""
    place = F.struct("doc_id", "start", "stop", "anchor")
    firsts = rows.groupBy("core", "whole").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    firsts = written(firsts if not last else firsts.filter("n > 1"), "first-runs")
    again = firsts.filter("n > 1").select("core", "whole", F.col("first.doc_id").alias("fd"), F.col("first.start").alias("fs"))
    done = rows.join(again, ["core", "whole"]).filter("doc_id != fd or start != fs") \
        .select("doc_id", "start", (F.col("stop") + WINDOW).alias("end"))
    done = written(done, "settled")
    if last:
        return done, None
    mixed = written(firsts.groupBy("core").count().filter("count > 1").select("core"), "mixed-cores")
    edges = firsts.join(mixed, "core").select("first.*").groupBy("doc_id").agg(
        *[F.collect_list(c).alias(c + "s") for c in ("start", "stop", "anchor")])
    return done, written(edges, "edges")


def name(sums: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """The name of some bytes: that of the pair of names of their halves."""
    half = start + (end - start) // 2
    return mix(span_hash(sums, start, half, seed) * np.uint64(0x9E3779B97F4A7C15) + span_hash(sums, half, end, seed))


def cores(docs: DataFrame) -> DataFrame:
    """(core, doc_id, start) of every run: the name of its anchor's 32 bytes, its first start."""
    def rows(batch):
        ids = batch.column(0).to_numpy()
        for c in chunks(batch.column(1)):
            doc, start, _, anchor, sums = runs(c)
            yield {"core": signed(name(sums, anchor, anchor + GRAM, 3)), "doc_id": ids[c.lo + doc],
                   "start": start - c.offsets[doc]}
    return arrow_map(docs, rows, "core long, doc_id long, start int")


def whole_runs(docs: DataFrame) -> DataFrame:
    """The runs of the first width that begin at one of a document's ``starts``."""
    def rows(batch):
        ids = batch.column("doc_id").to_numpy()
        for lo, hi, c in unpacked(batch):
            doc, start, stop, anchor, sums = runs(c)
            want, at = lists(batch.column("starts"), lo, hi)
            keep = np.isin(start, c.offsets[want] + at)
            yield _named(c, sums, ids[lo:hi], doc[keep], start[keep], stop[keep], anchor[keep], anchor[keep],
                         anchor[keep] + GRAM)
    return arrow_map(docs.select("doc_id", "z", "starts"), rows, RUNS)


def parted_runs(docs: DataFrame, width: int) -> DataFrame:
    """A document's runs ``starts`` .. ``stops`` parted to at most ``width`` windows each.

    The parts are cut at multiples of the width from the anchor, and a part's core is
    what all windows at those distances share, whether the run has them all or not.
    """
    def rows(batch):
        ids = batch.column("doc_id").to_numpy()
        for lo, hi, c in unpacked(batch):
            doc, start = lists(batch.column("starts"), lo, hi)
            stop, anchor = (lists(batch.column(x), lo, hi)[1] for x in ("stops", "anchors"))
            start, stop, anchor = (x + c.offsets[doc] for x in (start, stop, anchor))
            least = (anchor - stop) // width
            parts = (anchor - start) // width - least + 1
            run = np.repeat(np.arange(len(doc)), parts)
            part = least[run] + np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
            near = anchor[run] - part * width           # the part's last start, were the run wide enough
            far = near - width + 1
            yield _named(c, prefix(byte_table(3)[c.data], 3), ids[lo:hi], doc[run], np.maximum(start[run], far),
                         np.minimum(stop[run], near), anchor[run], near, far + WINDOW)
    return arrow_map(docs.select("doc_id", "z", "starts", "stops", "anchors"), rows, RUNS)


def _named(c: Chunk, sums: np.ndarray, ids: np.ndarray, doc, start, stop, anchor, core_start, core_end) -> dict:
    other = prefix(byte_table(4)[c.data], 4)
    at = c.offsets[doc]
    return {"core": signed(name(sums, core_start, core_end, 3)), "whole": signed(name(other, start, stop + WINDOW, 4)),
            "doc_id": ids[doc], "start": start - at, "stop": stop - at, "anchor": anchor - at}


def _rewrite(docs: DataFrame) -> DataFrame:
    schema = "doc_id long, n_bytes long, n_removed long, spans array<long>, kept binary"
    types = arrow_types(schema)

    def run(batches):
        for batch in batches:
            copy = batch.column("copy").to_numpy(zero_copy_only=False)
            for lo, hi, c in unpacked(batch):
                size = np.diff(c.offsets)
                doc, a = lists(batch.column("starts"), lo, hi)
                b = lists(batch.column("ends"), lo, hi)[1]
                gone = np.zeros(len(c.data) + 1, np.int32)
                np.add.at(gone, c.offsets[doc] + a, 1)
                np.add.at(gone, c.offsets[doc] + b, -1)
                again = np.flatnonzero(copy[lo:hi] & (size >= WINDOW))
                np.add.at(gone, c.offsets[again], 1)
                np.add.at(gone, c.offsets[again + 1], -1)
                gone = np.cumsum(gone)[:-1] > 0
                out: dict = {k: [] for k in types}
                out["doc_id"] = batch.column("doc_id").slice(lo, hi - lo)
                for s, e in zip(c.offsets[:-1].tolist(), c.offsets[1:].tolist()):
                    g = gone[s:e]
                    out["n_bytes"].append(e - s)
                    if not g.any():
                        out["n_removed"].append(0)
                        out["spans"].append([])
                        out["kept"].append(c.data[s:e].tobytes())
                    else:
                        out["n_removed"].append(int(g.sum()))
                        out["spans"].append(np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8))))
                        out["kept"].append(c.data[s:e][~g].tobytes())
                yield record(out, types)
    return docs.mapInArrow(run, schema)
