"""Removing word passages that an earlier document has.

Method: difference-cover anchors.  A set D modulo ``PERIOD`` is a difference cover
if any two positions i and j have a shift d < PERIOD that brings both into D.
So if 50-word windows at i and j are equal, both documents have a word position
in D, d words on, at which the next ``ANCHOR`` = 50 - PERIOD + 1 words are equal and
lie inside the window.  Only there are hashes taken (six of 31 positions).
Anchors whose hash occurs once are done with; the others are extended: the
windows that hold them, and only those, are hashed in full (128 bits), and
each keeps the least document it starts in.  A window is covered when that
is smaller than its own document.

Documents with equal texts are one: every later copy is covered wholly, and its
windows are not looked at again.  Hashes are counted with partial sums
before the shuffle and joined back, so a passage in a third of all documents is a
skewed join that is split; no group is gathered.  Lists are per document and
no longer than it.  Texts travel packed, dealt by doc_id.

Defined results: a null text has no words; texts of fewer than 50 words lose
nothing; a null doc_id is left out; rows that repeat a doc_id are one document
(the greatest packed text stands); a passage that repeats only inside one document
stays; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import arrow_map, arrow_types, copies, documents, packed, record, release, written
from pricelens.llm.text import Chunk, Words, chunks, signed, unpack, window_hashes

WINDOW = 50
#: A perfect difference set: every difference modulo 31 occurs once.
COVER = (1, 5, 11, 24, 25, 27)
PERIOD = 31
ANCHOR = WINDOW - PERIOD + 1


def remove_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, text): the words that stay, joined by one space."""
    docs = documents(docs)
    found = anchors(docs)
    twice = written(found.groupBy("h").count().filter("count > 1").select("h"), "repeated-anchors")     # see below
    places = written(found.join(twice, "h").groupBy("doc_id").agg(F.collect_set("place").alias("places")), "anchors")
    later = written(copies(docs), "copies")
    texts = packed(docs)

    own = texts.join(places, "doc_id").join(later, "doc_id", "left_anti")
    starts = windows(own.select("doc_id", "z", "places"))
    least = starts.groupBy("w1", "w2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")) \
        .filter("least < most").select("w1", "w2", "least")
    least = written(least, "first-windows")      # so that both sides of the join are shuffled, and a hot window is split
    release(docs)
    covered = starts.join(least, ["w1", "w2"]).filter("doc_id > least") \
        .groupBy("doc_id").agg(F.collect_set("start").alias("covered"))
    covered = written(covered, "covered-windows")
    out = texts.join(covered, "doc_id", "left").join(later.withColumn("copy", F.lit(True)), "doc_id", "left")
    return _rewrite(out.select("doc_id", "z", "covered", F.coalesce("copy", F.lit(False)).alias("copy")))


def anchors(docs: DataFrame) -> DataFrame:
    """(h, doc_id, place): hashes of the words that follow each cover position."""
    inside = np.zeros(PERIOD, bool)
    inside[list(COVER)] = True

    def rows(batch):
        ids = batch.column(0).to_numpy()
        for c in chunks(batch.column(1)):
            words = Words(c)
            n = words.count[words.doc]
            at = np.flatnonzero(inside[words.place % PERIOD] & (words.place + ANCHOR <= n) & (n >= WINDOW))
            h = window_hashes(words.hashes(c.data, 1), at, ANCHOR, 1)
            yield {"h": signed(h), "doc_id": ids[c.lo + words.doc[at]], "place": words.place[at]}
    return arrow_map(docs, rows, "h long, doc_id long, place int")


def unpacked(batch: pa.RecordBatch, rows: int = 200):
    """(first row, last row, chunk) of a batch's packed texts, a few at a time."""
    for lo in range(0, batch.num_rows, rows):
        z = batch.column("z").slice(lo, rows).to_pylist()
        for c in chunks(pa.array([unpack(x) for x in z], pa.large_binary())):
            yield lo + c.lo, lo + c.hi, c


def lists(col: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(row counted from lo, value) of the lists in rows lo..hi; null lists are empty."""
    part = col.slice(lo, hi - lo)
    sizes = np.array([len(x) if x.is_valid else 0 for x in part], np.int64)
    return np.repeat(np.arange(hi - lo), sizes), part.flatten().to_numpy()


def windows(docs: DataFrame) -> DataFrame:
    """(w1, w2, doc_id, start) of the windows that hold one of a document's ``places``."""
    def rows(batch):
        ids = batch.column("doc_id").to_numpy()
        for lo, hi, c in unpacked(batch):
            words = Words(c)
            doc, place = lists(batch.column("places"), lo, hi)
            wanted = np.zeros(len(words.start) + PERIOD, np.int32)      # +1 where a run of starts begins, -1 after it
            at = words.first[doc] + place
            np.add.at(wanted, np.maximum(words.first[doc], at - PERIOD + 1), 1)
            np.add.at(wanted, at + 1, -1)
            start = np.cumsum(wanted)[:len(words.start)] > 0
            start &= words.place + WINDOW <= words.count[words.doc]
            at = np.flatnonzero(start)
            yield {"w1": signed(window_hashes(words.hashes(c.data, 1), at, WINDOW, 1)),
                   "w2": signed(window_hashes(words.hashes(c.data, 2), at, WINDOW, 2)),
                   "doc_id": ids[lo + words.doc[at]], "start": words.place[at]}
    return arrow_map(docs, rows, "w1 long, w2 long, doc_id long, start int")


def _rewrite(docs: DataFrame) -> DataFrame:
    types = arrow_types("doc_id long, n_words long, n_removed long, text string")

    def run(batches):
        for batch in batches:
            copy = batch.column("copy").to_numpy(zero_copy_only=False)
            for lo, hi, c in unpacked(batch):
                words = Words(c)
                doc, start = lists(batch.column("covered"), lo, hi)
                gone = np.zeros(len(words.start) + 1, np.int32)
                np.add.at(gone, words.first[doc] + start, 1)
                np.add.at(gone, words.first[doc] + start + WINDOW, -1)
                gone = np.cumsum(gone)[:-1] > 0
                gone |= (copy[lo:hi] & (words.count >= WINDOW))[words.doc]
                removed = np.bincount(words.doc, weights=gone, minlength=len(c)).astype(np.int64)
                yield record({"doc_id": batch.column("doc_id").slice(lo, hi - lo), "n_words": words.count,
                              "n_removed": removed, "text": [_join(c, words, i, gone) for i in range(len(c))]}, types)
    return docs.mapInArrow(run, "doc_id long, n_words long, n_removed long, text string")


def _join(c: Chunk, words: Words, i: int, gone: np.ndarray) -> str:
    kept = c.raw(i).split()
    out = gone[words.first[i]:words.first[i + 1]]
    if out.any():
        kept = [w for w, g in zip(kept, out.tolist()) if not g]
    return b" ".join(kept).decode()
