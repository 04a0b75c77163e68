"""Dropping lines that many documents share.

Method: a sharded minimal perfect hash over all distinct line hashes.  The keys of
all lines are dealt to shards by one half of their 128-bit hash; each shard is one row
holding a minimal perfect hash over the other halves and, in the order of that hash,
a fingerprint array (the first half), a count array (the documents holding the line) and the
array of the documents that keep it.  Documents probe those arrays with the hashes of
their lines, and the probe reads the count: the shard's arrays and the probes meet in
one task, no line text and no line table is joined.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z
lower-cased.  Scale: the distinct (line, document) pairs are counted by a
two-step aggregate (first per line and document, so a line found in a third
of all documents is pre-aggregated in many tasks); a shard holds about
``SHARD_KEYS`` keys however many there are, and the sum of its counts is the number of
probes it will get: it is given out once for every ``SHARD_PROBES`` of them and a probe
goes to the copy its document falls to, so a hot line's probes are split as often as its count asks for.
Text moves once, dealt by doc_id.

Defined results: a null or empty text is one empty line; a null doc_id is left
out; rows that repeat a doc_id are one document when lines are counted and are each
rewritten; ties (a document holding a key twice) count once, and the keeper keeps all its copies; an empty table gives
no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import (arrow_map, arrow_types, broadcast_bytes, discard, documents, mapped, record,
                                   written)
from pricelens.llm.text import mix

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_KEYS = 20_000
SHARD_PROBES = 2 * SHARD_KEYS
GAMMA = 1.5
STRIP = b" \t\n\x0b\x0c\r"
INDEX = "shard int, probes long, words binary, sizes binary, ranks binary, fingerprints binary, counts binary, keepers binary"


def line_keys(text: str | None, min_chars: int) -> list[tuple[int, int, int]]:
    """(line number, two 64-bit hashes of the key) of the lines long enough."""
    out = []
    for k, line in enumerate((text or "").encode().split(b"\n")):
        if len(line) >= min_chars:
            key = line.strip(STRIP).lower()
            if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
                h = xxhash.xxh3_128_intdigest(key)
                out.append((k, h >> 64, h & 0xFFFFFFFFFFFFFFFF))
    return out


def drop_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                      carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, *carry): the text that stays of every document."""
    docs = documents(docs, *carry)
    keys = line_hashes(docs, min_chars)
    index, shards = build_index(keys)
    hits = probe(keys, index, shards, min_docs).groupBy("doc_id").agg(F.collect_set("hi").alias("dropped"))
    hits = hits.withColumnRenamed("doc_id", "hit")
    rewrite = F.arrow_udf(lambda t, d: _rewrite(t, d, min_chars), "text string, n_lines long, n_dropped long")
    out = docs.join(hits, docs["doc_id"] == hits["hit"], "left").withColumn("new", rewrite("text", "dropped"))
    return out.select("doc_id", "new.text", "new.n_lines", "new.n_dropped", *carry)


def _rewrite(texts: pa.Array, dropped: pa.Array, min_chars: int) -> pa.Array:
    kept, lines, lost = [], [], []
    for text, gone in zip(texts.to_pylist(), dropped.to_pylist()):
        text = text or ""
        parts = text.split("\n")
        lines.append(len(parts))
        if gone:
            gone = {h & 0xFFFFFFFFFFFFFFFF for h in gone}
            out = {k for k, hi, _ in line_keys(text, min_chars) if hi in gone}
            parts = [p for k, p in enumerate(parts) if k not in out]
            text = "\n".join(parts)
        kept.append(text)
        lost.append(lines[-1] - len(parts))
    return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(lines, pa.int64()),
                                       pa.array(lost, pa.int64())], names=["text", "n_lines", "n_dropped"])


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(hi, lo, doc_id): the distinct keys of each document."""
    def rows(batch):
        ids, his, los = [], [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for hi, lo in {(hi, lo) for _, hi, lo in line_keys(text, min_chars)}:
                ids.append(doc_id)
                his.append(hi)
                los.append(lo)
        yield {"hi": np.array(his, np.uint64).view(np.int64), "lo": np.array(los, np.uint64).view(np.int64),
               "doc_id": ids}
    return arrow_map(docs, rows, "hi long, lo long, doc_id long")


def build_index(keys: DataFrame) -> tuple[DataFrame, int]:
    """(a row of arrays per shard of all distinct keys, shards)."""
    counted = keys.groupBy("hi", "lo").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper"))
    counted = written(counted, "line-counts")
    shards = max(1, -(-counted.count() // SHARD_KEYS))
    index = counted.withColumn("shard", F.pmod("hi", F.lit(shards)).cast("int")) \
        .groupBy("shard").applyInArrow(_shard, INDEX)
    index = written(index, "line-index").withColumn("replicas", F.ceil(F.col("probes") / SHARD_PROBES).cast("int"))
    discard(counted)
    return index, shards


def _shard(rows: pa.Table) -> pa.Table:
    lo = rows["lo"].to_numpy().view(np.uint64)
    levels = perfect_hash(lo)
    order = np.empty(len(lo), np.int64)
    order[locate(lo, levels)] = np.arange(len(lo))
    cols = {"shard": [rows["shard"][0].as_py()], "probes": [int(rows["n"].to_numpy().sum())],
            "words": [levels[0].tobytes()], "sizes": [levels[1].tobytes()], "ranks": [levels[2].tobytes()]}
    for name, col in (("fingerprints", "hi"), ("counts", "n"), ("keepers", "keeper")):
        cols[name] = [rows[col].to_numpy().astype(np.int64)[order].tobytes()]
    return pa.Table.from_batches([record(cols, arrow_types(INDEX))])


def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)).astype(np.int64)


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Levels of bit arrays over distinct 64-bit keys: (bits in bytes, size of
    each level, set bits before each byte).

    Each level hashes the keys left to GAMMA slots a key; those alone in their slot
    set its bit, the others go on.  A key's number is the rank of its bit.
    """
    left, level, bits, sizes = np.unique(keys), 0, [], []
    while len(left):
        size = -(-int(len(left) * GAMMA + 8) // 8) * 8
        at = _slots(left, level, size)
        alone = np.bincount(at, minlength=size) == 1
        bits.append(alone)
        sizes.append(size)
        left = left[~alone[at]]
        level += 1
    flat = np.packbits(np.concatenate(bits) if bits else np.zeros(0, bool))
    ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(flat))]).astype(np.int64)
    return flat, np.array(sizes, np.int64), ranks


def locate(keys: np.ndarray, levels: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The number of every key; -1 for some of the keys that are not indexed."""
    flat, sizes, ranks = levels
    out = np.full(len(keys), -1, np.int64)
    left, base = np.arange(len(keys)), 0
    for level, size in enumerate(sizes.tolist()):
        at = _slots(keys[left], level, size) + base
        byte, bit = at >> 3, at & 7
        found = (flat[byte] >> (7 - bit)) & 1 == 1
        b = byte[found]
        out[left[found]] = ranks[b] + np.bitwise_count(flat[b] >> (8 - bit[found]).astype(np.uint8))
        left = left[~found]
        base += size
    return out


def probe(keys: DataFrame, index: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """(hi, doc_id) of the lines a document loses.

    A shard's arrays come first in their task, the probes stream past them.  Only shards with
    a hot line are given out more than once; how often is looked up by the probes, in a broadcast
    only where that small table lies under the session's bound.
    """
    arrays = index.select("shard", F.explode(F.sequence(F.lit(0), F.col("replicas") - 1)).alias("replica"),
                          F.struct("words", "sizes", "ranks", "fingerprints", "counts", "keepers").alias("arrays"))
    probes = keys.select(F.pmod("hi", F.lit(shards)).cast("int").alias("shard"), "hi", "lo", "doc_id")
    hot = written(index.filter("replicas > 1").select("shard", "replicas"), "hot-shards")
    small = hot.count() * 16 <= broadcast_bytes(hot)
    probes = probes.join(F.broadcast(hot) if small else hot, "shard", "left") \
        .withColumn("replica", F.pmod(F.xxhash64("doc_id"), F.coalesce("replicas", F.lit(1))).cast("int")).drop("replicas")
    both = arrays.unionByName(probes, allowMissingColumns=True).repartition("shard", "replica") \
        .sortWithinPartitions("shard", "replica", F.col("arrays").isNull())
    return mapped(both.select("shard", "replica", "arrays", "hi", "lo", "doc_id"),
                  lambda batches: _probe(batches, min_docs), "hi long, doc_id long")


def _probe(batches, min_docs: int):
    place = arrays = None
    for batch in batches:
        heads = np.flatnonzero(pc.is_valid(batch.column("arrays")).to_numpy(zero_copy_only=False))
        cuts = [0, *heads.tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            part = batch.slice(lo, hi - lo)
            if part.num_rows and part.column("arrays")[0].is_valid:
                place = part.column("shard")[0].as_py(), part.column("replica")[0].as_py()
                arrays = Arrays(part.column("arrays")[0].as_py())
                part = part.slice(1)
            if part.num_rows and arrays is not None:
                yield arrays.losers(part, place, min_docs)


class Arrays:
    """A shard's arrays, as numpy views."""

    def __init__(self, row: dict):
        self.levels = (np.frombuffer(row["words"], np.uint8), np.frombuffer(row["sizes"], np.int64),
                       np.frombuffer(row["ranks"], np.int64))
        self.fingerprints = np.frombuffer(row["fingerprints"], np.int64)
        self.counts = np.frombuffer(row["counts"], np.int64)
        self.keepers = np.frombuffer(row["keepers"], np.int64)

    def losers(self, batch: pa.RecordBatch, place: tuple[int, int], min_docs: int) -> pa.RecordBatch:
        """The probes of this shard whose line ``min_docs`` documents hold and another one keeps."""
        shard, replica, hi, lo, doc = (batch.column(n).to_numpy() for n in ("shard", "replica", "hi", "lo", "doc_id"))
        at = locate(lo.view(np.uint64), self.levels)
        at[(shard != place[0]) | (replica != place[1])] = -1
        lose = at >= 0
        found = at[lose]
        lose[lose] = (self.fingerprints[found] == hi[lose]) & (self.counts[found] >= min_docs) \
            & (self.keepers[found] != doc[lose])
        return record({"hi": hi[lose], "doc_id": doc[lose]}, arrow_types("hi long, doc_id long"))
