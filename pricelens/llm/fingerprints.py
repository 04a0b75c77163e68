"""Document fingerprints: bottom-k sketches of word-shingle hashes.

Method: a text's sketch is the ``K`` least 64-bit hashes of its distinct
five-word shingles (A-Z lower-cased; a shorter text is one shingle).  The
sketch of a union is the ``K`` least of both sketches, so parts merge in any
order.  Two sketches estimate resemblance (the share of common hashes among
the least of their union), containment and distinct shingle counts; sketches
that hold all shingles give them exactly.

``with_neighbours`` walks the documents by descending doc_id: ids are cut into
ranges at their quantiles (the cut points are few, their number is a setting),
each range also receives the first document of the next one, and a task
streams its sorted range.  Text moves once, packed; nothing is in one task.

Defined results: null and empty texts have the empty sketch (two empty ones
resemble fully, an empty and another not at all); a null doc_id is left out;
rows that repeat a doc_id are each a document, ordered by their packed text;
an empty table gives no rows; the next document of a sole document is itself.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import arrow_map, arrow_types, documents, record
from pricelens.llm.text import Words, chunks, lower_ascii, pack, shingles, unpack

K = 128
SHINGLE = 5
GROUP_CHARS = 1 << 19


def sketches(texts: pa.Array, k: int = K) -> list[np.ndarray]:
    """The bottom-k sketch of every text: rising unsigned hashes."""
    out = []
    for c in chunks(texts):
        data = lower_ascii(c.data)
        words = Words(c)
        doc, h = shingles(words, words.hashes(data, 1), SHINGLE)
        cuts = np.searchsorted(doc, np.arange(len(c) + 1)).tolist()
        out += [h[a:min(b, a + k)].copy() for a, b in zip(cuts[:-1], cuts[1:])]
    return out


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union."""
    return np.union1d(a, b)[:k]


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / 2.0 ** 64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    least = np.union1d(a, b)[:k]
    return float(np.isin(least, np.intersect1d(a, b, assume_unique=True), assume_unique=True).mean())


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has, 0 to 1."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return min(1.0, both / distinct_shingles(a, k))


def to_text(a: np.ndarray) -> str:
    """A sketch as base64 of its big-endian hashes."""
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), ">u8").astype(np.uint64)


def fingerprint(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, fingerprint, n_shingles estimated) of every document."""
    def rows(batch):
        found = sketches(batch.column(1), k)
        yield {"doc_id": batch.column(0), "fingerprint": [to_text(s) for s in found],
               "n_shingles": [distinct_shingles(s, k) for s in found]}
    return arrow_map(documents(docs), rows, "doc_id long, fingerprint string, n_shingles double")


def merge_by(prints: DataFrame, key: str, k: int = K) -> DataFrame:
    """(key, fingerprint): the sketch of the union of each key's texts.

    First within every task, then by key: a key with very many rows reaches the
    second step as one sketch a task.
    """
    kind = dict(prints.dtypes)[key]

    def local(batches):
        held: dict = {}
        for batch in batches:
            for name, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[name] = merge(held[name], from_text(s), k) if name in held else from_text(s)
                if len(held) >= 10_000:
                    yield _named(held, batch.schema)
                    held = {}
        if held:
            yield _named(held, batch.schema)

    part = prints.select(key, "fingerprint").mapInArrow(local, f"`{key}` {kind}, fingerprint string")
    return part.repartition(key).sortWithinPartitions(key).mapInArrow(_merge_sorted(k), f"`{key}` {kind}, fingerprint string")


def _named(held: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), schema.field(0).type),
                                       pa.array([to_text(s) for s in held.values()])], names=schema.names)


def _merge_sorted(k: int):
    def run(batches):
        name, have, some, schema = None, None, False, None
        for batch in batches:
            schema, done = batch.schema, []
            for n, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if some and n == name:
                    have = merge(have, from_text(s), k)
                else:
                    if some:
                        done.append((name, have))
                    name, have, some = n, from_text(s), True
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], schema.field(0).type),
                                                  pa.array([to_text(h) for _, h in done])], names=schema.names)
        if some:
            yield _named({name: have}, schema)
    return run


# ---- neighbours by descending doc_id -------------------------------------------

EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def with_neighbours(docs: DataFrame, k: int = K) -> DataFrame:
    """Each document's sketch against that of its edited text and of the next document.

    The edited text has the last floor(n_chars / 3) code points replaced by as
    many from the start of the next document (all of it, if it has fewer).
    """
    docs = documents(docs)
    spark = docs.sparkSession
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n)
    cuts = np.unique(np.array(cuts, float))

    def rank(ids: np.ndarray) -> np.ndarray:      # 0 is the range of the greatest ids
        return len(cuts) - np.searchsorted(cuts, ids.astype(float), side="right")

    heads = arrow_map(docs.select("doc_id"), lambda b: iter([{"rank": rank(b.column(0).to_numpy()), "doc_id": b.column(0)}]),
                      "rank int, doc_id long").groupBy("rank").agg(F.max("doc_id")).collect()      # a row a range
    heads = sorted((r[0], r[1]) for r in heads)
    guests: dict[int, int] = {}
    for (before, _), (_, head) in zip(heads, heads[1:] + heads[:1]):
        guests[head] = before

    def deal(batch):
        ids, raw = batch.column(0).to_numpy(), batch.column(1)
        for c in chunks(raw):
            own = ids[c.lo:c.hi]
            z = [pack(c.raw(i)) for i in range(len(c))]
            yield {"part": rank(own), "guest": np.zeros(len(own), bool), "doc_id": own, "z": z}
            also = [i for i, x in enumerate(own.tolist()) if x in guests]
            if also:
                yield {"part": np.array([guests[int(own[i])] for i in also]), "guest": np.ones(len(also), bool),
                       "doc_id": own[also], "z": [z[i] for i in also]}

    dealt = arrow_map(docs, deal, "part int, guest boolean, doc_id long, z binary")
    dealt = dealt.repartition(n // 2, "part").sortWithinPartitions("part", "guest", F.desc("doc_id"), "z")
    return dealt.mapInArrow(lambda it: _walk(it, k), EDITED)


def _walk(batches, k: int):
    """Streams sorted ranges; a row is ready when the row after it is known."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3).to_pylist()):
            text = unpack(row[3]).decode()
            held.append((*row[:3], text))
            size += len(text)
            if size >= GROUP_CHARS:
                yield _edited(held, k)
                held, size = held[-1:], len(text)
    if len(held) > 1:
        yield _edited(held, k)


def _edited(rows: list[tuple], k: int) -> pa.RecordBatch:
    """Rows (range, guest, doc_id, text) but the last, each with the row after it.

    A range's own rows come before its guests, so an own row is followed by
    one of its range; of repeated guests only the first is used.
    """
    own = [i for i in range(len(rows) - 1) if not rows[i][1]]
    edited = []
    for i in own:
        text, after = rows[i][3], rows[i + 1][3]
        m = len(text) // 3
        edited.append(text[:len(text) - m] + after[:m])
    found = sketches(pa.array([r[3] for r in rows], pa.large_string()), k)
    new = sketches(pa.array(edited, pa.large_string()), k)
    return record({"doc_id": [rows[i][2] for i in own], "n_chars": [len(rows[i][3]) for i in own],
                   "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edited],
                   "fingerprint": [to_text(found[i]) for i in own], "edited_fingerprint": [to_text(s) for s in new],
                   "near_edited": [resemblance(found[i], s, k) for i, s in zip(own, new)],
                   "near_next": [resemblance(found[i], found[i + 1], k) for i in own]}, arrow_types(EDITED))
