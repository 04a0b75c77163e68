"""Language of texts by hierarchical discrimination.

Method: the languages learned are grouped into families: starting from one
language each, the two families whose mean profiles are most alike are joined
while they are more alike than languages are on average.  A text's family is
predicted first, by one-versus-rest linear support vector machines over
families; within the family one-versus-one machines separate its languages
and the one with the most votes (then the larger margins) wins.

Features are hashed character n-grams (1 to 4 bytes, A-Z lower-cased) of the
whole text: square roots of their shares, so unit vectors.  Machines have a
squared hinge loss and are fitted together by accelerated gradient steps.

Training draws from the distinct (text, lang) with a non-null lang, so copies
count once, by hash and for each language alike: at most about as many rows of
each as share out ``SAMPLE``, though never fewer than ``LEAST``, and all rows of
languages that have no more (the documented bound: the larger of ``SAMPLE`` and
languages x ``LEAST``, 8 KB each).  Prediction is one pass without a shuffle.

Defined results: a null text, or one without letters, is ``und`` with score 0;
a null doc_id is left out; without training rows everything is ``und``; with
one language it is always predicted; repeated rows are predicted each; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import documents, written
from pricelens.llm.text import Chunk, chunks, lower_ascii

SAMPLE = 4000
LEAST = 100
BITS = 12
LENGTHS = (1, 2, 3, 4)
PENALTY = 1e-4
STEPS = 80
GROUP = 256
UNKNOWN = "und"


def features(c: Chunk) -> np.ndarray:
    """A unit vector of hashed n-gram shares for every document of a chunk."""
    data = lower_ascii(c.data).astype(np.uint64)
    n, docs = len(data), len(c)
    sizes = np.diff(c.offsets)
    doc = np.repeat(np.arange(docs), sizes) << BITS
    left = np.repeat(c.offsets[1:], sizes) - np.arange(n)        # bytes from here to the document's end
    out = np.zeros(docs << BITS, np.float64)
    value = np.zeros(n, np.uint64)
    for k in range(max(LENGTHS)):
        value[:n - k] = (value[:n - k] << np.uint64(8)) | data[k:]
        if k + 1 in LENGTHS:
            h = (value ^ np.uint64((k + 1) << 56)) * np.uint64(0x9E3779B97F4A7C15)
            at = (doc | (h >> np.uint64(64 - BITS)).astype(np.int64))[left > k]
            out += np.bincount(at, minlength=len(out))
    out = np.sqrt(out.reshape(docs, -1))
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def has_letters(c: Chunk) -> np.ndarray:
    """Whether each document of a chunk has a letter of any script."""
    low = c.data | 0x20
    run = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122) & (c.data < 128))])
    out = run[c.offsets[1:]] > run[c.offsets[:-1]]
    for i in np.flatnonzero(~out).tolist():
        out[i] = any(ch.isalpha() for ch in c.raw(i).decode())
    return out


class Model:
    """Families of languages and the machines between and within them."""

    def __init__(self, langs: list[str], families: list[list[int]], between: np.ndarray,
                 pairs: list[tuple[int, int]], within: np.ndarray):
        self.langs, self.families, self.between, self.pairs, self.within = langs, families, between, pairs, within

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language number, score) of every row of features."""
        x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
        by_family = x @ self.between
        family = by_family.argmax(1)
        sure = _share(by_family)
        votes = np.zeros((len(x), len(self.langs)))
        margins = x @ self.within
        for k, (a, b) in enumerate(self.pairs):
            soft = 1 / (1 + np.exp(-3 * margins[:, k].astype(float)))
            votes[:, a] += (margins[:, k] >= 0) + 1e-3 * soft
            votes[:, b] += (margins[:, k] < 0) + 1e-3 * (1 - soft)
        lang, score = np.zeros(len(x), np.int64), np.zeros(len(x))
        for f, members in enumerate(self.families):
            at = np.flatnonzero(family == f)
            own = votes[np.ix_(at, members)]
            best = own.argmax(1)
            lang[at] = np.array(members)[best]
            won = own[np.arange(len(at)), best] / max(1, len(members) - 1) if len(members) > 1 else np.ones(len(at))
            score[at] = sure[at] * np.minimum(1.0, won)
        return lang, score


def _share(margins: np.ndarray) -> np.ndarray:
    """Share of the best margin by softmax."""
    e = np.exp(3 * (margins - margins.max(1, keepdims=True)).astype(float))
    return 1 / e.sum(1)


def group_families(centres: np.ndarray) -> list[list[int]]:
    """Joins languages whose profiles are more alike than average."""
    alike = centres @ centres.T / np.outer(np.linalg.norm(centres, axis=1), np.linalg.norm(centres, axis=1))
    families = [[k] for k in range(len(centres))]
    if len(centres) < 3:
        return families
    mean = alike[np.triu_indices(len(centres), 1)].mean()
    while len(families) > 2:
        pairs = [(alike[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(families) for j, b in enumerate(families) if i < j]
        best, i, j = max(pairs)
        if best <= mean:
            break
        families[i] = sorted(families[i] + families[j])
        del families[j]
    return families


def machines(x: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Weights (features + 1, machines) for targets 1, -1, or 0 to sit a machine out."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float32)
    t = targets.astype(np.float32)
    # each side of a machine weighs half, whatever its number of rows
    weight = np.where(t > 0, 0.5 / np.maximum((t > 0).sum(0), 1), np.where(t < 0, 0.5 / np.maximum((t < 0).sum(0), 1), 0))
    weight = weight.astype(np.float32)
    step = np.float32(1 / (2 * 2.0 + PENALTY))      # rows have norm sqrt(2), weights sum to 1
    w = pw = np.zeros((x.shape[1], t.shape[1]), np.float32)
    s = 1.0
    for _ in range(STEPS):
        ns = (1 + (1 + 4 * s * s) ** 0.5) / 2
        m = w + np.float32((s - 1) / ns) * (w - pw)
        slack = np.maximum(0, 1 - t * (x @ m)) * t * weight
        pw, s = w, ns
        w = m - step * (np.float32(PENALTY) * m - 2 * (x.T @ slack))
    return w


def fit(x: np.ndarray, langs: list[str]) -> Model:
    names = sorted(set(langs))
    y = np.array([names.index(v) for v in langs])
    centres = np.array([x[y == k].mean(0) for k in range(len(names))])
    families = group_families(centres)
    of = np.zeros(len(names), int)
    for f, members in enumerate(families):
        of[members] = f
    between = machines(x, np.where(of[y][:, None] == np.arange(len(families)), 1, -1)) if len(families) > 1 \
        else np.zeros((x.shape[1] + 1, 1), np.float32)
    pairs = [(a, b) for m in families for i, a in enumerate(m) for b in m[i + 1:]]
    sides = np.array([[1 if v == a else -1 if v == b else 0 for a, b in pairs] for v in y]).reshape(len(y), len(pairs))
    return Model(names, families, between, pairs, machines(x, sides))


def rows_each(sizes: list[int], sample: int, least: int) -> int:
    """How many rows of each language to draw, so that all together draw ``sample``, or ``least`` of each."""
    left = sample
    for k, size in enumerate(sorted(sizes)):
        if size * (len(sizes) - k) > left:
            return max(least, left // (len(sizes) - k))
        left -= size
    return max([least, *sizes])


def train(docs: DataFrame, sample: int = SAMPLE, least: int = LEAST) -> Model | None:
    """Fits on at most about ``sample`` distinct (text, lang), or ``least`` of each lang; None without any.

    Of a lang that has more, those whose hash of the text lies under its share are taken.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")) \
        .filter("text is not null and lang is not null").withColumn("h", F.xxhash64("text"))
    # The least doc_id stands for copies: three small columns a text, so no text is shuffled.
    keys = written(rows.groupBy("lang", "h").agg(F.min("doc_id").alias("doc_id")), "langid-keys")
    sizes = keys.groupBy("lang").count()
    each = rows_each([r["count"] for r in sizes.collect()], sample, least)
    drawn = keys.join(F.broadcast(sizes), "lang") \
        .filter(F.pmod("h", F.lit(1 << 40)) < F.lit(each * 2.0 ** 40) / F.col("count")) \
        .select(F.col("lang").alias("l"), F.col("h").alias("g"), F.col("doc_id").alias("d"))
    # at most about the documented number of rows of three small columns
    rows = rows.join(F.broadcast(drawn), (F.col("lang") == F.col("l")) & (F.col("h") == F.col("g"))
                     & F.col("doc_id").eqNullSafe(F.col("d"))).select("text", "lang", "h")

    def extract(batches):
        seen = set()      # of repeated rows, which share even the doc_id, a task takes one
        for batch in batches:
            new = []
            for k, key in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                if key not in seen:
                    seen.add(key)
                    new.append(k)
            batch = batch.take(pa.array(new, pa.int32()))
            for c in chunks(batch.column(0), most=GROUP):
                # shares fit 16 bits: 8 KB a row reach the driver
                found = [r.astype(np.float16).tobytes() for r in features(c)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1).slice(c.lo, len(c)),
                                                  batch.column(2).slice(c.lo, len(c))], names=["f", "lang", "h"])
    got = rows.mapInArrow(extract, "f binary, lang string, h long").dropDuplicates(["lang", "h"]).toArrow()
    if not got.num_rows:
        return None
    raw, langs = got["f"].to_pylist(), got["lang"].to_pylist()
    order = sorted(range(len(raw)), key=lambda i: (langs[i], raw[i]))
    x = np.array([np.frombuffer(raw[i], np.float16) for i in order], np.float32)
    return fit(x, [langs[i] for i in order])


def identify(docs: DataFrame, model: Model | None, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, lang_pred, score, *carry) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # 2**BITS numbers a machine

    def run(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        null = pc.is_null(texts).to_numpy(zero_copy_only=False)
        for c in chunks(texts, most=GROUP):
            ok = has_letters(c) & ~null[c.lo:c.hi]
            if shared.value is None:
                lang, score = np.zeros(len(c), int), np.zeros(len(c))
                ok[:] = False
            else:
                lang, score = shared.value.predict(features(c))
            names += [shared.value.langs[k] if y else UNKNOWN for k, y in zip(lang.tolist(), ok.tolist())]
            scores.append(np.where(ok, score, 0.0))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()),
                                           pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                                          names=["lang_pred", "score"])

    out = documents(docs, *carry).withColumn("out", F.arrow_udf(run, "lang_pred string, score double")("text"))
    return out.select("doc_id", "out.lang_pred", "out.score", *carry)
