"""Toxicity of texts: linear classifier over character n-grams, naive Bayes scaled.

Method: the features of a text are the hashed character n-grams (3 to 5 code points,
A-Z lower-cased) it holds, each once.  Every feature is scaled by its naive
Bayes log-count ratio r between toxic and other training texts, and a logistic
regression with an L2 penalty is fitted on the scaled features, so a feature
weighs r times what the regression gives it; features with |r| under
``MIN_RATIO`` tell nothing and weigh 0.

Training reads every labelled row.  Texts meet their labels once, packed, and are written; tasks
count the features of these texts by label, then write the telling ones of each text as a table
(about 2 KB a text of 500 words), and each step of the regression is a pass over that table, by a task a
core: tasks add up the gradient of their rows by the telling features, slices of it are summed by key, and the
driver gets the sum, at most ``2**BITS`` numbers whatever the number of rows (from up to ``FEW`` tasks it sums
them itself).  A row's error counts in units of ``UNIT``, so sums are exact and neither files nor partitions
change the model.  Up to ``LOCAL`` labelled
documents take the same steps on the driver.  Scoring is one pass over whole texts
without a shuffle; a text's cost is its length.

Defined results: null and empty texts have no features and get the score of
the bias alone; a null doc_id is left out; without training rows of both
labels every score is the share of toxic labels (0 without any); repeated
rows are scored each; bytes that are no UTF-8 count as characters of their own kind; a very
long text is scored whole (about 60 bytes of memory for each of its bytes); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import arrow_types, discard, documents, mapped, packed_rows, record, release, written
from pricelens.llm.text import Chunk, chunks, give_back, lower_ascii, unpacked

LOCAL = 4000
BITS = 18
LENGTHS = (3, 4, 5)
ALPHA = 1.0
MIN_RATIO = 0.4
PENALTY = 3e-3
STEPS = 80
UNIT = 2.0 ** -26       # sums of errors under 1 are exact up to 2**27 rows
SLICE = 1 << 13
FEW = 16                # tasks whose vectors, 2 MB each, the driver sums itself
TIDY = 8                # steps after which their shuffle files are given up


def characters(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(a number for each code point, its bytes; the offsets of the documents among them)."""
    data = lower_ascii(c.data)
    first = (data & 0xC0) != 0x80
    first[c.offsets[:-1][c.offsets[:-1] < len(data)]] = True     # no character spans documents
    at = np.flatnonzero(first)
    chars, more = data[at].astype(np.uint64), np.ones(len(at), bool)
    for k in range(1, 4):
        more &= at + k < len(data)
        more[more] = ~first[at[more] + k]
        if not more.any():
            break
        chars[more] = chars[more] << np.uint64(8) | data[at[more] + k]
    return chars, np.searchsorted(at, c.offsets)


def features(c: Chunk) -> list[np.ndarray]:
    """The distinct hashed n-grams of every document of a chunk, rising."""
    chars, offsets = characters(c)
    n = len(chars)
    slots = np.empty((len(LENGTHS), n), np.int32)
    value = np.zeros(n, np.uint64)
    row = 0
    for k in range(max(LENGTHS)):
        m = max(n - k, 0)
        value[:m] = value[:m] * np.uint64(0xD6E8FEB86659FD93) + chars[k:]
        if k + 1 in LENGTHS:
            h = (value ^ np.uint64((k + 1) << 56)) * np.uint64(0x9E3779B97F4A7C15)
            slots[row] = (h >> np.uint64(64 - BITS)).astype(np.int32)
            row += 1
    seen = np.zeros(1 << BITS, bool)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        for row, k in enumerate(LENGTHS):
            seen[slots[row, a:max(a, b - k + 1)]] = True
        f = np.flatnonzero(seen)
        seen[f] = False
        out.append(f)
    return out


class Model:
    """Weights of the features and a bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = []
        for c in chunks(texts):
            out += [float(self.weights[f].sum(dtype=np.float64)) for f in features(c)]
        return 1 / (1 + np.exp(-np.clip(np.array(out, float) + self.bias, -30, 30)))


def constant(share: float) -> Model:
    p = min(max(share, 1e-12), 1 - 1e-12)
    return Model(np.zeros(1 << BITS), np.log(p / (1 - p)))


def log_ratios(toxic: np.ndarray, other: np.ndarray, n_toxic: float, n_other: float) -> np.ndarray:
    """Naive Bayes log-count ratios of the features from the texts of each label that hold them."""
    return np.log((ALPHA + toxic) / (n_toxic + 2 * ALPHA)) - np.log((ALPHA + other) / (n_other + 2 * ALPHA))


def errors(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y


def descend(share: float, curve: Callable, slope: Callable) -> tuple[np.ndarray, float]:
    """(weights of the scaled features, bias) by accelerated gradient steps.

    ``curve(v)`` is X'GXv for the scaled features X and row weights G, ``slope(w, b)`` the log loss's gradient by w and b.
    """
    v = np.random.default_rng(3).standard_normal(1 << BITS)
    for _ in range(8):      # the largest curvature, by power iteration
        v /= np.linalg.norm(v)
        v = curve(v)
    step = 1 / (0.3 * np.linalg.norm(v) + PENALTY + 0.25)
    w, b = np.zeros(1 << BITS), np.log(share / (1 - share))
    pw, pb, t = w, b, 1.0
    for _ in range(STEPS):
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        mw, mb = w + (t - 1) / nt * (w - pw), b + (t - 1) / nt * (b - pb)
        dw, db = slope(mw, mb)
        pw, pb, t = w, b, nt
        w, b = mw - step * (dw + PENALTY * mw), mb - step * db
    return w, b


def fit(rows: list[np.ndarray], labels: np.ndarray, weights: np.ndarray | None = None) -> Model:
    """Naive Bayes ratios, then logistic regression by accelerated gradient steps.

    ``weights`` are the rows that each row stands for, 1 by default.
    """
    y = np.asarray(labels, float)
    g = np.ones(len(y)) if weights is None else np.asarray(weights, float)
    g = g / max(g.sum(), 1e-12)
    share = float(g @ y)
    if not 0 < share < 1:
        return constant(share)
    toxic, other = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for f, label in zip(rows, y):
        (toxic if label else other)[f] += 1
    ratio = log_ratios(toxic, other, y.sum(), (1 - y).sum())
    telling = np.abs(ratio) >= MIN_RATIO
    size = np.array([int(telling[f].sum()) for f in rows])
    cuts = np.concatenate([[0], np.cumsum(size)])
    idx = np.empty(cuts[-1], np.int32)
    for f, at in zip(rows, cuts.tolist()):
        some = f[telling[f]]
        idx[at:at + len(some)] = some
    # Some rows at a time, so that no copy of all of them is made.
    parts = [(lo, min(lo + 200, len(rows))) for lo in range(0, len(rows), 200)]

    def forward(w):
        out = np.empty(len(rows))
        for lo, hi in parts:
            run = np.concatenate([[0], np.cumsum((ratio * w)[idx[cuts[lo]:cuts[hi]]])])
            at = cuts[lo:hi + 1] - cuts[lo]
            out[lo:hi] = run[at[1:]] - run[at[:-1]]
        return out

    def backward(e):
        out = np.zeros(1 << BITS)
        for lo, hi in parts:
            out += np.bincount(idx[cuts[lo]:cuts[hi]], weights=np.repeat(e[lo:hi], size[lo:hi]), minlength=1 << BITS)
        return ratio * out

    def slope(w, b):
        e = g * errors(forward(w) + b, y)
        return backward(e), e.sum()

    w, b = descend(share, lambda v: backward(g * forward(v)), slope)
    return Model(np.where(telling, ratio * w, 0), b)


def total(rows: DataFrame, add: Callable[[pa.RecordBatch, np.ndarray], None], n: int, few: bool = False) -> np.ndarray:
    """The sum of all batches' vectors of ``n`` numbers; ``add`` adds a batch's own to the vector it is given.

    Slices of the tasks' vectors are summed by key, or on the driver where the tasks are ``few``.
    """
    types = arrow_types("at long, v binary")

    def partial(batches):
        out = None
        for batch in batches:
            if out is None:
                out = np.zeros(n)
            add(batch, out)
        if out is not None:
            at = range(0, n, SLICE)
            yield record({"at": list(at), "v": [out[k:k + SLICE].tobytes() for k in at]}, types)

    def merge(batches):
        out = {}
        for batch in batches:
            for at, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out[at] = out.get(at, 0) + np.frombuffer(v)
        yield record({"at": list(out), "v": [v.tobytes() for v in out.values()]}, types)

    got = mapped(rows, partial, "at long, v binary")
    if not few:
        got = mapped(got.repartition("at"), merge, "at long, v binary")
    got, out = got.toArrow(), np.zeros(n)
    for at, v in zip(got["at"].to_pylist(), got["v"].to_pylist()):
        out[at:at + SLICE] += np.frombuffer(v)
    return out


def labelled(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """(z, toxic): the packed texts of the rows of ``docs`` that ``marked`` labels.

    They are dealt by doc_id at any size: no label is broadcast, and the rows lie evenly.
    """
    return packed_rows(documents(docs)).join(marked.hint("merge"), "doc_id").select("z", "toxic")


def fit_all(rows: DataFrame) -> Model:
    """:func:`fit` on all rows of a table (z, toxic) of packed texts, by passes over it."""
    n = 1 << BITS

    def count(batch, out):
        toxic = batch.column(1).to_numpy()
        for c in unpacked(batch.column(0)):
            for f, label in zip(features(c), toxic[c.lo:c.hi].tolist()):
                out[:n][f] += label
                out[n:2 * n][f] += 1 - label
        out[2 * n] += toxic.sum()
        out[2 * n + 1] += (1 - toxic).sum()

    counts = total(rows, count, 2 * n + 2)
    n_toxic, n_other = counts[2 * n:].tolist()
    size = n_toxic + n_other
    if not 0 < n_toxic < size:
        return constant(n_toxic / max(size, 1))
    ratio = log_ratios(counts[:n], counts[n:2 * n], n_toxic, n_other)
    telling = np.abs(ratio) >= MIN_RATIO
    most = int(telling.sum())
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(telling)
    types = arrow_types("toxic binary, size binary, f binary")

    def extract(batches):
        number = (np.cumsum(shared.value) - 1).astype(np.int32)     # among the telling ones
        for batch in batches:
            toxic = batch.column(1).to_numpy().astype(np.uint8)
            for c in unpacked(batch.column(0)):
                found = [number[f[shared.value[f]]] for f in features(c)]
                yield record({"toxic": [toxic[c.lo:c.hi].tobytes()], "size": [np.array([len(f) for f in found], np.int32).tobytes()],
                              "f": [np.concatenate(found).tobytes()]}, types)

    # one row a chunk of texts
    table = written(mapped(rows, extract, "toxic binary, size binary, f binary"), "telling-features")
    release(rows)
    dealt = table.coalesce(context.defaultParallelism)        # a step's vectors are as many as there are cores
    few = dealt.rdd.getNumPartitions() <= FEW
    passes = 0

    def step(w, b=None):
        """Sums over rows of each feature's errors, and of all errors; the errors are the products if there is no bias."""
        nonlocal passes
        weights = context.broadcast((ratio * w)[telling])

        def add(batch, out):
            y, sizes, f = (np.frombuffer(b"".join(column.to_pylist()), kind) for column, kind in zip(batch.columns, (np.uint8, np.int32, np.int32)))
            of = np.repeat(np.arange(len(y)), sizes)
            e = np.bincount(of, weights.value[f], len(y))
            e = np.rint((e if b is None else errors(e + b, y)) / UNIT)
            out[:most] += np.bincount(f, e[of], most)
            out[most] += e.sum()

        got = total(dealt, add, most + 1, few) * (UNIT / size)
        out = np.zeros(n)
        out[telling] = got[:most]
        weights.destroy()
        passes += 1
        if not few and passes % TIDY == 0:
            release(table)
        return ratio * out, got[most]

    w, b = descend(n_toxic / size, lambda v: step(v)[0], step)
    shared.destroy()
    discard(table)
    return Model(np.where(telling, ratio * w, 0), b)


def train(docs: DataFrame, labels: DataFrame, sample: int | None = None) -> Model:
    """Fits on all rows of (doc_id, toxic) in ``labels``.

    With ``sample``, for trials, on at most about so many: of a label that has more rows than its part, those
    whose hash lies under its share are taken, and weigh as many as they stand for.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = written(marked, "toxic-labels")
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    n = sum(sizes.values())
    if sample is None and n > LOCAL:
        rows = written(labelled(docs, marked), "labelled-texts")
        release(rows)
        model = fit_all(rows)
        discard(marked, rows)
        return model
    sample = LOCAL if sample is None else sample
    share = {k: min(1.0, max(sample // 2, sample - (n - size)) / size) for k, size in sizes.items()}
    drawn = marked
    if n > sample:
        drawn = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
                              < F.when(F.col("toxic") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0)) * 2.0 ** 40)
    rows = documents(docs).join(F.broadcast(drawn), "doc_id")     # at most about ``sample`` rows of two numbers

    def extract(batches):
        for batch in batches:
            found = [f.astype(np.int32).tobytes() for c in chunks(batch.column(1)) for f in features(c)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), batch.column(2)],
                                             names=["doc_id", "f", "toxic"])
    got = rows.select("doc_id", "text", "toxic").mapInArrow(extract, "doc_id long, f binary, toxic int").toArrow()
    order = np.argsort(got["doc_id"].to_numpy(), kind="stable")
    toxic = got["toxic"].to_numpy()[order]
    raw = got["f"].combine_chunks().cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:] // 4 if len(raw) else None
    buf = raw.buffers()[2]
    flat = np.frombuffer(buf, np.int32) if buf is not None and buf.size else np.zeros(0, np.int32)
    del got
    model = fit([flat[ends[i]:ends[i + 1]] for i in order.tolist()], toxic, np.array([1 / share[k] for k in toxic.tolist()]))
    del raw, buf, flat
    discard(marked)
    give_back()
    return model


def score(docs: DataFrame, model: Model, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, score, predicted, *carry) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))      # 2**BITS numbers

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(Model(*shared.value).scores(texts), pa.float64())

    out = documents(docs, *carry).withColumn("score", F.arrow_udf(run, "double")("text"))
    return out.select("doc_id", "text", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *carry)
