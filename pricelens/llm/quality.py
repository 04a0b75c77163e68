"""Quality of texts: multiple-instance learning with gated attention over passages.

Method: a text is a bag of passages of ``PASSAGE`` words.  A passage is encoded
from the square roots of its shares of hashed byte pairs and a few shares of its
characters and words (``features``) by a learned layer, h = tanh(W x).  The gated
attention of a passage is w . (tanh(V h) * sigmoid(U h)); a softmax over the
bag turns it into weights, and the score is a logistic function of the weighted
mean of h.  Only document labels are given: which passages tell is
learned with the rest, by gradient steps through all of it.

Training reads labelled rows only, at most about ``SAMPLE`` of them, chosen by
hash (the documented bound).  Each label gets half of them, or what the other
leaves; drawn rows weigh as many as they stand for.  In training a text of more than
``BAG`` passages has neighbouring ones averaged into ``BAG``, so that the driver
gets at most ``SAMPLE * BAG`` passages and yet all of each text.  Scoring encodes
every passage of every whole text in one pass without a shuffle; a very long text
costs its length in time and 4 * (HIDDEN + 1) bytes a passage.

Defined results: null and empty texts, and texts of white space, are one passage
without words; a null doc_id is left out; without training rows of both labels every
score is the share of good ones (0 without any); repeated rows are scored each; an
empty table gives no rows; columns that aren't named in ``carry`` are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import documents
from pricelens.llm.text import GOLDEN, Chunk, Words, chunks, give_back, word_hashes

PASSAGE = 48
SLOTS = 512
SHARES = 9
SHORT = 16          # bytes added to a passage's length, so that a short one's few pairs don't weigh most
HIDDEN = 32
GATES = 16
SAMPLE = 2000
BAG = 64
BLOCK = 2048        # passages encoded at once
EPOCHS = 12
BATCH = 50
RATE = 3e-3
PENALTY = 1e-3


# ---- passages ------------------------------------------------------------------

def passages(c: Chunk) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    """(passages of each document, blocks of passage features) of a chunk."""
    words = Words(c)
    count = np.maximum(1, -(-words.count // PASSAGE))
    first = np.cumsum(count) - count
    own = first[words.doc] + words.place // PASSAGE           # passage of each word
    bound = np.empty(int(count.sum()) + 1, np.int64)          # first byte of each passage
    begins = words.place % PASSAGE == 0
    bound[own[begins]] = words.start[begins]
    bound[first] = c.offsets[:-1]
    bound[-1] = len(c.data)
    return count, _blocks(c, words, own, bound)


def _blocks(c: Chunk, words: Words, own: np.ndarray, bound: np.ndarray) -> Iterator[np.ndarray]:
    for lo in range(0, len(bound) - 1, BLOCK):
        hi = min(lo + BLOCK, len(bound) - 1)
        a, b = np.searchsorted(own, (lo, hi))
        yield features(c.data[bound[lo]:bound[hi]], bound[lo:hi + 1] - bound[lo],
                       words.start[a:b] - bound[lo], words.end[a:b] - bound[lo], own[a:b] - lo)


def features(data: np.ndarray, bound: np.ndarray, start: np.ndarray, end: np.ndarray, own: np.ndarray) -> np.ndarray:
    """One row a passage: SLOTS shares of byte pairs, then SHARES others."""
    n = len(bound) - 1
    size = np.diff(bound)
    at = np.repeat(np.arange(n), size)
    out = np.zeros((n, SLOTS + SHARES), np.float32)
    if len(data) > 1:
        pair = data[:-1].astype(np.int64) << 8 | data[1:]
        inside = at[:-1] == at[1:]
        cell = at[:-1] * SLOTS + ((pair * 40_503 + 12_345 >> 7) % SLOTS)
        found = np.bincount(cell[inside], minlength=n * SLOTS).reshape(n, SLOTS)
        out[:, :SLOTS] = np.sqrt(found / (size[:, None] + SHORT))
    kinds = ((data >= 65) & (data <= 90), (data >= 97) & (data <= 122), (data >= 48) & (data <= 57), data == 10,
             data >= 128, (data > 32) & (data < 127) & ~_ALNUM[data])
    for k, kind in enumerate(kinds):
        out[:, SLOTS + k] = np.bincount(at, weights=kind, minlength=n) / (size + SHORT)
    held = np.bincount(own, minlength=n) + 1
    out[:, SLOTS + 6] = np.bincount(own, weights=end - start, minlength=n) / held / 16
    name = word_hashes(data, start, end, 1) + own.astype(np.uint64) * GOLDEN
    kept = np.unique(name, return_index=True)[1]
    out[:, SLOTS + 7] = (held - 1 - np.bincount(own[kept], minlength=n)) / held      # words that were there before
    out[:, SLOTS + 8] = np.bincount(own[1:][name[1:] == name[:-1]], minlength=n) / held      # right before
    return out


_ALNUM = np.array([chr(b).isalnum() and b < 128 for b in range(256)])


def pooled(x: np.ndarray, most: int = BAG) -> np.ndarray:
    """At most ``most`` rows: means of neighbours, if there are more."""
    if len(x) <= most:
        return x
    cuts = np.arange(most) * len(x) // most
    return np.add.reduceat(x, cuts, axis=0) / np.diff(np.append(cuts, len(x)))[:, None]


# ---- model ----------------------------------------------------------------------

def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """An encoder (w, b), gates (v, u, attend) and a readout (c, bias)."""

    NAMES = ("w", "b", "v", "u", "attend", "c", "bias")

    def __init__(self, **parts: np.ndarray):
        self.parts = {k: parts[k].astype(np.float32) for k in self.NAMES}

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(h, attention before the softmax) of passages."""
        p = self.parts
        h = np.tanh(x @ p["w"] + p["b"])
        return h, (np.tanh(h @ p["v"]) * sigmoid(h @ p["u"])) @ p["attend"]

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = [np.zeros(0)]
        for c in chunks(texts):
            count, blocks = passages(c)
            h, e = (np.concatenate(k) for k in zip(*map(self.encode, blocks)))
            z = weighted(h, e, np.cumsum(count) - count)[0]
            out.append(sigmoid(z.astype(float) @ self.parts["c"] + float(self.parts["bias"][0])))
        return np.concatenate(out)

    @classmethod
    def constant(cls, share: float) -> "Model":
        p = min(max(share, 1e-12), 1 - 1e-12)
        return cls(w=np.zeros((SLOTS + SHARES, HIDDEN)), b=np.zeros(HIDDEN), v=np.zeros((HIDDEN, GATES)), u=np.zeros((HIDDEN, GATES)),
                   attend=np.zeros(GATES), c=np.zeros(HIDDEN), bias=np.array([np.log(p / (1 - p))]))


def weighted(h: np.ndarray, e: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bag representations, attention weights); bags begin at ``first``."""
    size = np.diff(np.append(first, len(e)))
    a = np.exp(e - np.repeat(np.maximum.reduceat(e, first), size))
    a /= np.repeat(np.add.reduceat(a, first), size)
    return np.add.reduceat(a[:, None] * h, first, axis=0), a


def gradients(p: dict, x: np.ndarray, first: np.ndarray, y: np.ndarray, g: np.ndarray) -> dict:
    """Of the weighted log loss of some bags with passages x."""
    size = np.diff(np.append(first, len(x)))
    h = np.tanh(x @ p["w"] + p["b"])
    t, s = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
    z, a = weighted(h, (t * s) @ p["attend"], first)
    error = g * (sigmoid(z @ p["c"] + p["bias"][0]) - y)
    back = np.repeat(error[:, None] * p["c"], size, axis=0)
    gain = (back * h).sum(1)
    de = a * (gain - np.repeat(np.add.reduceat(a * gain, first), size))
    dt = de[:, None] * p["attend"] * s * (1 - t * t)
    ds = de[:, None] * p["attend"] * t * s * (1 - s)
    dh = (a[:, None] * back + dt @ p["v"].T + ds @ p["u"].T) * (1 - h * h)
    return {"w": x.T @ dh, "b": dh.sum(0), "v": h.T @ dt, "u": h.T @ ds, "attend": (t * s).T @ de, "c": z.T @ error,
            "bias": error.sum(keepdims=True)}


def fit(bags: list[np.ndarray], labels: np.ndarray, weights: np.ndarray | None = None, epochs: int = EPOCHS) -> Model:
    """Adam steps on the log loss; ``weights`` are the rows that each bag stands for."""
    y = np.asarray(labels, np.float32)
    g = np.ones(len(y)) if weights is None else np.asarray(weights, float)
    share = float((g * y).sum() / max(g.sum(), 1e-12))
    if not 0 < share < 1:
        return Model.constant(share)
    g = (g / g.mean()).astype(np.float32)
    n = sum(map(len, bags))
    mean = sum(b.sum(0, dtype=np.float64) for b in bags) / n
    sd = np.sqrt(np.maximum(sum((b.astype(np.float32) ** 2).sum(0, dtype=np.float64) for b in bags) / n - mean ** 2, 0)) + 0.01
    mean, sd = mean.astype(np.float32), sd.astype(np.float32)
    rng = np.random.default_rng(5)
    width = SLOTS + SHARES
    p = {"w": rng.normal(0, width ** -0.5, (width, HIDDEN)), "b": np.zeros(HIDDEN), "v": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATES)),
         "u": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATES)), "attend": rng.normal(0, GATES ** -0.5, GATES),
         "c": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "bias": np.array([np.log(share / (1 - share))])}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), BATCH):
            some = order[lo:lo + BATCH].tolist()
            size = np.array([len(bags[k]) for k in some])
            x = (np.concatenate([bags[k] for k in some]).astype(np.float32) - mean) / sd
            d = gradients(p, x, np.cumsum(size) - size, y[some], g[some] / len(some))
            step += 1
            rate = RATE * (1 - epoch / epochs)
            for k in p:
                grad = d[k] + (PENALTY * p[k] if k in ("w", "c") else 0)
                m[k] += 0.1 * (grad - m[k])
                v[k] += 0.01 * (grad * grad - v[k])
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    w = p["w"] / sd[:, None]
    return Model(**p | {"w": w, "b": p["b"] - mean @ w})


# ---- jobs ------------------------------------------------------------------------

def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on at most about ``sample`` of the rows of (doc_id, quality) in ``labels``.

    Of a label that has more rows than its part, those whose hash lies under its share are taken.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sizes = {r["quality"]: r["count"] for r in marked.groupBy("quality").count().collect()}
    n = sum(sizes.values())
    share = {k: min(1.0, max(sample // 2, sample - (n - size)) / size) for k, size in sizes.items()}
    marked = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
                           < F.when(F.col("quality") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0)) * 2.0 ** 40)
    rows = documents(docs).join(F.broadcast(marked), "doc_id")     # at most about ``sample`` rows of two numbers

    def extract(batches):
        for batch in batches:
            for c in chunks(batch.column(1)):
                count, blocks = passages(c)
                x, ends = np.concatenate(list(blocks)), np.cumsum(count)
                found = [pooled(x[a:b]).astype(np.float16).tobytes() for a, b in zip((ends - count).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(c.lo, len(c)), pa.array(found, pa.binary()),
                                                  batch.column(2).slice(c.lo, len(c))], names=["doc_id", "x", "quality"])
    got = rows.select("doc_id", "text", "quality").mapInArrow(extract, "doc_id long, x binary, quality int").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("x", "ascending")])
    quality = got["quality"].to_numpy()
    bags = [np.frombuffer(x.as_buffer(), np.float16).reshape(-1, SLOTS + SHARES) for x in got["x"]]
    model = fit(bags, quality, np.array([1 / share[k] for k in quality.tolist()]))
    del got, bags
    give_back()
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.5, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, score, predicted, *carry) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model.parts)      # some 20,000 numbers

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(Model(**shared.value).scores(texts), pa.float64())

    out = documents(docs, *carry).withColumn("score", F.arrow_udf(run, "double")("text"))
    return out.select("doc_id", "text", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *carry)
