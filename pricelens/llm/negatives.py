"""Hard negatives for anchor vectors, found through bounds along a spanning tree.

Vectors are scored by integer inner products.  An anchor's positives are its
best rows of the same label; for each positive, the negatives are the best rows
of other labels whose score lies in a window given in percent of the positive's.

Method: anchors are taken in blocks of about ``BLOCK``; a block is the query
set of one pass over all rows.  Its anchors form a minimum spanning tree.  With
the score s of a row x at a parent, a child at edge distance d scores
s +- d * |x|, and so on down the tree from what is known of the parent, an exact
score or an interval.  A row is rescored at an anchor only where its interval
reaches into a window of the anchor (for positives: to its worst best row so
far) and could still be among the best.  Bounds are in floating point with a
margin for rounding; scores are exact, so the result doesn't depend on them.

Tasks read rows once a pass and return at most a few rows an anchor; these meet
by anchor.  No row is sent to another, no label is gathered and nothing is
dropped: a hot label or very many equal vectors are rows like others.  The
driver holds one block of anchors at a time, and the bests that belong to it.
The number of passes grows with the number of anchors, as the work does.

Defined results: rows with a null id, label or vector, an empty vector or any
null or non-finite component take no part, and neither do those so large that
scores could leave the range of longs (a squared length of 2**63 or over); rows
that repeat an id are one (the greatest label and vector stand); vectors of
another length than the anchor's have no score with it; ties go to the smaller
id; an anchor without positives, and a positive without negatives, gives no
rows; an empty table gives no rows; other columns are left behind.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import arrow_types, record, written
from pricelens.session import scratch_path

POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)       # percent of the positive's score
BLOCK = 2048
ROWS = 1024
PAIRS = 100_000
SCALE = 256
MINED = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def whole_vectors(vectors: DataFrame, label: str = "label") -> DataFrame:
    """(vec_id, label long, c array<long>) of the rows of (vec_id, embedding, ...) that take part.

    ``label`` is an SQL expression; a component x becomes floor(SCALE * x).
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.expr(label).cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("e")) \
        .filter("vec_id is not null and label is not null and size(e) > 0 and "
                "forall(e, x -> x is not null and not isnan(x) and abs(x) < 36028797018963968)")      # 2**55: the product is a long
    v = v.withColumn("c", F.expr(f"transform(e, x -> floor({SCALE} * x))")) \
        .filter(f"aggregate(c, 0D, (s, x) -> s + double(x) * double(x)) < {2.0 ** 63!r}D")
    return v.groupBy("vec_id").agg(F.max(F.struct("label", "c")).alias("v")).select("vec_id", "v.label", "v.c")


def hard_negatives(rows: DataFrame, is_anchor: str, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   window: tuple[int, int] = WINDOW, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` come from :func:`whole_vectors`; ``is_anchor`` is an SQL expression over them.
    """
    spark = rows.sparkSession
    # A set number of files, for the work grows with the anchors and not with the bytes of the rows.
    rows = written(rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "vec_id"), "vectors")
    anchors = rows.filter(is_anchor)
    blocks = -(-anchors.count() // block)
    path = scratch_path(spark, "negatives")
    spark.createDataFrame([], MINED).write.parquet(path)
    for b in range(blocks):
        own = anchors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()       # about ``block`` vectors
        if not own.num_rows:
            continue
        trees = spanning_trees(own)
        best = best_positives(rows, trees, positives).toArrow()                                 # at most ``positives`` an anchor
        mined = best_negatives(rows, trees, best, negatives, window)
        mined.write.mode("append").parquet(path)
    return spark.read.schema(MINED).parquet(path)


# ---- trees ---------------------------------------------------------------------

class Tree:
    """Anchors of one length in the order of their depth, each with its parent and the distance to it."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order, parent, far = minimum_spanning(x.astype(float))
        depth = np.zeros(len(x), np.int64)
        for i in order[1:].tolist():
            depth[i] = depth[parent[i]] + 1
        by = np.argsort(depth, kind="stable")
        place = np.empty(len(x), np.int64)
        place[by] = np.arange(len(x))
        self.ids, self.labels, self.x = ids[by], labels[by], x[by]
        self.parent = place[parent[by]]
        self.far = far[by] * (1 + 1e-9)
        self.levels = np.searchsorted(depth[by], np.arange(depth.max() + 2))
        self.norm = np.sqrt((self.x.astype(float) ** 2).sum(1))


def minimum_spanning(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of joining, parent, distance to the parent) of the rows' minimum spanning tree, from row 0."""
    n = len(x)
    near, parent, far = np.full(n, np.inf), np.zeros(n, np.int64), np.zeros(n)
    out = np.zeros(n, bool)
    order, at = [0], 0
    out[0] = True
    for _ in range(n - 1):
        d = np.sqrt(((x - x[at]) ** 2).sum(1))
        closer = (d < near) & ~out
        near[closer], parent[closer] = d[closer], at
        at = int(np.where(out, np.inf, near).argmin())
        out[at] = True
        far[at] = near[at]
        order.append(at)
    return np.array(order), parent, far


def spanning_trees(own: pa.Table) -> list[Tree]:
    """A tree of the anchors of each vector length, rows by id so that a rerun agrees."""
    own = own.sort_by("vec_id")
    ids, labels = own["vec_id"].to_numpy(), own["label"].to_numpy()
    return [Tree(ids[at], labels[at], x) for at, x in by_length(own["c"].combine_chunks())]


def by_length(col: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the lists of each length."""
    sizes = np.asarray(col.value_lengths(), np.int64)
    flat = col.flatten().to_numpy()
    starts = np.cumsum(sizes) - sizes
    return [(at, flat[starts[at][:, None] + np.arange(k)]) for k in np.unique(sizes).tolist()
            for at in [np.flatnonzero(sizes == k)]]


# ---- bounds ----------------------------------------------------------------------

class Rows:
    """Some rows of one length, ready to be scored."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.norm = np.sqrt((x.astype(float) ** 2).sum(1))

    def scores(self, tree: Tree, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Exact scores of anchors ``i`` and rows ``j``; sums of longs wrap around, but the score fits."""
        out = np.empty(len(i), np.int64)
        for lo in range(0, len(i), PAIRS):
            at = slice(lo, lo + PAIRS)
            out[at] = np.einsum("ij,ij->i", tree.x[i[at]], self.x[j[at]])
        return out


def rescored(tree: Tree, rows: Rows, wanted):
    """Yields (anchor numbers, row numbers, scores), level after level of the tree.

    ``wanted(anchors, low, high)`` tells which rows of a level's anchors are to be scored,
    given intervals that hold their scores.
    """
    low = high = None       # of the level above
    first = 0
    for lo, hi in zip(tree.levels[:-1].tolist(), tree.levels[1:].tolist()):
        some = slice(lo, hi)
        whole = tree.norm[some, None] * rows.norm * (1 + 1e-9) + 1
        if low is None:
            a, b = -whole, whole
        else:
            up = tree.parent[some] - first
            reach = tree.far[some, None] * rows.norm + 1 + 1e-9 * whole
            a, b = np.maximum(low[up] - reach, -whole), np.minimum(high[up] + reach, whole)
        need = np.ones(a.shape, bool) if low is None else wanted(some, a, b)
        i, j = np.nonzero(need)
        s = rows.scores(tree, i + lo, j)
        a[i, j] = b[i, j] = s
        low, high, first = a, b, lo
        yield i + lo, j, s


class Best:
    """The best few (score, id) of numbered slots; ties go to the smaller id."""

    def __init__(self, slots: int, k: int):
        self.k, self.least = k, np.full(slots, -np.inf)
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.zeros(len(self.least), bool)
        touched[slot] = True
        old = touched[self.slot]
        slot, score, ids = (np.concatenate(p) for p in ((self.slot[old], slot), (self.score[old], score), (self.id[old], ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        full = rank == self.k - 1
        self.least[slot[full]] = score[full].astype(float) * (1 - 1e-15 * np.sign(score[full])) - 1       # below it by rounding at most
        keep = rank < self.k
        self.slot, self.score, self.id = (np.concatenate(p) for p in (
            (self.slot[~old], slot[keep]), (self.score[~old], score[keep]), (self.id[~old], ids[keep])))


def row_blocks(batch: pa.RecordBatch):
    """The rows of a batch of (vec_id, label, c), ``ROWS`` of one length at a time."""
    ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
    for at, x in by_length(batch.column("c")):
        for lo in range(0, len(at), ROWS):
            some = at[lo:lo + ROWS]
            yield Rows(ids[some], labels[some], x[lo:lo + ROWS])


# ---- passes ------------------------------------------------------------------------

def best_positives(rows: DataFrame, trees: list[Tree], k: int) -> DataFrame:
    """(anchor_id, positive_id, score): the best ``k`` other rows of each anchor's label."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)       # one block of anchors
    types = arrow_types("anchor_id long, positive_id long, score long")

    def run(batches):
        trees = {t.x.shape[1]: (t, Best(len(t.ids), k)) for t in shared.value}
        for batch in batches:
            for some in row_blocks(batch):
                if some.x.shape[1] not in trees:
                    continue
                tree, best = trees[some.x.shape[1]]

                def wanted(at, low, high):
                    return (tree.labels[at, None] == some.labels) & (high >= best.least[at, None])

                for i, j, s in rescored(tree, some, wanted):
                    ok = (tree.labels[i] == some.labels[j]) & (tree.ids[i] != some.ids[j]) & (s >= best.least[i])
                    best.add(i[ok], s[ok], some.ids[j[ok]])
        for tree, best in trees.values():
            yield record({"anchor_id": tree.ids[best.slot], "positive_id": best.id, "score": best.score}, types)

    found = rows.mapInArrow(run, "anchor_id long, positive_id long, score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    return found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).drop("r")


def windows_of(tree: Tree, best: pa.Table, window: tuple[int, int]) -> tuple[np.ndarray, ...]:
    """(anchor number, positive_id, positive score, least, most) of the positives of a tree's anchors."""
    place = {a: i for i, a in enumerate(tree.ids.tolist())}
    out = []
    for a, p, s in zip(best["anchor_id"].to_pylist(), best["positive_id"].to_pylist(), best["score"].to_pylist()):
        low, high = -(-window[0] * s // 100), window[1] * s // 100
        if a in place and low <= high:
            out.append((place[a], p, s, low, high))
    out.sort()
    cols = np.array(out, np.int64).reshape(len(out), 5)
    return tuple(cols[:, c] for c in range(5))


def best_negatives(rows: DataFrame, trees: list[Tree], best: pa.Table, k: int, window: tuple[int, int]) -> DataFrame:
    """For each positive the best ``k`` rows of other labels with scores in its window."""
    shared = rows.sparkSession.sparkContext.broadcast([(t, windows_of(t, best, window)) for t in trees])
    schema = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    types = arrow_types(schema)

    def run(batches):
        trees = {t.x.shape[1]: (t, w, layers(w[0]), Best(len(w[0]), k)) for t, w in shared.value}
        for batch in batches:
            for some in row_blocks(batch):
                if some.x.shape[1] not in trees:
                    continue
                tree, (anchor, _, _, least, most), rounds, best = trees[some.x.shape[1]]
                slots = np.full((len(rounds), len(tree.ids)), -1)       # the slots of an anchor, one a round
                for r, slot in enumerate(rounds):
                    slots[r, anchor[slot]] = slot

                def wanted(at, low, high):
                    need = np.zeros(low.shape, bool)
                    for slot in slots[:, at]:
                        reach = np.where(slot < 0, np.inf, np.maximum(least[slot] * 1.0, best.least[slot]))
                        top = np.where(slot < 0, -np.inf, most[slot] * 1.0)
                        need |= (high >= reach[:, None] - 1) & (low <= top[:, None] + 1)
                    return need & (tree.labels[at, None] != some.labels)

                for i, j, s in rescored(tree, some, wanted):
                    other = tree.labels[i] != some.labels[j]
                    i, j, s = i[other], j[other], s[other]
                    for row in slots:
                        slot = row[i]
                        ok = (slot >= 0) & (s >= least[slot]) & (s <= most[slot]) & (s >= best.least[slot])
                        best.add(slot[ok], s[ok], some.ids[j[ok]])
        for tree, (anchor, positive, score, _, _), _, best in trees.values():
            yield record({"anchor_id": tree.ids[anchor[best.slot]], "positive_id": positive[best.slot], "negative_id": best.id,
                          "positive_score": score[best.slot], "negative_score": best.score}, types)

    found = rows.mapInArrow(run, schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def layers(anchor: np.ndarray) -> list[np.ndarray]:
    """Slots, sorted by anchor, in rounds that hold an anchor once each."""
    place = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
    return [np.flatnonzero(place == r) for r in range(int(place.max(initial=-1)) + 1)]
