"""Near-duplicate vectors by lattice hashing.

Method: in each of ``TABLES`` tables a random projection takes a unit vector to
eight dimensions, where it is decoded to its nearest point of the E8 lattice:
the vector's home cell.  A vector also probes the ``PROBES`` neighbouring cells
(centre plus a minimal vector of the lattice) that lie nearest to it.  Two
vectors are found by a table when they share a home, or when one probes the
other's home; pairs found are verified by their cosine in double precision.

With the values here a pair at cosine 0.95 is found with probability 0.9996,
closer pairs almost surely.  Equal vectors are one class before hashing, so
copies cost nothing.  Work in a cell is done in tiles of at most ``TILE`` home rows by ``TILE`` rows,
so a cell that holds a third of all vectors is many tasks' work and no task
gathers it.  Tiles emit no pairs: per vector a count of its links and its
least companion among those the tile connects.  A pair may meet in several
tables and cells; it is counted where it is found first, which both members'
keys tell, so the counts add up.  Links between tiles' groups are joined by
distributed connected components.

Defined results: vectors that are null, zero, or hold null or non-finite
components link with nothing and are returned with n_links 0; vectors of
different lengths never link.  A null vec_id is left out; rows that
repeat a vec_id are one vector (the greatest array stands).  Equal vectors
link.  An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import arrow_types, components, record, written

MIN_COSINE = 0.95
TABLES = 6
PROBES = 4
SCALE = 2.2
TILE = 2048
SEED = 11


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice points, doubled so that they are whole numbers."""
    def d8(v):
        r = np.rint(v)
        odd = (r.sum(1).astype(np.int64) & 1).astype(bool)
        if odd.any():
            err = v[odd] - r[odd]
            k = np.abs(err).argmax(1)
            i = np.arange(len(k))
            r[np.flatnonzero(odd), k] += np.where(err[i, k] >= 0, 1, -1)
        return r
    a, b = d8(x), d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.rint(2 * np.where(nearer[:, None], a, b)).astype(np.int64)


@lru_cache(maxsize=1)
def roots() -> np.ndarray:
    """The 240 minimal vectors of E8, doubled."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((2, -2), repeat=2):
            v = [0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [list(v) for v in itertools.product((1, -1), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out, np.int64)


@lru_cache(maxsize=8)
def projections(dim: int) -> np.ndarray:
    """(TABLES, dim, 8) with orthonormal columns, scaled."""
    rng = np.random.default_rng(SEED)
    out = []
    for _ in range(TABLES):
        q = np.linalg.qr(rng.standard_normal((dim, 8)))[0] if dim >= 8 else rng.standard_normal((dim, 8)) / 8 ** 0.5
        out.append(q * SCALE * (dim / 8) ** 0.5)
    return np.array(out)


def cell_key(points: np.ndarray, table: int, dim: int) -> np.ndarray:
    """One long for a lattice point; two points that share one only cost time."""
    k = np.full(points.shape[:-1], table + 1 + 1000 * dim, np.int64)
    for i in range(8):
        k = k * 1_000_003 + points[..., i]
    return k ^ (k >> 29)


def keys(x: np.ndarray) -> np.ndarray:
    """(rows, TABLES, 1 + PROBES): home cell, then the probed cells."""
    out = np.empty((len(x), TABLES, 1 + PROBES), np.int64)
    for t, p in enumerate(projections(x.shape[1])):
        y = x @ p
        home = decode_e8(y)
        out[:, t, 0] = cell_key(home, t, x.shape[1])
        if PROBES and len(x):
            near = np.argpartition(-((y - home / 2) @ roots().T), PROBES, axis=1)[:, :PROBES]
            out[:, t, 1:] = cell_key(home[:, None, :] + roots()[near], t, x.shape[1])
    return out


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector of (vec_id, embedding)."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")) \
        .filter("vec_id is not null").groupBy("vec_id").agg(F.max("e").alias("e"))
    usable = F.expr("size(e) > 0 and exists(e, x -> x != 0) and forall(e, x -> x is not null and not isnan(x) "
                    "and abs(x) < double('infinity'))")
    v = written(v.withColumn("e", F.when(usable, F.col("e"))), "vectors")
    classes = v.filter("e is not null").groupBy("e").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"))
    classes = written(classes, "vector-classes")
    members = v.join(classes, "e").select("vec_id", "rep", "m")

    cells = home_and_probed(classes)
    hot = cells.groupBy("cell").count().filter(F.col("count") > tile) \
        .select("cell", F.ceil(F.col("count") / tile).cast("int").alias("blocks"))
    rows = cells.join(hot, "cell", "left") \
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.coalesce("blocks", F.lit(1))).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))) \
        .select("cell", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                "block", "home", "rep", "m", "v")
    found = rows.repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi") \
        .mapInArrow(lambda it: _tiles(it, min_cosine), "rep long, links long, mate long")
    found = written(found, "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots_of = components(found.filter("mate != rep").select(F.col("rep").alias("a"), F.col("mate").alias("b")))
    per_class = links.join(roots_of, links["rep"] == roots_of["id"], "left").select("rep", "links", "component")
    out = v.select("vec_id").join(members, "vec_id", "left").join(per_class, "rep", "left")
    component = F.coalesce("component", "rep", "vec_id")
    return out.select("vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce("m", F.lit(1)) - 1).alias("n_links"),
                      component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def home_and_probed(classes: DataFrame) -> DataFrame:
    """(cell, home, rep, m, v): every class in its home and probed cells of all tables."""
    types = arrow_types("cell long, home boolean, rep long, m long, v binary")

    def run(batches):
        per = TABLES * (1 + PROBES)
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                lengths = np.diff(np.asarray(batch.column("e").offsets))
                flat = batch.column("e").flatten().to_numpy()
                starts = np.concatenate([[0], np.cumsum(lengths)])
                for dim in np.unique(lengths).tolist():
                    at = np.flatnonzero(lengths == dim)
                    x = unit(flat[starts[at][:, None] + np.arange(dim)])
                    again = np.repeat(np.arange(len(at)), per)
                    raw = pa.array([r.tobytes() for r in x], pa.binary())
                    take = pa.array(at[again])
                    yield record({"cell": keys(x).reshape(-1), "home": np.tile(np.arange(per) % (1 + PROBES) == 0, len(at)),
                                  "rep": batch.column("rep").take(take), "m": batch.column("m").take(take),
                                  "v": raw.take(pa.array(again))}, types)
    return classes.select("e", "rep", "m").mapInArrow(run, "cell long, home boolean, rep long, m long, v binary")


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _tiles(batches, min_cosine: float):
    """Streams sorted rows, one tile after another; a tile holds two blocks at most."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        ident = np.stack([batch.column(n).to_numpy() for n in ("cell", "lo", "hi")])
        new = np.flatnonzero((ident[:, 1:] != ident[:, :-1]).any(0)) + 1
        if waiting:
            last = [waiting[-1].column(n)[-1].as_py() for n in ("cell", "lo", "hi")]
            if batch.num_rows and ident[:, 0].tolist() != last:
                yield _links(waiting, min_cosine)
                waiting = []
        if len(new):
            yield _links([*waiting, batch.slice(0, int(new[-1]))], min_cosine)
            waiting = [batch.slice(int(new[-1]))]
        elif batch.num_rows:
            waiting.append(batch)
    if waiting:
        yield _links(waiting, min_cosine)


def _links(parts: list[pa.RecordBatch], min_cosine: float) -> pa.RecordBatch:
    """Links of whole tiles: per class how many vectors it links with, and a
    class that stands for those it is connected to here."""
    rows = pa.Table.from_batches(parts)
    cell, lo, hi, block, rep, m = (rows[n].to_numpy() for n in ("cell", "lo", "hi", "block", "rep", "m"))
    home = rows["home"].to_numpy(zero_copy_only=False)
    new = np.ones(len(cell), bool)
    new[1:] = (cell[1:] != cell[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(cell))
    raw = rows["v"].to_pylist()
    ia, ib = [], []
    for a, b in zip(starts.tolist(), ends.tolist()):
        if b - a > 1 and home[a:b].any():
            x = np.array([np.frombuffer(raw[k]) for k in range(a, b)])
            first = np.flatnonzero(home[a:b])
            for k in range(0, len(first), 512):
                i, j = np.nonzero(x[first[k:k + 512]] @ x.T >= min_cosine)
                i = first[k + i]
                once = np.where(home[a + j], i < j, i != j)
                once &= (block[a + i] != block[a + j]) | (lo[a + i] == hi[a + i])
                once &= rep[a + i] != rep[a + j]
                ia.append(a + i[once])
                ib.append(a + j[once])
    i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (ia, ib))
    used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    ok = np.zeros(len(i), bool)
    if len(used):
        sizes = np.array([len(raw[k]) for k in used.tolist()])
        k = np.empty((len(used), TABLES, 1 + PROBES), np.int64)
        for size in np.unique(sizes).tolist():
            some = np.flatnonzero(sizes == size)
            k[some] = keys(np.array([np.frombuffer(raw[u]) for u in used[some].tolist()]))
        for s in range(0, len(i), 200_000):
            e = slice(s, s + 200_000)
            ok[e] = _first_found(k[at[:len(i)][e]], k[at[len(i):][e]], rep[i[e]] < rep[j[e]], cell[i[e]])
    i, j = rep[i[ok]], rep[j[ok]]
    weight = dict(zip(rep.tolist(), m.tolist()))
    ids, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    a, b = at[:len(i)], at[len(i):]
    size = np.array([weight[x] for x in ids.tolist()], np.int64)
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, a, size[b])
    np.add.at(links, b, size[a])
    label = np.arange(len(ids))
    while len(ids):
        low = np.minimum(label[a], label[b])
        was = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == was).all():
            break
    return record({"rep": ids, "links": links, "mate": ids[label] if len(ids) else ids},
                  arrow_types("rep long, links long, mate long"))


def _first_found(a: np.ndarray, b: np.ndarray, a_less: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Of pairs given by their keys: is ``cell`` the place where the pair counts?

    That is, in the first table that finds it, the shared home, or the home
    of the one that the other probes (of two such, that of the lesser id).
    """
    same = a[:, :, 0] == b[:, :, 0]
    at_a = (a[:, :, :1] == b[:, :, 1:]).any(2)        # b probes a's home
    at_b = (b[:, :, :1] == a[:, :, 1:]).any(2)
    t = (same | at_a | at_b).argmax(1)
    r = np.arange(len(a))
    use_a = same[r, t] | (at_a[r, t] & (a_less | ~at_b[r, t]))
    return cell == np.where(use_a, a[r, t, 0], b[r, t, 0])
