"""Exact Jaccard self-join of documents on word shingles.

Method: universe-partition pigeonhole.  Sets fall into size bands (powers of
two); a band parts the universe of shingle hashes into segments.  Two sets at
similarity >= t differ in at most H = floor((1-t)/(1+t) * (r+s)) shingles, so of
any H+1 segments in which one of them has shingles, in at least one both have
the same subset.  Allocation by cost: the segments of a band have an order, by how
many pairs of sets share a subset there, counted over all documents with different sets
(:func:`allocation`).  A set of size n signs only the
first H+1 segments of that order in which it has shingles at all, H being the most it can
differ from a partner; both sets of a pair sign the segments up to where the lesser one
stops, so a shared signature is certain in whatever order, with as few signatures as the bound
allows and with what many documents share signed last.  Bands of sets of ``1 << ALLOCATED`` shingles
and more keep their segments in the order of the hashes.  A pair belongs to the band of its smaller set, so a set just above a
band's edge signs in the band below, too.  A set with too few filled segments
for that (small ones) also signs the one-deletion neighbourhood of every
segment: then a segment that differs by one shingle is a match and half as
many suffice; one with too few even for that also signs every shingle.  Two
sets that both need the extra signatures both have them.

Nothing is capped.  Candidates are then cut by exact bounds only (sizes, and the
parity bits of hashed shingles, over twice as many as the set is large: differing bits
never exceed differing shingles)
and verified on whole texts.

No group is expanded into pairs first: in a group with one signature everyone
is held against its least member, the hub.  Verified links give components.  Any two
that share a signature share its hub and band, so the groups of a hub and a band
are one for the rest: only where it still holds several components are its documents
compared, across components only, by bounds alone and in tiles of at most 2 * ``TILE``
documents, so a passage that very many documents share is many tasks' work, is looked at
once and not once for each of its signatures, and makes no rows for pairs that
the bounds rule out.  Documents with equal sets are one class throughout.  The
sorted signatures stream through their tasks; no group is gathered.

Defined results: null and empty texts, and texts of white space, have no shingles and link
with nothing, not even with each other; a text of fewer than five words is
one shingle; a null doc_id is left out; rows that repeat a doc_id are one
document (the greatest packed text stands); an empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import arrow_map, arrow_types, broadcast_bytes, components, discard, documents, mapped, packed, record, release, written
from pricelens.llm.text import Words, chunks, lower_ascii, mix, shingle_places, shingles, signed, unpack

SHINGLE = 5
PERCENT = 80
TILE = 1024
BANDS = 64
VERIFY_BYTES = 1 << 20
#: A bound for trials on the documents that the allocation is counted over; without one, over all ...
SAMPLE: int | None = None
#: ... for the bands up to this one: at most 0.68 * 2**ALLOCATED + 4 * ALLOCATED numbers go to the tasks.
ALLOCATED = 13
META = "doc_id long, n long, f1 long, f2 long, bits binary"


def chunk_shingles(c, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash) of a chunk's distinct shingles, and each document's count."""
    words = Words(c)
    doc, h = shingles(words, words.hashes(lower_ascii(c.data), 1), n)
    return doc, h, np.bincount(doc, minlength=len(c))


def most_different(r, s, percent: int = PERCENT):
    """The most shingles by which sets of sizes r and s at the similarity can differ."""
    return (r + s) * (100 - percent) // (100 + percent)


def bitmap_width(n: np.ndarray) -> np.ndarray:
    """Parity bits of sets of sizes n: a power of two, at least 256 and over 2 * n."""
    return 256 << np.maximum(0, np.ceil(np.log2(2 * np.maximum(n, 1) + 1)).astype(np.int64) - 8)


def differing(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """How many bits differ in pairs of parity bitmaps; the wider is folded to the other's width."""
    out = np.zeros(len(a), np.int64)
    la, lb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    for x, y in {*zip(la.tolist(), lb.tolist())}:
        at = np.flatnonzero((la == x) & (lb == y))
        m = [np.frombuffer(b"".join([side[i] for i in at.tolist()]), np.uint64).reshape(len(at), -1) for side in (a, b)]
        out[at] = np.bitwise_count(fold(m[0], min(x, y) // 8) ^ fold(m[1], min(x, y) // 8)).sum(1, dtype=np.int64)
    return out


def fold(m: np.ndarray, words: int) -> np.ndarray:
    while m.shape[1] > words:
        m = m[:, :m.shape[1] // 2] ^ m[:, m.shape[1] // 2:]
    return m


# ---- sets ----------------------------------------------------------------------

def set_hashes(h: np.ndarray, n: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each set; its n hashes lie together in ``h``."""
    run = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h ^ np.uint64(seed)), out=run[1:])
    ends = np.cumsum(n)
    return mix(run[ends] - run[ends - n])


def describe(docs: DataFrame) -> DataFrame:
    """One row per document: size, 128-bit set hash, parity bitmap."""
    def rows(batch):
        for c in chunks(batch.column(1)):
            doc, h, n = chunk_shingles(c)
            out = {"doc_id": batch.column(0).slice(c.lo, len(c)), "n": n}
            for name, seed in (("f1", 0x1234567), ("f2", 0x89ABCDE)):
                out[name] = signed(set_hashes(h, n, seed))
            width = bitmap_width(n)
            base = np.concatenate([[0], np.cumsum(width)])
            at = base[doc] + (h & (width[doc] - 1).astype(np.uint64)).astype(np.int64)
            raw = np.packbits((np.bincount(at, minlength=base[-1]) & 1).astype(bool)).tobytes()
            cuts = (base // 8).tolist()
            yield out | {"bits": [raw[i:j] for i, j in zip(cuts[:-1], cuts[1:])]}
    return arrow_map(docs, rows, META)


# ---- signatures -----------------------------------------------------------------

@lru_cache(maxsize=1)
def segments_of_bands() -> np.ndarray:
    """Segments of band t (sizes 2**t up to 2**(t+1)): some more than the most differences, so
    that enough of them are filled."""
    return np.array([max(1, -(-68 * 2 ** t // 100) + 4) for t in range(BANDS // 2)], np.int64)


def cost_order(counts: list[tuple[int, int, int]]) -> list[np.ndarray]:
    """The place of each segment in the order of its band, cheapest first, from (band, segment, cost)
    of those that cost anything; of equal ones the lower number comes first."""
    costs = [np.zeros(m, np.float64) for m in segments_of_bands()[:ALLOCATED]]
    for band, seg, cost in counts:
        costs[band][seg] = cost
    return [np.argsort(np.argsort(c, kind="stable"), kind="stable") for c in costs]


def allocation(docs: DataFrame, reps: DataFrame, percent: int = PERCENT) -> list[np.ndarray]:
    """The order of the segments of each band: by the pairs of documents that have the same subset there.

    Counted over all representatives ``reps``; only the order depends on it, no result does.  The lowest bits of
    a subset's name tell its band and segment.
    """
    some = reps.select("doc_id")
    if SAMPLE and (n := reps.count()) > SAMPLE:
        some = some.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(SAMPLE / n * (1 << 40)))
    first = np.concatenate([[0], np.cumsum(segments_of_bands()[:ALLOCATED])])
    places = 1 << int(first[-1]).bit_length()

    def rows(batch):
        for c in chunks(batch.column(1)):
            doc, h, n = chunk_shingles(c)
            for band, differ, which in bands_of(n, percent):
                which = which & (differ > 0) & (band < ALLOCATED)
                part = doc[which[doc]]
                rdoc, rseg, _, total = filled_segments(part, h[which[doc]], band)
                place = (first[band[rdoc]] + rseg).astype(np.uint64)
                yield {"subset": signed(mix(total ^ mix(place)) & ~np.uint64(places - 1) | place)}
    subsets = arrow_map(docs.select("doc_id", "text").join(some, "doc_id", "left_semi"), rows, "subset long")
    costs = subsets.groupBy("subset").count().filter("count > 1") \
        .groupBy(F.expr(f"subset & {places - 1}").alias("place")).agg(F.sum(F.expr("count * (count - 1)")).alias("cost"))
    out = []
    for place, cost in costs.collect():     # one row a segment of an allocated band
        band = int(np.searchsorted(first, place, "right")) - 1
        out.append((band, place - int(first[band]), cost))
    release(docs)
    return cost_order(out)


def bands_of(n: np.ndarray, percent: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(band, most differences, whether it signs there) of sets of sizes n: in their own band, and
    in the band below, as the larger set of a pair."""
    band = np.zeros(len(n), np.int64)
    band[n > 0] = np.floor(np.log2(n[n > 0])).astype(np.int64)
    edge = 1 << band
    below = (n > 0) & (-(-n * percent // 100) < edge) & (band > 0)
    return [(band, most_different(n, n * 100 // percent, percent), n > 0),
            (band - 1, most_different(n, edge - 1, percent), below)]


def filled_segments(doc: np.ndarray, h: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, segment, first row, hash of the subset) of the segments that documents, sorted with
    their shingles, fill in a ``band`` each."""
    m = segments_of_bands()[band[doc]].astype(np.uint64)
    seg = ((h >> np.uint64(32)) * m >> np.uint64(32)).astype(np.int64)      # rises with the hash
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (seg[1:] != seg[:-1])
    start = np.flatnonzero(new)
    total = np.add.reduceat(mix(h), start) if len(start) else np.zeros(0, np.uint64)
    return doc[start], seg[start], start, total


def sign(doc: np.ndarray, h: np.ndarray, n: np.ndarray, percent: int,
         order: list[np.ndarray] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(document, signature) of a chunk's sets; the lowest bits of a signature are its band.

    ``order`` has the places of a band's segments; a band without one goes by number.
    """
    out = [_sign_in_band(doc, h, band, differ, which, order) for band, differ, which in bands_of(n, percent)]
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _sign_in_band(doc, h, band, differ, which, order) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the documents ``which`` in a band each.

    Sets that can differ in nothing are equal; their class is known already.
    """
    which = which & (differ > 0)
    keep = which[doc]
    doc, h = doc[keep], h[keep]
    if not len(doc):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    rdoc, rseg, start, total = filled_segments(doc, h, band)
    each = mix(h)
    first = np.searchsorted(rdoc, np.arange(len(band) + 1))
    filled = np.diff(first)
    rank = rseg.copy()
    for t in np.unique(band[rdoc]).tolist():
        if t < len(order):
            at = np.flatnonzero(band[rdoc] == t)
            rank[at] = order[t][rseg[at]]
    place = np.empty(len(start), np.int64)
    place[np.lexsort((rank, rdoc))] = np.arange(len(start)) - first[rdoc]
    salt = mix((rseg.astype(np.uint64) << np.uint64(8)) + band[rdoc].astype(np.uint64) + np.uint64(1))
    plain = place <= differ[rdoc]
    docs, sigs = [rdoc[plain]], [mix(total[plain] + salt[plain])]
    short = filled <= differ                  # cannot sign one more segment than they can differ in
    some = short[rdoc]
    if some.any():
        tag = np.uint64(0xD1)
        docs.append(rdoc[some])
        sigs.append(mix(total[some] + salt[some] ^ tag))
        size = np.diff(np.append(start, len(doc)))
        run = np.repeat(np.arange(len(start)), size)
        gone = some[run] & (size[run] > 1)
        docs.append(rdoc[run[gone]])
        sigs.append(mix(total[run[gone]] - each[gone] + salt[run[gone]] ^ tag))
        # fewer filled segments than half the differences: every shingle
        single = (filled <= differ // 2)[doc]
        docs.append(doc[single])
        sigs.append(mix(h[single] ^ np.uint64(0x5151) + band[doc[single]].astype(np.uint64)))
    docs, sigs = np.concatenate(docs), np.concatenate(sigs)
    return docs, sigs & ~np.uint64(BANDS - 1) | band[docs].astype(np.uint64)


def signatures(docs: DataFrame, percent: int = PERCENT, order: list[np.ndarray] = ()) -> DataFrame:
    """(sig, doc_id) of every document, but for one of a chunk that has the set of a lesser one there."""
    def rows(batch):
        ids = batch.column(0).to_numpy()
        for c in chunks(batch.column(1)):
            doc, h, n = chunk_shingles(c)
            total = set_hashes(h, n, 0x1234567)
            alike = np.lexsort((ids[c.lo:c.hi], n, total))
            again = np.zeros(len(n), bool)
            again[alike[1:]] = (total[alike[1:]] == total[alike[:-1]]) & (n[alike[1:]] == n[alike[:-1]])
            doc, h = doc[~again[doc]], h[~again[doc]]
            doc, sig = sign(doc, h, np.where(again, 0, n), percent, order)
            yield {"sig": signed(sig), "doc_id": ids[c.lo + doc]}
    return arrow_map(docs, rows, "sig long, doc_id long")


def shared(sigs: DataFrame) -> DataFrame:
    """(sig, doc_id, hub): the rows of signatures that several documents have, but for the hub, the least of them."""
    def run(batches):
        held = None         # signature and hub of the last row seen
        for batch in batches:
            sig, doc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(sig):
                continue
            if held is not None:
                sig, doc = np.append(held[0], sig), np.append(held[1], doc)
            new = np.ones(len(sig), bool)
            new[1:] = sig[1:] != sig[:-1]
            hub = doc[new][np.cumsum(new) - 1]
            held = (sig[-1], hub[-1])
            keep = doc != hub
            yield record({"sig": sig[keep], "doc_id": doc[keep], "hub": hub[keep]}, types)
    types = arrow_types("sig long, doc_id long, hub long")
    return mapped(sigs.repartition("sig").sortWithinPartitions("sig", "doc_id"), run, "sig long, doc_id long, hub long")


# ---- links ----------------------------------------------------------------------

def possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and parity bitmaps do not rule out."""
    types = arrow_types("a long, b long")
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("doc_id").alias(side), F.col("n").alias(f"{side}_n"), F.col("bits").alias(f"{side}_bits")), side)
    pairs = pairs.filter(f"100 * least(a_n, b_n) >= {percent} * greatest(a_n, b_n)")

    def run(batches):
        for batch in batches:
            differ = differing(batch.column("a_bits").to_pylist(), batch.column("b_bits").to_pylist())
            fit = pa.array(differ <= most_different(batch.column("a_n").to_numpy(), batch.column("b_n").to_numpy(), percent))
            yield record({"a": batch.column("a").filter(fit), "b": batch.column("b").filter(fit)}, types)
    return mapped(pairs.select("a", "b", "a_n", "b_n", "a_bits", "b_bits"), run, "a long, b long")


class Sets:
    """The shingles of some texts, comparable by their words."""

    def __init__(self, texts: list[bytes]):
        c = next(chunks(pa.array(texts, pa.large_binary()), size=1 << 60, most=1 << 60))
        self.words, data = Words(c), lower_ascii(c.data)
        self.number = self.words.numbers(data)[0]
        doc, self.h, self.at = shingle_places(self.words, self.words.hashes(data, 1), SHINGLE)
        self.cuts = np.searchsorted(doc, np.arange(len(texts) + 1))

    def common(self, i: int, j: int) -> tuple[int, int]:
        """(shingles that texts i and j share, shingles that either has): hashes find them, words decide."""
        a, b = slice(*self.cuts[i:i + 2]), slice(*self.cuts[j:j + 2])
        x, y = np.intersect1d(self.h[a], self.h[b], assume_unique=True, return_indices=True)[1:]
        x, y = self.at[a][x], self.at[b][y]
        wide, other = (min(SHINGLE, int(self.words.count[k])) for k in (i, j))
        same = np.full(len(x), wide == other)
        for k in range(wide if wide == other else 0):
            same &= self.number[x + k] == self.number[y + k]
        both = int(same.sum())
        return both, a.stop - a.start + b.stop - b.start - both


def verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The written pairs (a, b) whose whole texts have the similarity, by their words.

    Only texts that pairs name travel, packed; some pairs at a time are compared, with texts
    of ``VERIFY_BYTES``, or one pair of longer ones.
    """
    types = arrow_types("a long, b long")
    need = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "compared")
    # A few ids go to the texts; else packed texts and ids meet by doc_id.
    if 8 * need.count() <= broadcast_bytes(docs):
        texts = packed(docs.join(F.broadcast(need), "doc_id", "left_semi"))
    else:
        texts = packed(docs).join(need, "doc_id", "left_semi")

    def run(batches):
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            za, zb = batch.column("za"), batch.column("zb")
            lo = 0
            while lo < len(a):
                place: dict = {}
                raw: list = []
                size, hi = 0, lo
                while hi < len(a) and (hi == lo or size < VERIFY_BYTES):
                    for i, z in ((a[hi], za), (b[hi], zb)):
                        if i not in place:
                            place[i] = len(raw)
                            raw.append(unpack(z[hi].as_py()))
                            size += len(raw[-1])
                    hi += 1
                sets = Sets(raw)
                found = [sets.common(place[i], place[j]) for i, j in zip(a[lo:hi], b[lo:hi])]
                ok = np.array([both > 0 and 100 * both >= percent * either for both, either in found])
                yield record({"a": np.array(a[lo:hi])[ok], "b": np.array(b[lo:hi])[ok]}, types)
                lo = hi

    both = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("z").alias("zb")), "b") \
        .join(texts.select(F.col("doc_id").alias("a"), F.col("z").alias("za")), "a")
    links = written(mapped(both.select("a", "b", "za", "zb"), run, "a long, b long"), "jaccard-links")
    discard(need)
    release(docs)
    return links


def open_groups(groups: DataFrame, reps: DataFrame, found: DataFrame) -> DataFrame:
    """(key, size, doc_id, component, n, bits): the documents of a hub and band, where they are of several
    components; the hub is not among them, for all have been held against it."""
    own = reps.select("doc_id").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left") \
        .select("doc_id", F.coalesce("component", "doc_id").alias("component"))
    member = written(groups.select(F.xxhash64("hub", "band").alias("key"), "doc_id").join(own, "doc_id"), "members")
    several = member.groupBy("key").agg(F.count("*").alias("size"), F.min("component").alias("least"),
                                        F.max("component").alias("most")).filter("least < most").select("key", "size")
    several = written(several, "open-groups")       # with both sides read, a group of very many is split
    return member.join(several, "key").join(reps.select("doc_id", "n", "bits"), "doc_id")


def across(rows: DataFrame, tested: DataFrame, percent: int, every: bool = True) -> DataFrame:
    """(a, b): pairs of a key's documents in different components that bounds do not rule out
    and that are not among the pairs ``tested`` before.

    ``rows`` come from :func:`open_groups`; a key of more than ``TILE`` rows is parted
    into blocks, and each two blocks are a tile.  Unless ``every`` pair is asked for, a document
    is paired in a tile only with the one that fits most others there.
    """
    blocks = F.ceil(F.col("size") / TILE).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), blocks).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))) \
        .select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block",
                "doc_id", "component", "n", "bits")

    def run(batches):
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            name = np.stack([batch.column(c).to_numpy() for c in ("key", "lo", "hi")])
            new = np.flatnonzero((name[:, 1:] != name[:, :-1]).any(0)) + 1
            if waiting and name[:, 0].tolist() != [waiting[-1].column(c)[-1].as_py() for c in ("key", "lo", "hi")]:
                yield from _across(waiting, percent, every)
                waiting = []
            if len(new):
                yield from _across([*waiting, batch.slice(0, int(new[-1]))], percent, every)
                waiting = [batch.slice(int(new[-1]))]
            else:
                waiting.append(batch)
        if waiting:
            yield from _across(waiting, percent, every)

    dealt = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return mapped(dealt, run, "a long, b long").distinct().join(tested, ["a", "b"], "left_anti")


def _across(parts: list[pa.RecordBatch], percent: int, every: bool):
    """The pairs of whole tiles, some rows against those after them at a time."""
    table = pa.Table.from_batches(parts)
    key, lo, hi, block, doc, component, n = (table[c].to_numpy() for c in ("key", "lo", "hi", "block", "doc_id", "component", "n"))
    bits = table["bits"].to_pylist()
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    start = np.flatnonzero(new)
    end = np.repeat(np.append(start[1:], len(key)), np.diff(np.append(start, len(key))))
    after = end - np.arange(len(key)) - 1
    total = np.concatenate([[0], np.cumsum(after)])
    at = 0
    while at < len(key):
        stop = max(at + 1, int(np.searchsorted(total, total[at] + 500_000, side="right")) - 1)
        each = after[at:stop]
        i = np.repeat(np.arange(at, stop), each)
        j = i + 1 + np.arange(len(i)) - np.repeat(total[at:stop] - total[at], each)
        ok = component[i] != component[j]
        i, j = i[ok], j[ok]
        ok = (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & ((block[i] != block[j]) | (lo[i] == hi[i]))
        i, j = i[ok], j[ok]
        fit = _differing_rows(bits, i, j) <= most_different(n[i], n[j], percent)
        i, j = i[fit], j[fit]
        if not every:
            fits = np.bincount(np.concatenate([i, j]), minlength=len(key))
            one, other = np.concatenate([i, j]), np.concatenate([j, i])
            order = np.lexsort((doc[other], -fits[other], one))
            best = order[np.unique(one[order], return_index=True)[1]]
            i, j = one[best], other[best]
        i, j = np.where(doc[i] < doc[j], i, j), np.where(doc[i] < doc[j], j, i)
        yield record({"a": doc[i], "b": doc[j]}, arrow_types("a long, b long"))
        at = stop


def _differing_rows(bits: list[bytes], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """As :func:`differing`, for pairs of row numbers."""
    rows, place = np.unique(np.concatenate([i, j]), return_inverse=True)
    some = [bits[r] for r in rows.tolist()]
    size = np.array([len(x) for x in some], np.int64)
    a, b = place[:len(i)], place[len(i):]
    out = np.zeros(len(i), np.int64)
    for x in np.unique(size).tolist():         # the narrower of the pair
        wider = np.flatnonzero(size >= x)
        row = np.full(len(rows), -1)
        row[wider] = np.arange(len(wider))
        m = np.empty((len(wider), x // 8), np.uint64)
        for y in np.unique(size[wider]).tolist():
            k = np.flatnonzero(size[wider] == y)
            m[k] = fold(np.frombuffer(b"".join([some[w] for w in wider[k].tolist()]), np.uint64).reshape(len(k), -1), x // 8)
        at = np.flatnonzero(np.minimum(size[a], size[b]) == x)
        for lo in range(0, len(at), 20_000):
            p = at[lo:lo + 20_000]
            out[p] = np.bitwise_count(m[row[a[p]]] ^ m[row[b[p]]]).sum(1, dtype=np.int64)
    return out


def link_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    docs = documents(docs)
    first = written(describe(docs), "shingle-sets")
    sets = written(first.groupBy("doc_id").agg(F.max(F.struct("n", "f1", "f2", "bits")).alias("s"))
                   .select("doc_id", "s.*"), "shingle-sets")
    discard(first)
    classes = written(sets.filter("n > 0").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep")), "shingle-classes")
    of = written(sets.filter("n > 0").join(classes, ["f1", "f2", "n"]).select("doc_id", "rep", "n")
                 .unionByName(sets.filter("n = 0").select("doc_id", F.col("doc_id").alias("rep"), "n")), "classes-of-documents")
    named = written(classes.select(F.col("rep").alias("doc_id")), "representatives")
    reps = written(sets.join(named, "doc_id", "left_semi"), "sets-of-classes")
    discard(sets, classes)

    # Copies sign alike, so of a class only the least document is looked at.
    groups = written(shared(signatures(docs, percent, allocation(docs, reps, percent))).select("hub", F.expr(f"sig & {BANDS - 1}").alias("band"), "doc_id")
                     .distinct(), "shared-signatures")
    release(docs)
    stars = groups.select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    tested = written(possible(stars, reps, percent), "candidates")
    release(docs)
    links = verified(tested, docs, percent)

    # Those who share a hub and a band, and are of several components: everyone against the others.
    # First each against the one that fits most others, as the text does that all near copies of a group
    # were made from; that leaves few components, and few pairs across them.
    for every in (False, True):
        pairs = written(across(open_groups(groups, reps, components(links)), tested, percent, every), "candidates")
        release(docs)
        links = links.unionByName(verified(pairs, docs, percent))
        tested = tested.unionByName(pairs)
    discard(reps, groups)
    found = components(links)

    out = of.join(found, of["rep"] == found["id"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
