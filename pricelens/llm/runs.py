"""Periodic runs of words in texts, and texts without their repetitions.

A run is a longest stretch of words with smallest period q (words q apart are
equal) and at least ``max(MIN_LENGTH, 2 * q)`` words.

Method: internal pattern matching over dyadic blocks.  The words of a chunk of
documents, each document closed by a mark of its own, get a suffix array by
prefix doubling; the ranks of every doubling are kept, so equal blocks of 2**k
words have one rank, whose holders are an interval of the suffix array.  A
wavelet matrix over the suffix array answers range successor queries: the next
position in an interval at or after a given one.

A run of period q holds at least 2 * q words, so for the k with 2**(k+1) - 1 <=
q <= 2**(k+2) - 2 it holds an aligned block of 2**k words together with the
block's occurrence q words on (blocks of two words serve periods up to six, as a
run has twelve words at least).  Each block asks for its occurrences in the
neighbouring windows at those distances.  A window of 2**k starts holds them as
one arithmetic progression, so the first, the second and the count tell all; each
distance is a candidate period.  Terms that lie in the block's own stretch of
the progression's step are no smallest periods and are left out together.
Candidates are extended both ways by the ranks, longest blocks first; of
equal stretches the least period stays.

Work is O(n log n) for n words; a chunk has some 512 KiB of whole documents, so
a longer document is a chunk of its own (about 100 bytes a word at its peak, and 4
for each doubling that its longest repetition needs).  There is no shuffle.

Defined results: a null text is empty, and empty texts and texts of white space
have no words and no runs; a null doc_id is left out; repeated rows are each a
document; ties are ordered by start, then period; an empty table gives no rows;
other columns are left behind.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pricelens.llm.common import arrow_map, documents
from pricelens.llm.text import Chunk, Words, chunks

MIN_LENGTH = 12
RUNS = "doc_id long, n_words long, runs array<long>, text string"


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, n_words, runs, text) of every document.

    ``runs`` holds start, length and period of each run in turn, by start, then
    period; ``text`` the words, joined by one space, that no run contains after its
    first period.
    """
    def rows(batch):
        for c in chunks(batch.column(1)):
            words = Words(c)
            start, length, period = chunk_runs(c, words, min_length)
            doc = words.doc[start] if len(start) else start
            n = np.bincount(doc, minlength=len(c))
            flat = np.stack([start - words.first[doc], length, period], 1).reshape(-1)
            yield {"doc_id": batch.column(0).slice(c.lo, len(c)), "n_words": words.count,
                   "runs": pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(3 * n)]).astype(np.int32), pa.array(flat)),
                   "text": kept_texts(c, words, repeated(len(words.start), start + period, start + length))}
    return arrow_map(documents(docs), rows, RUNS)


def repeated(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in one of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, lo, 1)
    np.add.at(edge, hi, -1)
    return np.cumsum(edge[:-1]) > 0


def kept_texts(c: Chunk, words: Words, gone: np.ndarray) -> pa.Array:
    """Each document's words that are not ``gone``, joined by one space."""
    keep = ~gone
    at = words.start[keep]
    size = words.end[keep] - at
    left = np.concatenate([[0], np.cumsum(keep)])[words.first]      # kept words before each document
    last = np.zeros(len(at), bool)
    last[left[1:][left[1:] > left[:-1]] - 1] = True
    ends = np.cumsum(size + ~last)
    begin = ends - size - ~last
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    ink = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    out[ink] = c.data[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
    offsets = np.concatenate([[0], ends])[left]
    raw = pa.Array.from_buffers(pa.large_string(), len(c), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])
    return raw.cast(pa.string())


# ---- suffixes --------------------------------------------------------------------

def doubled_ranks(seq: np.ndarray) -> list[np.ndarray]:
    """For k = 0, 1, ...: how many suffixes have a smaller prefix of 2**k.

    Equal prefixes have equal ranks; the last ranks are all distinct.  ``seq`` holds
    small numbers, and what stands last is nowhere else.
    """
    n = len(seq)
    size = np.bincount(seq)
    rank = (np.cumsum(size) - size)[seq]
    size = size[seq]
    out = [rank.astype(np.int32)]
    open_ = np.flatnonzero(size > 1)
    step = 1
    while len(open_):
        key = rank[open_] * n + rank[np.minimum(open_ + step, n - 1)]
        order = np.argsort(key, kind="stable")
        at, key = open_[order], key[order]
        old = rank[at]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        group = np.flatnonzero(new)
        first = np.searchsorted(old, old)               # where its former class begins
        each = np.diff(np.append(group, len(key)))
        fresh = old + np.repeat(group, each) - first
        rank = rank.copy()
        rank[at] = fresh
        out.append(rank.astype(np.int32))
        open_ = np.sort(at[np.repeat(each, each) > 1])
        step *= 2
    return out


class WaveletMatrix:
    """Counts and selects values in intervals of a sequence, many queries at a time."""

    def __init__(self, values: np.ndarray):
        self.levels = max(1, int(values.max(initial=0)).bit_length())
        self.zeros = []
        for bit in range(self.levels - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            z = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=z[1:])
            self.zeros.append(z)
            values = np.concatenate([values[~one], values[one]])

    def less(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values in [lo, hi) are less than x."""
        count, whole = np.zeros(len(lo), np.int64), hi - lo
        for k, z in enumerate(self.zeros):
            one = (x >> (self.levels - 1 - k) & 1).astype(bool)
            a, b = z[lo], z[hi]
            count += np.where(one, b - a, 0)
            lo, hi = np.where(one, z[-1] + lo - a, a), np.where(one, z[-1] + hi - b, b)
        return np.where(x >> self.levels > 0, whole, count)

    def pick(self, lo: np.ndarray, hi: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The value that ``nth`` others in [lo, hi) are less than."""
        value = np.zeros(len(lo), np.int64)
        for z in self.zeros:
            a, b = z[lo], z[hi]
            one = nth >= b - a
            nth = np.where(one, nth - (b - a), nth)
            lo, hi = np.where(one, z[-1] + lo - a, a), np.where(one, z[-1] + hi - b, b)
            value = value << 1 | one
        return value


def common_after(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from ``i`` on equal those from ``j`` on, i < j."""
    n = len(ranks[0])
    out = np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 2, -1, -1):
        a, b = i + out, j + out
        out += np.where((b < n) & (ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)]), 1 << k, 0)
    return out


def common_before(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words before ``i`` equal those before ``j``, i < j."""
    out = np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 2, -1, -1):
        a, b = i - out - (1 << k), j - out - (1 << k)
        out += np.where((a >= 0) & (ranks[k][np.maximum(a, 0)] == ranks[k][np.maximum(b, 0)]), 1 << k, 0)
    return out


# ---- runs -------------------------------------------------------------------------

def distances(k: int) -> list[tuple[int, int]]:
    """The windows [lo, hi) of distances that blocks of 2**k words ask, of 2**k starts each."""
    b = 1 << k
    return [(1, 3), (3, 5), (5, 7)] if k == 1 else [(2 * b - 1, 3 * b - 1), (3 * b - 1, 4 * b - 1)]


def candidates(ranks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of blocks and their occurrences in the neighbouring windows."""
    n = len(ranks[0])
    suffixes = np.empty(n, np.int64)
    suffixes[ranks[-1]] = np.arange(n)
    tree = WaveletMatrix(suffixes)
    found_i, found_d = [], []
    for k in range(1, len(ranks) - 1):
        rank = ranks[k]
        size = np.bincount(rank, minlength=n)
        i = np.arange(0, n, 1 << k)
        i = i[size[rank[i]] > 1]
        windows = distances(k)
        lo = rank[i].astype(np.int64)
        hi = lo + size[lo]
        before = tree.less(lo, hi, np.minimum(i + windows[0][0], n))
        some = tree.less(lo, hi, np.minimum(i + windows[-1][1], n)) > before
        i, lo, hi, before = i[some], lo[some], hi[some], before[some]
        for _, stop in windows:
            upto = tree.less(lo, hi, np.minimum(i + stop, n))
            count = upto - before
            any_ = np.flatnonzero(count > 0)
            a, l, h, c, at = i[any_], lo[any_], hi[any_], count[any_], before[any_]
            first = tree.pick(l, h, at)
            step = np.where(c > 1, tree.pick(l, h, np.minimum(at + 1, h - l - 1)) - first, 1)
            d = first - a
            # Three or more have the block's period as their step: skip those in its own stretch.
            many = np.flatnonzero(c > 2)
            skip = np.zeros(len(a), np.int64)
            own = step[many] + common_after(ranks, a[many], a[many] + step[many]) - (1 << k)       # the last distance in it
            skip[many] = np.clip((own - d[many]) // step[many] + 1, 0, c[many])
            each = c - skip
            term = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each) + np.repeat(skip, each)
            found_i.append(np.repeat(a, each))
            found_d.append(np.repeat(d, each) + term * np.repeat(step, each))
            before = upto
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_i, found_d))


def chunk_runs(c: Chunk, words: Words, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, starts counted in words of the chunk; by start, then period."""
    if min_length < MIN_LENGTH:
        raise ValueError(f"runs of fewer than {MIN_LENGTH} words would need smaller blocks")
    marks = len(c)
    seq = np.empty(len(words.start) + marks, np.int64)
    at = np.arange(len(words.start)) + words.doc
    seq[words.first[1:] + np.arange(marks)] = np.arange(marks)
    seq[at] = words.numbers(c.data)[0] + marks
    ranks = doubled_ranks(seq)
    i, d = candidates(ranks)
    back = common_before(ranks, i, i + d)
    start, length = i - back, back + d + common_after(ranks, i, i + d)
    good = length >= np.maximum(min_length, 2 * d)
    start, length, period = start[good], length[good], d[good]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])       # of a stretch the least period
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    marks_before = np.searchsorted(words.first[1:] + np.arange(marks), start)
    return start - marks_before, length, period
