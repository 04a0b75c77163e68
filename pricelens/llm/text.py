"""Vectorised views of text inside a task: bytes, words, rolling hashes.

A task gets Arrow batches of documents.  :func:`chunks` cuts a batch into
runs of whole documents of about ``CHUNK_BYTES`` (a longer document is a run
of its own), so the numpy temporaries stay bounded whatever the batch holds.
Nulls are empty texts.  White space is the six ASCII characters
``[\\x20\\x09-\\x0D]``; words are the maximal runs of anything else.

Words and windows of words are hashed by multilinear sums: every byte (word)
times a random number of its place, summed modulo 2**64 and finished by a mixing
step.  Two that differ, in whatever regular way, collide as random numbers do;
two seeds give two 64-bit hashes where 128 bits decide a result.  Rolling sums
of bytes (:func:`prefix`, :func:`span_hash`) are polynomials modulo 2**64, which
collide for regular texts of some hundred bytes: for short spans only, of at
most ``SPAN`` bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

CHUNK_BYTES = 1 << 19
SPAN = 100
U = np.uint64
GOLDEN = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash (the usual xor-shift-multiply finaliser)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _seeded(seed: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed * 7919 + 1))


@lru_cache(maxsize=8)
def byte_table(seed: int) -> np.ndarray:
    """A random number for each byte; any two differ in their lowest eight bits."""
    return _seeded(seed + 100, 256) & ~U(255) | np.arange(256, dtype=U)


_factors: dict[int, np.ndarray] = {}


def place_factors(seed: int, n: int) -> np.ndarray:
    """A random number for each of at least ``n`` places; a seed's table grows as it must."""
    if seed not in _factors or len(_factors[seed]) < n:
        table = _seeded(seed + 300, max(256, 1 << (int(n) - 1).bit_length()))
        if len(table) > KEPT_POWERS:
            return table
        _factors[seed] = table
    return _factors[seed]


#: Tables up to this many powers or places stay in the worker; only a longer text makes one of its own.
KEPT_POWERS = 1 << 21
_kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(seed: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, 2**bits each."""
    base = int(_seeded(seed + 200, 1)[0]) | 1
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.empty(1 << bits, U)
        p[0] = 1
        k = 1
        with np.errstate(over="ignore"):
            while k < len(p):
                p[k:2 * k] = p[:k] * U(pow(b, k, 1 << 64))
                k *= 2
        out.append(p)
    return out[0], out[1]


def powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers; a seed has one table, which grows as it must."""
    if seed not in _kept or len(_kept[seed][0]) < n:
        table = _powers(seed, max(16, int(n).bit_length()))
        if len(table[0]) > KEPT_POWERS:
            return table
        _kept[seed] = table
    return _kept[seed]


def prefix(values: np.ndarray, seed: int) -> np.ndarray:
    """Prefix sums of value * base**i, one longer than ``values``."""
    p, _ = powers(seed, len(values) + 1)
    c = np.zeros(len(values) + 1, U)
    np.cumsum(values * p[:len(values)], out=c[1:])
    return c


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of the short spans [start, end) from the prefix sums ``c``; lengths are mixed in."""
    _, inv = powers(seed, len(c))
    h = (c[end] - c[start]) * inv[start]
    return mix(h + (end - start).astype(U) * GOLDEN)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of the bytes [start, end) of each word, none empty."""
    if not len(start):
        return np.zeros(0, U)
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(int(first[-1] + size[-1])) - np.repeat(first, size)
    value = byte_table(seed)[data[np.repeat(start, size) + place]]
    value *= place_factors(seed, int(size.max()))[place]
    return mix(np.add.reduceat(value, first) + size.astype(U) * GOLDEN)


class Chunk:
    """Whole documents ``lo..hi`` of a batch as one byte array."""

    def __init__(self, lo: int, hi: int, data: np.ndarray, offsets: np.ndarray):
        self.lo, self.hi, self.data, self.offsets = lo, hi, data, offsets

    def __len__(self) -> int:
        return self.hi - self.lo

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def chunks(texts: pa.Array, size: int = CHUNK_BYTES, most: int = 4096) -> Iterator[Chunk]:
    """Runs of at most ``most`` whole documents; offsets of a chunk start at 0."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    n = len(texts)
    if not n:
        return
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    buf = texts.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, side="right")) - 1)
        hi = min(hi, lo + most)
        yield Chunk(lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
        lo = hi


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


class Words:
    """The words of a chunk: byte spans, document, place in the document."""

    def __init__(self, chunk: Chunk):
        data, offs = chunk.data, chunk.offsets
        n = len(data)
        ink = ~is_space(data)
        edge = np.zeros(n + 1, bool)
        edge[offs] = True
        first = ink.copy()
        first[1:] &= ~ink[:-1] | edge[1:n]
        last = ink
        if n:
            last = ink.copy()
            last[:-1] &= ~ink[1:] | edge[1:n]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, offs)      # of each document, and the total
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(chunk)), self.count)
        self.place = np.arange(len(self.start)) - self.first[self.doc]

    def hashes(self, data: np.ndarray, seed: int) -> np.ndarray:
        return word_hashes(data, self.start, self.end, seed)

    def numbers(self, data: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """(a number for each word, the word of each number): equal numbers are equal bytes."""
        return numbered(data, self.start, self.end)


def numbered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """As :meth:`Words.numbers`, for words [start, end) that rise and don't overlap."""
    size = end - start
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    ink = data[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])]
    raw = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(ink)])
    coded = raw.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def window_hashes(word_hash: np.ndarray, at: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hashes of the ``width`` words that start at the word numbers ``at``."""
    h = np.full(len(at), width, U) * GOLDEN
    for j, factor in enumerate(place_factors(seed + 50, width)[:width]):
        h += word_hash[at + j] * factor
    return mix(h)


def shingles(words: Words, word_hash: np.ndarray, n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every document: (document, hash), sorted by both.

    A document with fewer than ``n`` words, but at least one, has its whole
    word sequence as its only shingle.
    """
    return shingle_places(words, word_hash, n, seed)[:2]


def shingle_places(words: Words, word_hash: np.ndarray, n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`shingles`, with the word at which each shingle begins first."""
    ends = words.first[words.doc] + words.count[words.doc]
    at = np.arange(len(words.start))
    full = at + n <= ends
    short = (words.place == 0) & (words.count[words.doc] < n)
    h = np.empty(len(at), U)
    h[full] = window_hashes(word_hash, at[full], n, seed)
    for width in range(1, n):
        few = short & (words.count[words.doc] == width)
        h[few] = window_hashes(word_hash, at[few], width, seed)
    at = at[full | short]
    h, doc = h[at], words.doc[at]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new], at[order][new]


def pack(raw: bytes) -> bytes:
    """A text as it travels through shuffles: a third of Spark's own block compression."""
    return _packer().compress(raw)


def unpack(z: bytes) -> bytes:
    return _unpacker().decompress(z)


def unpacked(z: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """As :func:`chunks`, of packed texts."""
    lo = 0
    while lo < len(z):
        raw: list[bytes] = []
        room = size
        while lo + len(raw) < len(z) and (not raw or room > 0):
            raw.append(unpack(z[lo + len(raw)].as_py()))
            room -= len(raw[-1])
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        yield Chunk(lo, lo + len(raw), np.frombuffer(b"".join(raw), np.uint8), offsets)
        lo += len(raw)


@lru_cache(maxsize=1)
def _packer():
    return zstandard.ZstdCompressor(level=1)


@lru_cache(maxsize=1)
def _unpacker():
    return zstandard.ZstdDecompressor()


def give_back() -> None:
    """Hands freed memory back to the machine: Spark keeps a Python worker for later stages,
    which shouldn't find it at the peak of an earlier one."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # where the C library has it
    if trim:
        trim(0)


def signed(h: np.ndarray) -> pa.Array:
    """Unsigned 64-bit hashes as Spark's longs."""
    return pa.array(h.view(np.int64))
