"""Packing documents into fixed-length training sequences, in order.

Method: order-preserving dynamic programming.  The tokens of a partition's
documents form one stream, kept in row order.  Cuts may fall at document
ends (free), sentence ends (``SENTENCE_PENALTY``) or, inside a sentence, at
every ``GRAIN`` tokens (``BREAK_PENALTY``).  With P_i tokens before cut i, the
least cost of a stream cut at i is

    f(i) = penalty(i) + CAPACITY - P_i + min over P_i - P_j <= CAPACITY of f(j) + P_j

(padding plus penalties); the minimum over the sliding window is held in a
monotone queue, so each cut enters and leaves once.  The stream is solved in
blocks of ``BLOCK`` tokens; the last two windows of a block are carried into
the next, so memory does not grow with the partition.  What is left at the
end of a partition is cut into powers of two, which need no padding.

Token ids come from the tokenizer file at a path that is a parameter.  Its
pieces never span white space, so words are tokenized once and looked up
by their bytes after; of ``KNOWN_WORDS`` words those that were met once are
forgotten, at least half of them.

Nulls: a null text is empty and packs as its end id alone; a null doc_id is
left out.  Repeated rows are packed each.  An empty table gives no rows.
Very long documents run over as many sequences as they need.
"""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from pricelens.llm.common import arrow_types, documents, mapped, record
from pricelens.llm.text import Chunk, chunks, give_back, is_space, lower_ascii, numbered

CAPACITY = 4096
END_ID = 2
SENTENCE_PENALTY = 4
BREAK_PENALTY = 24
GRAIN = 64
BLOCK = 1 << 20
TEXT_BYTES = 1 << 21
#: A word that is one id, which no word without it has.
APART = b"7"
KNOWN_WORDS = 400_000
TOKENIZER = "word_bpe_49k.json"
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit
    numbers.  ``tokenizer`` names a file of the public tokenizers or is a path.
    """
    types = arrow_types(PIECES)

    def run(batches):
        known = word_table(tokenizer)
        stream = Stream(capacity, known.sentence_end, TaskContext.get().partitionId() << 40)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for c in chunks(batch.column(1), TEXT_BYTES):
                for i, tokens in enumerate(known.encode(c)):
                    stream.add(ids[c.lo + i], tokens)
                if stream.size >= BLOCK:
                    yield record(stream.take(last=False), types)
                    give_back()
        yield record(stream.take(last=True), types)

    return mapped(documents(docs), run, PIECES)


# ---- tokens ------------------------------------------------------------------

@lru_cache(maxsize=2)
def word_table(tokenizer: str) -> "WordTable":
    return WordTable(tokenizer)


class WordTable:
    """Token ids of the words met so far; one per Python worker."""

    def __init__(self, tokenizer: str):
        import public_tokenizers
        from tokenizers import Tokenizer
        path = tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        size = max(vocab.values()) + 1
        self.sentence_end = np.zeros(max(size, END_ID + 1), bool)
        for token, i in vocab.items():
            self.sentence_end[i] = token.endswith((".</w>", "!</w>", "?</w>"))
        alone = self.tok.encode(APART.decode(), add_special_tokens=False).ids
        self.apart = alone[0] if len(alone) == 1 else -1
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {b"": 0}
        self.flat = np.full(1, END_ID, np.uint32)      # entry 0: the end id
        self.at = np.zeros(1, np.int64)
        self.size = np.ones(1, np.int64)
        self.met = np.full(1, 1 << 20, np.int64)       # chunks that held the word

    def forget(self) -> None:
        """Keeps the words that most chunks held, at most half of ``KNOWN_WORDS``, and halves their counts."""
        least = max(2, int(np.partition(self.met, -KNOWN_WORDS // 2)[-KNOWN_WORDS // 2])) if len(self.met) > KNOWN_WORDS // 2 else 2
        keep = self.met >= least
        if keep.sum() > KNOWN_WORDS // 2:
            keep &= self.met > least
            keep[0] = True
        words = [w for w, k in zip(self.index, keep.tolist()) if k]
        size, at = self.size[keep], self.at[keep]
        ends = np.cumsum(size)
        self.flat = self.flat[np.repeat(at - (ends - size), size) + np.arange(ends[-1])]
        self.at, self.size, self.met = ends - size, size, self.met[keep] + 1 >> 1
        self.met[0] = 1 << 20
        self.index = dict(zip(words, range(len(words))))

    def learn(self, words: list[bytes]) -> None:
        """Tokenize new words: many at a time with ``APART`` between them, those that hold it alone."""
        easy = [w for w in words if APART not in w] if self.apart >= 0 else []
        hard = [w for w in words if APART in w] if self.apart >= 0 else words
        names, ids, sizes = [], [self.flat], [self.size]
        for lo in range(0, len(easy), 20_000):
            group = [easy[a:a + 200] for a in range(lo, min(lo + 20_000, len(easy)), 200)]
            lines = [(b" %b " % APART).join(g).decode() for g in group]
            for part, enc in zip(group, self.tok.encode_batch_fast(lines, add_special_tokens=False)):
                got = np.array(enc.ids, np.uint32)
                cut = np.flatnonzero(got == self.apart)
                if len(cut) != len(part) - 1:
                    hard = hard + part
                    continue
                names += part
                ids.append(got[got != self.apart])
                sizes.append(np.diff(np.concatenate([[-1], cut, [len(got)]])) - 1)
        for lo in range(0, len(hard), 20_000):
            part = hard[lo:lo + 20_000]
            found = [enc.ids for enc in self.tok.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)]
            names += part
            ids.append(np.array([i for x in found for i in x], np.uint32))
            sizes.append(np.array([len(x) for x in found], np.int64))
        self.index.update(zip(names, range(len(self.size), len(self.size) + len(names))))
        self.flat, self.size = np.concatenate(ids), np.concatenate(sizes)
        self.at = np.cumsum(self.size) - self.size
        self.met = np.concatenate([self.met, np.zeros(len(names), np.int64)])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The numbers of words, -1 for unknown ones."""
        return np.fromiter(map(self.index.get, words, itertools.repeat(-1)), np.int64, len(words))

    def encode(self, c: Chunk) -> list[np.ndarray]:
        """Token ids of every document of a chunk, the end id included."""
        data = lower_ascii(c.data)      # the tokenizer lower-cases too
        start, end, first = spans(data, c.offsets)
        back, uniq = numbered(data, start, end)
        if len(self.index) + len(uniq) > KNOWN_WORDS:
            self.forget()
        ends, letters = uniq.buffers()[1:]
        letters, ends = letters.to_pybytes(), np.frombuffer(ends, np.int64)[:len(uniq) + 1].tolist()
        held = [letters[a:b] for a, b in zip(ends[:-1], ends[1:])]
        number = self.numbers(held)
        new = np.flatnonzero(number < 0).tolist()
        if new:
            self.learn([held[k] for k in new])
            number[new] = self.numbers([held[k] for k in new])
        self.met[number] += 1
        words = np.insert(number[back], first[1:], 0)
        size = self.size[words]
        cut = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.at[words] - cut[:-1], size) + np.arange(cut[-1])]
        bounds = cut[first + np.arange(len(first))]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of lower-cased documents, a full stop or comma after a plain
    letter and before white space apart (the tokenizer parts them there too)."""
    n = len(data)
    space = is_space(data)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    first, last = ~space, ~space
    if n:
        cut = (data == 46) | (data == 44)
        cut[1:] &= (data[:-1] >= 97) & (data[:-1] <= 122) & ~edge[1:n]
        cut[0] = False
        cut[:-1] &= space[1:] | edge[1:n]
        first[1:] &= space[:-1] | edge[1:n] | cut[1:]
        last[:-1] &= space[1:] | edge[1:n] | cut[1:]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, offs)


# ---- cuts --------------------------------------------------------------------

class Stream:
    """The documents of a partition that are not yet packed."""

    def __init__(self, capacity: int, sentence_end: np.ndarray, sequence_id: int):
        self.capacity, self.sentence_end, self.next = capacity, sentence_end, sequence_id
        self.docs: list[tuple[int, np.ndarray]] = []
        self.skip = self.size = 0      # tokens of docs[0] that are packed; tokens waiting

    def add(self, doc_id: int, tokens: np.ndarray) -> None:
        self.docs.append((doc_id, tokens))
        self.size += len(tokens)

    def take(self, last: bool) -> dict:
        """Pieces of the sequences that are settled."""
        out: dict = {k: [] for k in arrow_types(PIECES)}
        if not self.size:
            return out
        ids = np.concatenate([t for _, t in self.docs])[self.skip:]
        ends = np.cumsum([len(t) for _, t in self.docs]) - self.skip
        price = np.full(len(ids) + 1, -1, np.int64)
        price[GRAIN::GRAIN] = BREAK_PENALTY
        price[1:][self.sentence_end[ids]] = SENTENCE_PENALTY
        price[ends] = 0
        price[0] = -1
        at = np.flatnonzero(price >= 0)
        cuts = best_cuts(at, price[at], self.capacity)
        if last:
            cuts = cuts[:-1] + [cuts[-2] + x for x in powers_of_two(cuts[-1] - cuts[-2], self.capacity)]
        else:
            cuts = cuts[:-2]
        k, a = 0, 0
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            offset = 0
            while lo < hi:
                while ends[k] <= lo:
                    k += 1
                doc_id, tokens = self.docs[k]
                stop = min(hi, int(ends[k]))
                start = len(tokens) - (int(ends[k]) - lo)
                for name, v in zip(out, (doc_id, start, stop - lo, ids[lo:stop].tobytes(), len(tokens),
                                         self.next, offset)):
                    out[name].append(v)
                offset += stop - lo
                lo = stop
            self.next += 1
            a = hi
        left = int(np.searchsorted(ends, a, side="right"))
        self.skip = len(self.docs[left][1]) - (int(ends[left]) - a) if left < len(self.docs) else 0
        self.docs = self.docs[left:]
        self.size -= a
        return out


def best_cuts(at: np.ndarray, price: np.ndarray, capacity: int) -> list[int]:
    """Cuts of least total padding and penalty, from 0 to the last of ``at``.

    ``at`` rises, with steps of at most ``capacity``.  ``queue`` holds cuts by
    rising f(j) + P_j; its head is the best cut within reach.
    """
    pos = [0, *at.tolist()]
    cost = [0, *price.tolist()]
    came = [0] * len(pos)
    queue, worth = [0] * (len(pos) + 1), [0] * (len(pos) + 1)
    head, tail = 0, 1
    for i in range(1, len(pos)):
        reach = pos[i] - capacity
        while pos[queue[head]] < reach:
            head += 1
        came[i] = queue[head]
        w = worth[head] + capacity + cost[i]      # f(i) + P_i
        while tail > head and worth[tail - 1] >= w:
            tail -= 1
        queue[tail] = i
        worth[tail] = w
        tail += 1
    cuts, i = [], len(pos) - 1
    while i:
        cuts.append(pos[i])
        i = came[i]
    return [0, *reversed(cuts)]


def powers_of_two(n: int, capacity: int) -> list[int]:
    """Ends of the cuts of n <= capacity tokens into falling powers of two."""
    if n == capacity:
        return [n]
    out, done = [], 0
    for bit in range(n.bit_length() - 1, -1, -1):
        if n >> bit & 1:
            done += 1 << bit
            out.append(done)
    return out
