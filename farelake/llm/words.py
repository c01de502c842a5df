"""Words of UTF-8 texts as 64-bit hashes, whole Arrow batches at a time.

A word is a run of bytes other than space and tab to carriage return. All
work is on byte buffers, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text handled at once, in bytes; bounds the memory of a task. One longer text is a chunk of its own.
CHUNK_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

U64 = np.uint64
# Masks that keep the first bytes of a little-endian word of eight.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_STEP = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values; a bijection."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _STEP + U64(seed))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each text starts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    low, high = int(starts[0]), int(starts[-1])
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[low:high], starts - low


def chunks(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


class Words:
    """The words of a column of texts.

    ``doc`` holds the text of each word, ``bounds`` where the words of each text
    start, ``starts`` and ``ends`` the bytes of each word in ``data``.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        self.data, self.offsets = text_buffer(column)
        word = ~SPACE[self.data]
        first = word.copy()
        last = word.copy()
        if len(word):
            first[1:] &= ~word[:-1]
            last[:-1] &= ~word[1:]
            cut = self.offsets[(self.offsets > 0) & (self.offsets < len(word))]
            first[cut] = word[cut]
            last[cut - 1] = word[cut - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        if lower:
            self.data = LOWER[self.data]

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes, which are taken eight at a time."""
        lengths = self.ends - self.starts
        out = mix(lengths.astype(np.uint64) * _STEP + U64(seed))
        padded = np.concatenate((self.data, np.zeros(8, np.uint8)))
        eights = np.ndarray(len(self.data) + 1, np.uint64, padded, strides=(1,))
        left, at, rest = np.arange(len(out)), self.starts, lengths
        while len(left):
            out[left] = mix(out[left] ^ (eights[at] & FIRST[np.minimum(rest, 8)]))
            more = np.flatnonzero(rest > 8)
            left, at, rest = left[more], at[more] + 8, rest[more] - 8
        return out


def grams(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of the sequences of ``n`` neighbours in ``h``, one per start."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(h) - n + 1, np.uint64)
    for i, k in enumerate(seeds(n, seed)):
        total += h[i : len(h) - n + 1 + i] * (k | U64(1))
    return mix(total)


def grams_inside(words: Words, h: np.ndarray, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Where the sequences of ``n`` words inside one text start, and their hashes."""
    g = grams(h, n, seed)
    inside = np.flatnonzero(words.doc[: len(g)] == words.doc[n - 1 :]) if len(g) else np.zeros(0, int)
    return inside, g[inside]


def sequence_hashes(words: Words, h: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each text's whole sequence of words."""
    rank = np.arange(len(h)) - words.bounds[words.doc]
    longest = int(words.counts.max()) if len(words.counts) else 0
    terms = mix(h + U64(seed)) * _powers(longest)[rank] if len(h) else np.zeros(0, np.uint64)
    sums = np.concatenate(([U64(0)], np.cumsum(terms, dtype=np.uint64)))
    return mix(sums[words.bounds[1:]] - sums[words.bounds[:-1]] + words.counts.astype(np.uint64))
