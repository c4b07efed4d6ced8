"""Words of a column of texts as numpy arrays, a few megabytes of text at a time.

A word gets a 64-bit hash: the polynomial of its bytes, taken from one running sum
over the whole buffer, then mixed. Sequences of words are hashed in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
STEP = 0xD1342543DE82EF95 | 1
#: White space of the words `[^\x20\x09-\x0D]+`.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: What is not a letter or digit, all of ASCII; other characters count as letters.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1), modulo 2 ** 64; kept for the next slice unless a text is longer than slices are."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        size = -(-max(count, 1) // 65_536) * 65_536
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= SLICE_BYTES + 65_536:
            _powers[base] = have
    return have[:count]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def byte_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes of text, or one longer text."""
    offsets = offsets_of(texts)
    first, n = 0, len(texts)
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def plain(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One array of large strings without nulls (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return texts.cast(pa.large_string()).fill_null("")


def offsets_of(texts: pa.Array) -> np.ndarray:
    whole = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + texts.offset + 1) if texts.buffers()[1] else np.zeros(1, np.int64)
    return whole[texts.offset :]


class Words:
    """Words of the texts ``first`` .. ``last`` - 1: byte ranges, hashes, and where each text's words begin."""

    def __init__(self, texts: pa.Array, first: int, last: int, separators: np.ndarray = SPACE):
        at = offsets_of(texts)
        low, high = int(at[first]), int(at[last])
        buffer = texts.buffers()[2]
        self.data = np.frombuffer(buffer, np.uint8, high - low, low) if buffer and high > low else np.zeros(0, np.uint8)
        bounds = (at[first : last + 1] - low).astype(np.int64)
        word = ~separators[self.data]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        cuts = bounds[:-1][bounds[:-1] < len(word)]
        begins[cuts] |= word[cuts]  # a text's first byte begins a word
        ends = word.copy()
        ends[:-1] &= ~word[1:]
        lasts = bounds[1:][bounds[1:] > bounds[:-1]] - 1
        ends[lasts] |= word[lasts]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.start, bounds)  # words of text i: bounds[i] .. bounds[i + 1]

    def hashes(self) -> np.ndarray:
        return mix(spans(self.data, self.start, self.end, BASE))

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())


def spans(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each range, the same wherever the range lies."""
    run = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(base, len(values)), out=run[1:])
    return (run[end] - run[start]) * powers(inverse(base), len(values) + 1)[start]


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each ``size`` consecutive words of one text, and where each text's shingles begin."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    ends = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=ends[1:])
    at = np.arange(ends[-1]) + np.repeat(bounds[:-1] - ends[:-1], counts)
    return mix(spans(hashes, at, at + size, STEP)), ends
