"""Words of Arrow text columns as 64-bit hashes, computed on whole batches of bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text taken at a time, so that the work arrays stay in the cache.
CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xBF58476D1CE4E5B9)
_BYTE_VALUES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Byte classes of words: anything but space and tab to carriage return; or digits, letters and all beyond ASCII.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of ``x`` over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column in one array, and where each text starts and ends. Null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0] or column.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def chunks(bounds: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``limit`` bytes together; a longer text comes alone."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1)
        yield first, last
        first = last


class Words:
    """Words of the texts ``first`` to ``last``: byte places, hashes, and the words of each text."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, word_bytes: np.ndarray, lower: bool = True):
        self.data = LOWER[data] if lower else data
        self.bounds = bounds
        inside = word_bytes[self.data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        cuts = bounds[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        #: Index of the first word of each text, and one past the last.
        self.of_text = np.searchsorted(self.starts, bounds)

    def hashes(self) -> np.ndarray:
        return self.hashes_of(self.starts, self.ends)

    def hashes_of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the given ranges of bytes, which must be in order of their starts."""
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + CHUNK_BYTES)))
            base = starts[i]
            piece = self.data[base:ends[j - 1]]
            powers, inverse = _powers(len(piece))
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(_BYTE_VALUES[piece] * powers[:len(piece)], out=sums[1:])
            s, e = starts[i:j] - base, ends[i:j] - base
            out[i:j] = mixed((sums[e] - sums[s]) * inverse[s])
            i = j
        return out


_cache: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    global _cache
    if len(_cache[0]) >= n:
        return _cache
    size = max(n, 1 << 16)
    inverse = np.array([pow(int(_BASE), -1, 1 << 64)], np.uint64)[0]
    made = []
    for base in (_BASE, inverse):
        row = np.full(size, base, np.uint64)
        row[0] = 1
        made.append(np.cumprod(row, dtype=np.uint64))
    if size <= 2 * CHUNK_BYTES:
        _cache = (made[0], made[1])
    return made[0], made[1]


def windows(words: np.ndarray, of_text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside a text, and the index of the first word of each."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.zeros(n, np.uint64)
    factor = np.uint64(1)
    for j in range(size):
        factor = np.uint64((int(factor) * int(_STEP)) & (2**64 - 1))
        total += words[j:j + n] * factor
    last = np.repeat(of_text[1:], np.diff(of_text))[:n]
    at = np.flatnonzero(np.arange(n) + size <= last)
    return mixed(total[at] + np.uint64(size)), at


def shingle_sets(words: np.ndarray, of_text: np.ndarray, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words; of the whole text if it is shorter."""
    hashes, at = windows(words, of_text, size)
    cut = np.searchsorted(at, of_text)
    out = []
    for i in range(len(of_text) - 1):
        found = hashes[cut[i]:cut[i + 1]]
        if not len(found) and of_text[i + 1] > of_text[i]:
            own = words[of_text[i]:of_text[i + 1]]
            found, _ = windows(own, np.array([0, len(own)]), len(own))
        out.append(np.unique(found))
    return out
