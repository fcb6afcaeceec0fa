"""Words, n-grams and hashes of many texts at once, as numpy arrays over UTF-8 bytes.

Nothing here loops over characters in Python. A text's words are the runs of bytes outside
0x20 and 0x09-0x0D; hashes are 64-bit and equal on every worker.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; temporaries are a few dozen times that. A longer text is
#: handled alone, so memory follows the longest single text. The workers of an executor share what
#: its heap leaves.
CHUNK_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Letters for loose words: ASCII letters and every byte of a multi-byte character.
LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = True
LETTER[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random-looking 64-bit value for every byte.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def ladder(base: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return ladder(_BASE), ladder(pow(_BASE, -1, 1 << 64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least n of each."""
    size = CHUNK_BYTES * 2
    while size < n:
        size *= 2
    return _powers(size)


class Texts:
    """A run of texts: ``data`` holds their bytes, text i is data[bounds[i]:bounds[i+1]]."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds
        self._prefix: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def lowered(self) -> Texts:
        return Texts(LOWER[self.data], self.bounds)

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of the maximal runs of bytes with inside[byte]."""
        member = inside[self.data]
        first = member.copy()
        first[1:] &= ~member[:-1]
        edges = self.bounds[:-1]
        edges = edges[edges < len(member)]
        first[edges] = member[edges]
        last = member.copy()
        last[:-1] &= ~member[1:]
        inner = self.bounds[1:]
        inner = inner[inner > 0] - 1
        last[inner] = member[inner]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        return start, end, np.searchsorted(self.bounds, start, "right") - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.runs(~WHITE)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of every span; equal bytes give equal hashes."""
        up, down = powers(len(self.data) + 1)
        if self._prefix is None:
            self._prefix = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(BYTE_VALUE[self.data] * up[: len(self.data)], out=self._prefix[1:])
        raw = (self._prefix[end] - self._prefix[start]) * down[start]
        return mix(raw ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))

    def text(self, i: int) -> str:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes().decode("utf-8", "replace")


def windows(hashes: np.ndarray, group: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first position of every run of n neighbours in the same group."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    m = len(hashes) - n + 1
    out = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9FB21C651E98DF25) + hashes[k : k + m]
    at = np.flatnonzero(group[:m] == group[n - 1 :])
    return mix(out[at]), at


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, dtype=np.uint8), bounds - bounds[0]
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """The column in runs of rows [from, to) with about ``limit`` bytes each."""
    data, bounds = column_bytes(column)
    n, at = len(bounds) - 1, 0
    while at < n:
        to = int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to, Texts(data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at])
        at = to


def sums_by(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(group, weights=values, minlength=n)


def minhash_salts(n: int, seed: int) -> np.ndarray:
    """n pairs-free odd multipliers for multiply-and-mix hashing."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(seed | 1)) | np.uint64(1)
