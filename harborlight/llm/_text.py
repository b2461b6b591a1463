"""Vectorised words and rolling hashes over Arrow string columns.

A batch is cut into chunks of whole texts of at most `CHUNK_BYTES` (a longer text is a chunk of its own), so that
memory in a Python worker stays bounded whatever the batch size. Nulls count as empty texts. Hashes are 64-bit
polynomial hashes of bytes (words) and of word hashes (windows), computed from prefix sums modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Just under 2 MiB, so that power tables have 2**21 entries.
CHUNK_BYTES = (2 << 20) - 64
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95
_tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; grown tables are kept per worker."""
    size = 1 << max(16, int(n).bit_length())
    if (base, size) not in _tables:
        inverse = pow(base, -1, 1 << 64)
        both = []
        for b in (base, inverse):
            row = np.full(size, b, np.uint64)
            row[0] = 1
            both.append(np.cumprod(row, dtype=np.uint64))
        if size > 1 << 23:
            return both[0], both[1]
        _tables[base, size] = (both[0], both[1])
    return _tables[base, size]


def fold_table() -> np.ndarray:
    """Byte table that maps A-Z to a-z and keeps the rest."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def _codes(lower: bool) -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BYTE_BASE))
    return codes[fold_table()] if lower else codes


NONSPACE = np.ones(256, bool)
NONSPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
CODES = _codes(False)
CODES_LOWER = _codes(True)


@dataclass
class Words:
    """Words of a chunk: `hash`, byte `start` and `end`; words of text i are [first[i], first[i + 1])."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


@dataclass
class Chunk:
    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Whole texts [lo, hi) of the column as one byte array with offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield Chunk(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def words(chunk: Chunk, inside: np.ndarray, codes: np.ndarray) -> Words:
    """Maximal runs of bytes for which `inside` holds, within each text."""
    data, offsets, n = chunk.data, chunk.offsets, len(chunk.data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64))
    mask = inside[data]
    opens, closes = mask.copy(), mask.copy()
    opens[1:] &= ~mask[:-1]
    closes[:-1] &= ~mask[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    opens[edges] = mask[edges]
    closes[edges - 1] = mask[edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    power, inverse = _powers(_BYTE_BASE, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(codes[data] * power[:n], out=total[1:])
    hashes = mix((total[end] - total[start]) * inverse[start])
    return Words(hashes, start, end, np.searchsorted(start, offsets).astype(np.int64))


def stems(chunk: Chunk, found: Words, size: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of more than `size` bytes, and the hash of the first `size` bytes of each."""
    long = np.flatnonzero(found.end - found.start > size)
    hashes = np.zeros(len(long), np.uint64)
    for k in range(size):
        hashes = mix(hashes ^ codes[chunk.data[found.start[long] + k]])
    return long, hashes


def windows(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each word on, and whether all k lie in one text; positions are word numbers."""
    n = len(found.hash)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    power, inverse = _powers(_WORD_BASE, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(found.hash * power[:n], out=total[1:])
    hashes = mix((total[k:] - total[:-k]) * inverse[: n - k + 1] + np.uint64(k))
    doc = found.doc
    return hashes, doc[: n - k + 1] == doc[k - 1 :]


def covered(n: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Which of n positions lie in any [start, start + length)."""
    ends = starts + lengths
    edge = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(np.minimum(ends, n), minlength=n + 1)[: n + 1]
    return np.cumsum(edge)[:n] > 0


def per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of a per-word array for each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]
