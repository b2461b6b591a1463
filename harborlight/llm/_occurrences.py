"""Counting hashed occurrences across all documents without moving texts.

A map task packs, for each chunk of texts, the occurrences of each hash bucket into one binary row: the hash (4 bytes
where later steps verify, else 8) and a position, delta-coded to about one byte. A reducer sees all occurrences of its hashes and reports the positions
that are shared; the reports meet their chunk's table (one entry per text) again by chunk id. All groups are bounded:
a bucket by the number of buckets, a chunk by its size. Occurrences of one hash in a chunk are combined: the first one is
sent, the table keeps the others, so a hot hash costs a reducer 6 bytes per chunk, however often it occurs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PACKED = "bucket int, chunk long, kind int, data binary"
OCCURRENCES, TABLE = 0, 1


def _pack_positions(at: np.ndarray) -> bytes:
    gaps = np.diff(at, prepend=0).astype(np.int64)
    wide = np.flatnonzero(gaps >= 255)
    small = np.minimum(gaps, 255).astype(np.uint8)
    return np.uint32(len(wide)).tobytes() + gaps[wide].astype(np.uint32).tobytes() + small.tobytes()


def _unpack_positions(data: memoryview, n: int) -> np.ndarray:
    wide = int(np.frombuffer(data, np.uint32, 1)[0])
    gaps = np.frombuffer(data, np.uint8, n, 4 + 4 * wide).astype(np.int64)
    gaps[gaps == 255] = np.frombuffer(data, np.uint32, wide, 4)
    return np.cumsum(gaps)


def combine(hashes: np.ndarray, references: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """One entry for each hash of a chunk: hash, flags (1: a reference is among its occurrences, 2: there are several), first place; and the others, packed for `expand`."""
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    run = np.cumsum(new) - 1
    first = order[new]
    size = np.bincount(run, minlength=len(first))
    flags = (np.bincount(run, weights=references[order], minlength=len(first)) > 0) + 2 * (size > 1)
    other = order[~new]
    lead = at[first[run[~new]]]
    by_place = np.argsort(other)
    rest = np.uint32(len(other)).tobytes() + lead[by_place].astype(np.uint32).tobytes() + _pack_positions(at[other[by_place]])
    back = np.argsort(first)
    return hashes[first[back]], flags[back], at[first[back]], rest


def expand(rest: memoryview, hits: np.ndarray) -> np.ndarray:
    """The hits (first places) with the other places of their hashes, in order."""
    n = int(np.frombuffer(rest, np.uint32, 1)[0])
    if not n or not len(hits):
        return hits
    lead = np.frombuffer(rest, np.uint32, n, 4)
    return np.union1d(hits, _unpack_positions(rest[4 + 4 * n :], n)[np.isin(lead, hits)])


def pack(hashes: np.ndarray, flags: np.ndarray, at: np.ndarray, buckets: int, wide: bool = False):
    """(bucket, data) for the entries `at` (ascending) of 64-bit hashes, with two flag bits each. wide keeps 62 bits of the hash, else 30."""
    if not len(hashes):
        return
    bucket = (hashes % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    kind = np.uint64 if wide else np.uint32
    short = (hashes if wide else hashes >> np.uint64(32)).astype(kind)
    short = short >> kind(2) << kind(2) | flags.astype(kind)
    short, place = short[order], at[order]
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
        yield int(bucket[order[a]]), np.uint32(b - a).tobytes() + short[a:b].tobytes() + _pack_positions(place[a:b])


def unpack(data: bytes, wide: bool = False) -> tuple[np.ndarray, np.ndarray]:
    view, size = memoryview(data), 8 if wide else 4
    n = int(np.frombuffer(view, np.uint32, 1)[0])
    return np.frombuffer(view, np.uint64 if wide else np.uint32, n, 4), _unpack_positions(view[4 + size * n :], n)


def shared(need_reference: bool, wide: bool = False):
    """Reducer of a bucket: the positions of hashes that occur twice or more (with a reference entry among them, if asked)."""

    def run(table: pa.Table) -> pa.Table:
        chunk, kind, data = (table.column(c).to_pylist() for c in ("chunk", "kind", "data"))
        out = [(c, k, d) for c, k, d in zip(chunk, kind, data, strict=True) if k == TABLE]
        parts = [(c, *unpack(d, wide)) for c, k, d in zip(chunk, kind, data, strict=True) if k == OCCURRENCES]
        if parts:
            hashes = np.concatenate([p[1] for p in parts])
            order = np.argsort(hashes, kind="stable")
            key = hashes[order] >> hashes.dtype.type(2)
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            run_of = np.cumsum(new) - 1
            flags = hashes[order] & hashes.dtype.type(3)
            good = np.bincount(run_of, weights=1 + (flags >> hashes.dtype.type(1))) >= 2
            if need_reference:
                good &= np.bincount(run_of, weights=flags & hashes.dtype.type(1)) > 0
            hit = np.zeros(len(key), bool)
            hit[order] = good[run_of]
            first = 0
            for c, h, at in parts:
                mine = at[hit[first : first + len(h)]]
                first += len(h)
                if len(mine):
                    out.append((c, OCCURRENCES, np.uint32(len(mine)).tobytes() + _pack_positions(mine)))
        return pa.table({"chunk": pa.array([x[0] for x in out], pa.int64()), "kind": pa.array([x[1] for x in out], pa.int32()), "data": pa.array([x[2] for x in out], pa.binary())})

    return run


def counted(table: pa.Table) -> pa.Table:
    """Reducer of a bucket: the positions of hashes that occur twice or more, each with the number of occurrences (at most 255)."""
    chunk, kind, data = (table.column(c).to_pylist() for c in ("chunk", "kind", "data"))
    out = [(c, k, d) for c, k, d in zip(chunk, kind, data, strict=True) if k == TABLE]
    parts = [(c, *unpack(d)) for c, k, d in zip(chunk, kind, data, strict=True) if k == OCCURRENCES]
    if parts:
        size = _run_sizes(np.concatenate([p[1] for p in parts]))
        first = 0
        for c, h, at in parts:
            own = size[first : first + len(h)]
            first += len(h)
            mine = np.flatnonzero(own >= 2)
            if len(mine):
                out.append((c, OCCURRENCES, np.uint32(len(mine)).tobytes() + np.minimum(own[mine], 255).astype(np.uint8).tobytes() + _pack_positions(at[mine])))
    return pa.table({"chunk": pa.array([x[0] for x in out], pa.int64()), "kind": pa.array([x[1] for x in out], pa.int32()), "data": pa.array([x[2] for x in out], pa.binary())})


def _run_sizes(hashes: np.ndarray) -> np.ndarray:
    """How often each hash occurs."""
    _, inverse, count = np.unique(hashes >> hashes.dtype.type(2), return_inverse=True, return_counts=True)
    return count[inverse]


def positions_with_counts(table: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Like positions, for `counted`."""
    kind, data = table.column("kind").to_pylist(), table.column("data").to_pylist()
    at, count = [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)]
    for d in (d for k, d in zip(kind, data, strict=True) if k == OCCURRENCES):
        n = int(np.frombuffer(d, np.uint32, 1)[0])
        count.append(np.frombuffer(d, np.uint8, n, 4))
        at.append(_unpack_positions(memoryview(d)[4 + n :], n))
    at, first = np.unique(np.concatenate(at), return_index=True)
    return [d for k, d in zip(kind, data, strict=True) if k == TABLE], at, np.concatenate(count)[first]


REPORTED = "chunk long, kind int, data binary"


def positions(table: pa.Table) -> tuple[list[bytes], np.ndarray]:
    """Of a chunk's group: its tables (equal copies of a chunk give several) and the sorted shared positions."""
    kind, data = table.column("kind").to_pylist(), table.column("data").to_pylist()
    hits = [_unpack_positions(memoryview(d)[4:], int(np.frombuffer(d, np.uint32, 1)[0])) for k, d in zip(kind, data, strict=True) if k == OCCURRENCES]
    return [d for k, d in zip(kind, data, strict=True) if k == TABLE], np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.int64)
