"""Removal of passages that repeat, found by fixed-block anchors.

1. Index: every text is cut into non-overlapping reference blocks of `BLOCK` words; probe: every rolling window of BLOCK
   words. A passage of LENGTH words, wherever it lies, holds a whole reference block of its text (LENGTH >= 2 * BLOCK - 1),
   so of two equal passages each holds a window that hits a block of the other. Only hashes and positions are moved.
2. Extension: a hit at word p can be part of a repeat only if a LENGTH-word passage around p is equal to another one. The
   passages around hits are hashed whole (62 bits and the bucket) and counted over all texts; those that start twice or more are repeats,
   and a run of them, word after word, is the repeat extended as far as it goes. Counting by hash instead of comparing the
   places of a hit pair by pair keeps a group of copies linear in its size.

Only texts with hits are moved (once, as a written table) for the second step; all others are finished in the first.

Defined results: null and wordless texts have no words, nothing removed and the SHA-256 of ''; equal rows are occurrences
of each other; texts shorter than LENGTH words keep all; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlight.llm import _occurrences as occ
from harborlight.llm import _text
from harborlight.llm._keys import KEY, keyed
from harborlight.session import release, ship, stored

LENGTH = 35
BLOCK = 18
#: Hash buckets per shuffle partition, so that partitions are even.
SPREAD = 4


def _buckets(df: DataFrame) -> int:
    return SPREAD * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.binary())], ["bucket", "chunk", "kind", "data"])


def _keys(batch: pa.RecordBatch, chunk: _text.Chunk) -> np.ndarray:
    """The keys of a chunk's texts: 2 rows, one per half."""
    return np.stack([batch.column(i).to_numpy(zero_copy_only=False)[chunk.lo : chunk.hi] for i in range(2)]).astype(np.int64)


def _chunk_id(keys: np.ndarray, lo: int) -> int:
    return struct.unpack("<q", hashlib.blake2b(keys.tobytes() + str(lo).encode(), digest_size=8).digest())[0]


def _probe(length: int, block: int, buckets: int):
    """Map side of step 1. A table entry holds key, first word and, for the finished result, the hash of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _text.chunks(batch.column(2)):
                found = _text.words(chunk, _text.NONSPACE, _text.CODES)
                mine, n = _keys(batch, chunk), chunk.hi - chunk.lo
                name = _chunk_id(mine, chunk.lo)
                whole = b"".join(hashlib.sha256(b" ".join(chunk.text(i).split())).digest() for i in range(n))
                hashes, inside = _text.windows(found, block)
                doc = found.doc
                place = np.arange(len(hashes)) - found.first[doc[: len(hashes)]]
                # a text too short for a passage can neither hold a repeat nor be part of one
                use = np.flatnonzero(inside & (np.diff(found.first) >= length)[doc[: len(hashes)]])
                *entries, rest = occ.combine(hashes[use], place[use] % block == 0, use)
                rows = [(name % buckets, name, occ.TABLE, np.uint32(n).tobytes() + mine.tobytes() + found.first.astype(np.uint32).tobytes() + whole + rest)]
                for bucket, data in occ.pack(*entries, buckets):
                    rows.append((bucket, name, occ.OCCURRENCES, data))
                yield _rows(rows)

    return run


TABLE_SCHEMA = "_key long, _more long, n_words long, whole string, hits binary"


def _resolve(table: pa.Table) -> pa.Table:
    """Per text of a chunk: key, number of words, hash of all words and its hit positions."""
    tables, reported = occ.positions(table)
    out: list[tuple] = []
    for data in tables:
        keys, first, rest = _open(data)
        n = len(first) - 1
        whole, hits = data[rest : rest + 32 * n], occ.expand(memoryview(data)[rest + 32 * n :], reported)
        edge = np.searchsorted(hits, first)
        for i in range(n):
            own = hits[edge[i] : edge[i + 1]] - first[i]
            out.append((*keys[:, i].tolist(), int(first[i + 1] - first[i]), whole[32 * i : 32 * i + 32].hex(), own.astype(np.uint32).tobytes() if len(own) else None))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.table([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], [*KEY, "n_words", "whole", "hits"])


def _open(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys and first words of a chunk's table, and where the rest of it begins."""
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    return np.frombuffer(data, np.int64, 2 * n, 4).reshape(2, n), np.frombuffer(data, np.uint32, n + 1, 4 + 16 * n).astype(np.int64), 4 + 16 * n + 4 * (n + 1)


def _extend(length: int, block: int, buckets: int):
    """Map side of step 2: the passages around hits, hashed whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(3)
            for chunk in _text.chunks(batch.column(2)):
                found = _text.words(chunk, _text.NONSPACE, _text.CODES)
                mine, n = _keys(batch, chunk), chunk.hi - chunk.lo
                name = _chunk_id(mine, chunk.lo)
                hashes, inside = _text.windows(found, length)
                hits = np.concatenate([np.frombuffer(marks[i].as_py(), np.uint32).astype(np.int64) + found.first[i - chunk.lo] for i in range(chunk.lo, chunk.hi)] or [np.zeros(0, np.int64)])
                # a passage starting at s holds the windows s .. s + length - block
                low = np.maximum(hits - (length - block), 0)
                near = _text.covered(len(found.hash), low, hits + 1 - low)[: len(hashes)]
                use = np.flatnonzero(inside & near)
                *entries, rest = occ.combine(hashes[use], np.zeros(len(use), bool), use)
                rows = [(name % buckets, name, occ.TABLE, np.uint32(n).tobytes() + mine.tobytes() + found.first.astype(np.uint32).tobytes() + rest)]
                for bucket, data in occ.pack(*entries, buckets, wide=True):
                    rows.append((bucket, name, occ.OCCURRENCES, data))
                yield _rows(rows)

    return run


def _starts(table: pa.Table) -> pa.Table:
    """Per text of a chunk: key and the words at which a repeated passage starts."""
    tables, reported = occ.positions(table)
    keys_out, starts_out = [], []
    for data in tables:
        keys, first, rest = _open(data)
        hits = occ.expand(memoryview(data)[rest:], reported)
        edge = np.searchsorted(hits, first)
        for i in np.flatnonzero(np.diff(edge)):
            keys_out.append(keys[:, i])
            starts_out.append((hits[edge[i] : edge[i + 1]] - first[i]).astype(np.uint32).tobytes())
    return pa.table([*[pa.array([int(k[half]) for k in keys_out], pa.int64()) for half in range(2)], pa.array(starts_out, pa.binary())], [*KEY, "starts"])


def _cut(length: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = batch.column(2), batch.column(3)
            removed, digests, kept_texts = [], [], []
            for i in range(len(batch)):
                split = (texts[i].as_py() or "").encode().split()
                starts = np.frombuffer(marks[i].as_py() or b"", np.uint32).astype(np.int64)
                gone = _text.covered(len(split), starts, length)
                kept = b" ".join(split[j] for j in np.flatnonzero(~gone))
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept.decode())
            columns = [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept_texts, pa.string())] * with_text, [*KEY, "n_removed", "kept_sha256"] + ["kept"] * with_text)

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, block: int = BLOCK, with_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and, with_text, `kept` (the kept words; null where nothing was removed)."""
    if length < 2 * block - 1:
        raise ValueError("a passage must hold a whole block: length >= 2 * block - 1")
    ship(docs.sparkSession)
    rows = keyed(docs, doc_id, text)
    buckets = _buckets(docs)
    packed = rows.select(*KEY, "_text").mapInArrow(_probe(length, block, buckets), occ.PACKED)
    reported = packed.groupBy("bucket").applyInArrow(occ.shared(True), occ.REPORTED)
    resolved = stored(reported.groupBy("chunk").applyInArrow(_resolve, TABLE_SCHEMA), "repeat-hits")
    release(docs.sparkSession)
    hits = resolved.filter("hits is not null").select(*KEY, "hits").dropDuplicates(KEY)
    marked = stored(rows.select(*KEY, "_text").join(hits, KEY), "repeat-texts")
    release(docs.sparkSession)
    packed = marked.mapInArrow(_extend(length, block, buckets), occ.PACKED)
    reported = packed.groupBy("bucket").applyInArrow(occ.shared(False, wide=True), occ.REPORTED)
    starts = reported.groupBy("chunk").applyInArrow(_starts, "_key long, _more long, starts binary").dropDuplicates(KEY)
    schema = "_key long, _more long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    cut = marked.join(starts, KEY).select(*KEY, "_text", "starts").mapInArrow(_cut(length, with_text), schema).dropDuplicates(KEY)
    plain = resolved.groupBy(*KEY).agg(F.first("n_words").alias("n_words"), F.first("whole").alias("whole"))
    done = plain.join(cut, KEY, "left")
    found = rows.select("doc_id", *KEY).join(done, KEY, "left")
    columns = ["doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept_sha256", "whole").alias("kept_sha256")]
    return found.select(*columns, *["kept"] * with_text)
