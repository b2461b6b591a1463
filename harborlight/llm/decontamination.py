"""Benchmark decontamination with suffix arrays of the training texts.

Each batch of documents is a shard: its words (as 64-bit hashes) get a suffix array, ordered by the first `WINDOW` words and
then, by doubling, as far as suffixes agree. Every suffix of every benchmark item is searched in it by bisection; the suffixes
of the shard that begin with the item's window are the places where it occurs, and each is extended to the longest verbatim
match. A shard never leaves its task, so there is no shuffle. The benchmark reaches the tasks in blocks of at most
`BLOCK_BYTES` of text. A larger benchmark takes one pass over the documents for each block, with what was found so far
written between passes, so that driver, executors and tasks hold one block at a time.

Defined results: null and wordless texts have no words and no hits; wordless items take no part; an item shorter than a
window must occur whole; equal items count under each of their ids; repeated item ids count once; an item without id
hits words and counts as an item named ''; an empty benchmark leaves every document clean. find_contamination replaces columns
of `docs` with the names of the report; decontaminate keeps them.
"""

from __future__ import annotations

import math

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlight.llm import _text
from harborlight.llm._arrow import add_columns, spare
from harborlight.session import stored

WINDOW = 10
BLOCK_BYTES = 8 << 20
#: Matches of short items expanded at once, which bounds memory.
EXPAND = 1 << 20

#: What is known of a document: its words, those hit (and where, as pairs of start and end), items, longest match.
FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("hits", T.BinaryType()),
    T.StructField("longest_match", T.LongType()),
    T.StructField("longest_at", T.LongType()),
]


class Queries:
    """Suffixes of the items of one block, each with the length of its window and of its item's rest."""

    def __init__(self, texts: list[str], window: int) -> None:
        chunk = next(_text.chunks(pa.array(texts, pa.large_string()), 1 << 40))
        found = _text.words(chunk, _text.ALNUM, _text.CODES_LOWER)
        size = np.diff(found.first)
        item = found.doc
        place = np.arange(len(item)) - found.first[item]
        keep = place <= np.maximum(size[item] - window, 0)
        self.item = item[keep]
        self.length = np.minimum(size[item], window)[keep]
        self.rest = (size[item] - place)[keep]
        self.at = np.flatnonzero(keep)
        self.hash = np.concatenate([found.hash, np.zeros(window + 1, np.uint64)])


def _pair(words: np.ndarray, at: np.ndarray, level: int) -> np.ndarray:
    high = words[at + 2 * level] & np.uint64(0xFFFFFFFF00000000)
    return high | (words[at + 2 * level + 1] >> np.uint64(32))


def suffix_array(words: np.ndarray, n: int, depth: int) -> np.ndarray:
    """Positions 0..n-1 ordered by all words from there on (by the upper halves of their hashes).

    The first `depth` words are compared by pairs, more of them by the ranks of what follows; `words` is padded.
    """
    order = np.argsort(_pair(words, np.arange(n), 0), kind="stable")
    key = _pair(words, order, 0)
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    for level in range(1, math.ceil(depth / 2)):  # an odd depth is ordered by one word more
        group = np.cumsum(new) - 1
        tied = ~new
        tied[:-1] |= ~new[1:]
        where = np.flatnonzero(tied)
        if not len(where):
            break
        key = _pair(words, order[where], level)
        inner = np.lexsort((key, group[where]))
        order[where] = order[where][inner]
        key = key[inner]
        fresh = np.ones(len(where), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (group[where][1:] != group[where][:-1])
        new[where] |= fresh
    while True:
        tied = ~new
        tied[:-1] |= ~new[1:]
        where = np.flatnonzero(tied)
        if not len(where):
            return order
        # equal ones share the rank of their first, which is right for `depth` words and then for twice as many
        start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank = np.full(n + 1, -1, np.int32)
        rank[order] = start
        key, group = rank[np.minimum(order[where] + depth, n)], start[where]
        inner = np.argsort(group.astype(np.int64) * (n + 1) + key + 1, kind="stable")
        order[where] = order[where][inner]
        key = key[inner]
        new[where[1:]] |= (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        depth *= 2


def search(words: np.ndarray, order: np.ndarray, queries: Queries, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges [low, high) of the suffix array whose suffixes begin with each query's window; queries without one are left out."""
    alive = np.arange(len(queries.at))
    low, high = np.zeros(len(alive), np.int64), np.full(len(alive), len(order), np.int64)
    for level in range(math.ceil(depth / 2)):
        used = queries.length[alive] - 2 * level
        mask = np.where(used >= 2, np.uint64(0xFFFFFFFFFFFFFFFF), np.where(used == 1, np.uint64(0xFFFFFFFF00000000), np.uint64(0)))
        want = _pair(queries.hash, queries.at[alive], level) & mask
        bounds = []
        for right in (False, True):
            a, b = low.copy(), high.copy()
            while (open_ := a < b).any():
                middle = (a + b) // 2
                have = _pair(words, order[np.minimum(middle, len(order) - 1)], level) & mask
                below = (have <= want) if right else (have < want)
                a = np.where(open_ & below, middle + 1, a)
                b = np.where(open_ & ~below, middle, b)
            bounds.append(a)
        keep = bounds[0] < bounds[1]
        alive, low, high = alive[keep], bounds[0][keep], bounds[1][keep]
    return alive, low, high


def _match(found: _text.Words, queries: Queries, window: int):
    """Pieces of (query, position, length of the longest match) for all occurrences in the shard."""
    n = len(found.hash)
    words = np.concatenate([found.hash, np.zeros(window + 2, np.uint64)])
    order = suffix_array(words, n, window)
    doc = found.doc
    alive, low, high = search(words, order, queries, window)
    total = np.concatenate([[0], np.cumsum(high - low)])
    a = 0
    while a < len(alive):
        b = max(a + 1, int(np.searchsorted(total, total[a] + EXPAND, "right")) - 1)
        count = (high - low)[a:b]
        query = np.repeat(alive[a:b], count)
        place = order[np.arange(count.sum()) - np.repeat(total[a:b] - total[a], count) + np.repeat(low[a:b], count)]
        length = queries.length[query]
        good = doc[place] == doc[np.minimum(place + length - 1, n - 1)]
        good &= place + length <= n
        for step in range(window):
            good &= (step >= length) | (words[place + step] == queries.hash[queries.at[query] + step])
        query, place, length = query[good], place[good], length[good].astype(np.int64)
        room = np.minimum(queries.rest[query], found.first[doc[place] + 1] - place)
        grow = np.flatnonzero(length < room)
        while len(grow):
            same = words[place[grow] + length[grow]] == queries.hash[queries.at[query[grow]] + length[grow]]
            grow = grow[same]
            length[grow] += 1
            grow = grow[length[grow] < room[grow]]
        yield query, place, length
        a = b


def search_texts(column: pa.Array, ids: list[str], queries: Queries | None, window: int = WINDOW, before: tuple[pa.Array, ...] = ()) -> list[pa.Array]:
    """FOUND for each text of a batch after one block, given what was found `before` (items, hits, longest_match, longest_at)."""
    known = [b.to_pylist() for b in before]
    out: list[list] = [[] for _ in FOUND]
    for chunk in _text.chunks(column):
        found = _text.words(chunk, _text.ALNUM, _text.CODES_LOWER)
        texts, n = chunk.hi - chunk.lo, len(found.hash)
        edge = np.zeros(n + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(texts)]
        longest, longest_at = np.zeros(texts, np.int64), np.full(texts, -1, np.int64)
        for i in range(texts if known else 0):
            items[i] |= set(known[0][chunk.lo + i])
            longest[i], longest_at[i] = known[2][chunk.lo + i], known[3][chunk.lo + i]
            spans = np.frombuffer(known[1][chunk.lo + i] or b"", np.int64).reshape(-1, 2) + found.first[i]
            edge[spans[:, 0]] += 1
            edge[spans[:, 1]] -= 1
        doc = found.doc
        for query, place, length in _match(found, queries, window) if n and queries else []:
            size = queries.length[query]
            edge += np.bincount(place, minlength=n + 1) - np.bincount(place + size, minlength=n + 1)
            owner = doc[place]
            for i, j in np.unique(np.stack([owner, queries.item[query]], 1), axis=0):
                items[i].add(ids[j])
            rank = np.lexsort((place, -length, owner))
            first = rank[np.unique(owner[rank], return_index=True)[1]] if len(rank) else rank
            at = (place - found.first[owner])[first]
            better = (length[first] > longest[owner[first]]) | ((length[first] == longest[owner[first]]) & (at < longest_at[owner[first]]))
            longest[owner[first[better]]], longest_at[owner[first[better]]] = length[first[better]], at[better]
        hit = np.cumsum(edge)[:n] > 0
        out[0].append(np.diff(found.first))
        out[1].append(_text.per_text(hit, found.first))
        out[2].append([sorted(x) for x in items])
        out[3].append([_spans(hit[a:b]) for a, b in zip(found.first[:-1], found.first[1:], strict=True)])
        out[4].append(longest)
        out[5].append(longest_at)
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.binary(), pa.int64(), pa.int64()]
    return [pa.array([v for part in parts for v in part], kind) for parts, kind in zip(out, kinds, strict=True)]


def _spans(hit: np.ndarray) -> bytes | None:
    """Start and end of each run of hit words."""
    if not hit.any():
        return None
    turn = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
    return turn.astype(np.int64).tobytes()


def benchmark_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The benchmark as DataFrames of at most about block_bytes of text each (an item is never split)."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), F.col(text).alias("text")).filter("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(size / block_bytes))
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i) for i in range(count)]


def _search(docs: DataFrame, benchmark: DataFrame, text: str, window: int, names: list[str]) -> DataFrame:
    """docs with FOUND under the given names; one pass for each block of the benchmark."""
    fields = [T.StructField(n, f.dataType) for n, f in zip(names, FOUND, strict=True)]
    blocks = benchmark_blocks(benchmark)
    for number, block in enumerate(blocks):
        rows = sorted(block.collect())  # at most a block
        held = docs.sparkSession.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows]))
        docs = add_columns(docs, text, fields, _pass(held, window), tuple(names[2:]) if number else ())
        if number + 1 < len(blocks):
            docs = stored(docs, "benchmark-pass")
            held.unpersist()
    return docs


def _pass(held: Broadcast, window: int) -> Callable[..., list[pa.Array]]:
    prepared: list[tuple[list[str], Queries | None]] = []

    def run(column: pa.Array, *before: pa.Array) -> list[pa.Array]:
        if not prepared:  # once per task
            ids, texts = held.value
            prepared.append((ids, Queries(texts, window) if texts else None))
        return search_texts(column, *prepared[0], window, before)

    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with n_words, n_hit, n_items, items_sha256, contaminated, longest_match, longest_at (word number, -1 without a match)."""
    names = [spare(f"_{f.name}", docs.columns) for f in FOUND]
    words, hit, items, _, longest, at = (F.col(n) for n in names)
    report = {
        "n_words": words,
        "n_hit": hit,
        "n_items": F.size(items).cast("long"),
        "items_sha256": F.sha2(F.array_join(items, ","), 256),
        "contaminated": hit > 0,
        "longest_match": longest,
        "longest_at": at,
    }
    own = [f"`{c}`" for c in docs.columns if c.lower() not in report]
    return _search(docs, benchmark, text, window, names).select(*own, *[c.alias(n) for n, c in report.items()])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents of which no word lies in a benchmark window, with their own columns."""
    names = [spare(f"_{f.name}", docs.columns) for f in FOUND]
    return _search(docs, benchmark, text, window, names).filter(F.col(names[1]) == 0).select(*[f"`{c}`" for c in docs.columns])
