"""Approximate nearest neighbours by inner product: a robust-pruned directed graph per shard.

Equal vectors are one node that carries its smallest ids (k + 1 of them, which is all that any result can show). Nodes go to
shards by hash, `SHARD_ROWS` a shard. In a shard the graph is built in batches: beam searches on the graph so far propose
neighbours, robust pruning (a neighbour is dropped if a kept one is closer to it by the factor `RELAX`) keeps diverse edges,
and the reverse edges are added and pruned alike. A search begins at the best of `ENTRIES` random nodes, so that clusters far
from each other need no edges between them. Near means near in direction here. Where lengths differ, the largest inner
products lie elsewhere, so each node also gets edges to the `REACH` largest ones that a search with it as query finds.
Shards are written once. Queries go in blocks; every shard meets every block in tasks of one shard and at most `BLOCKS` blocks,
a beam search by inner product answers them, and the best of all shards are merged. Only queries and k rows for each query
and shard move; a shard is copied once for every `BLOCKS` blocks. Searches by inner product compare directions in single precision times
lengths in double precision, scaled together, and begin at the longest nodes of a shard as well.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without
id; vectors of another length are another index; equal rows count once; of an id with different vectors each is a query and
a candidate (but never for its own id); ties go to the smaller id; a product that overflows is infinite, one that overflows both ways -infinity; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborlight.session import ship, stored

SHARD_ROWS = 8192
DEGREE, REACH, BUILD_BEAM, SEARCH_BEAM = 24, 16, 48, 128
#: Nodes of each shard that a search begins with, the best of them.
ENTRIES = 256
RELAX = 1.2
QUERY_BLOCK, BLOCKS = 1024, 32
BATCH = 1024


def directions(vectors: np.ndarray) -> np.ndarray:
    """The vectors at length 1; none is zero. Scaled first, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return (scaled / np.sqrt((scaled**2).sum(1, keepdims=True))).astype(np.float32)


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Lengths in double precision, scaled together so that the longest does not overflow and none within 600 orders of magnitude of it vanishes."""
    largest = np.abs(vectors).max(1)
    log = np.log(largest) + np.log(((vectors / largest[:, None]) ** 2).sum(1)) / 2
    return np.exp(log - log.max() + 690)  # about 1e300


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision; one that overflows is infinite, one that overflows both ways -infinity."""
    with np.errstate(over="ignore", invalid="ignore"):
        found = np.einsum("ij,ij->i", queries, vectors)
    return np.where(np.isnan(found), -np.inf, found)


def entries(n: int, length: np.ndarray | None = None) -> np.ndarray:
    """The nodes of a shard of n that searches begin with; also the order of building begins with them. With lengths, the longest nodes besides."""
    begin = np.random.default_rng(3).permutation(n)[:ENTRIES]
    if length is None:
        return begin
    longest = np.lexsort((np.arange(n), -length))[:ENTRIES]
    return np.concatenate([begin, longest[~np.isin(longest, begin)]])


def beam_search(nodes: np.ndarray, edges: np.ndarray, begin: np.ndarray, queries: np.ndarray, beam: int, length: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Best `beam` nodes (-1 past the end) by inner product for each query, found greedily from `begin`, all queries in step; and their products.

    Nodes are directions; with lengths, a product is that of the directions times the node's length in double precision.
    """
    times = np.ones(len(nodes), np.float32) if length is None else length
    q, n = len(queries), len(nodes)
    degree = edges.shape[1]
    ids = np.full((q, beam), -1, np.int64)
    near = np.full((q, beam), -np.inf, times.dtype)
    done = np.ones((q, beam), bool)
    known = (queries @ nodes[begin].T) * times[begin]
    best = np.argsort(-known, 1, kind="stable")[:, :beam]
    width = best.shape[1]
    ids[:, :width], near[:, :width], done[:, :width] = begin[best], np.take_along_axis(known, best, 1), False
    seen = np.zeros((q, n), bool)
    seen[:, begin] = True
    live = np.arange(q)
    while len(live):
        first = (~done[live]).argmax(1)
        done[live, first] = True
        step = edges[ids[live, first]]
        fresh = (step >= 0) & ~seen[live[:, None], np.maximum(step, 0)]
        r, c = np.nonzero(fresh)
        seen[live[r], step[r, c]] = True
        product = np.full((len(live), degree), -np.inf, times.dtype)
        product[r, c] = np.einsum("ij,ij->i", queries[live[r]], nodes[step[r, c]]) * times[step[r, c]]
        all_ids = np.concatenate([ids[live], np.where(fresh, step, -1)], 1)
        all_near = np.concatenate([near[live], product], 1)
        all_done = np.concatenate([done[live], ~fresh], 1)
        best = np.argpartition(-all_near, beam - 1, 1)[:, :beam]
        order = np.take_along_axis(best, np.argsort(-np.take_along_axis(all_near, best, 1), 1, kind="stable"), 1)
        ids[live], near[live] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_near, order, 1)
        done[live] = np.take_along_axis(all_done, order, 1)
        live = live[~done[live].all(1)]
    return ids, near


def robust_prune(nodes: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Neighbours of each own node from its candidates (-1: none), nearest first; all nodes have equal norm."""
    rows = np.sort(candidates, 1)
    rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = -1
    rows[rows == own[:, None]] = -1
    points = nodes[np.maximum(rows, 0)]
    far = 2 * (float((nodes[0].astype(float) ** 2).sum()) - np.einsum("bcd,bd->bc", points, nodes[own]))
    far = np.where(rows >= 0, np.maximum(far, 0), np.inf).astype(np.float32)
    norm = float((nodes[0].astype(float) ** 2).sum())
    out = np.full((len(own), degree), -1, np.int64)
    left = far.copy()
    at = np.arange(len(own))
    for k in range(degree):
        best = left.argmin(1)
        ok = np.isfinite(left[at, best])
        if not ok.any():
            break
        out[ok, k] = rows[ok, best[ok]]
        left[at, best] = np.inf
        between = 2 * (norm - np.einsum("bcd,bd->bc", points, points[at, best]))
        left[ok[:, None] & (relax * relax * np.maximum(between, 0) <= far)] = np.inf
    return out


def build_graph(vectors: np.ndarray, degree: int = DEGREE, reach: int = REACH, beam: int = BUILD_BEAM, relax: float = RELAX) -> np.ndarray:
    """Edges (n, degree + reach; -1: none)."""
    nodes, length = directions(vectors), lengths(vectors)
    n = len(nodes)
    edges = np.full((n, degree), -1, np.int64)
    far = np.full((n, reach), -1, np.int64)
    begin = entries(n)
    order = np.random.default_rng(3).permutation(n)
    done = 1
    while done < n:
        batch = order[done : done + min(BATCH, done)]
        found, _ = beam_search(nodes, edges, begin[:done], nodes[batch], beam)
        edges[batch] = robust_prune(nodes, batch, found, degree, 1.0)
        _add_reverse(nodes, edges, batch, degree, 1.0)
        done += len(batch)
    for i in range(0, n, BATCH):
        batch = order[i : i + BATCH]
        found, _ = beam_search(nodes, edges, begin, nodes[batch], beam)
        edges[batch] = robust_prune(nodes, batch, np.concatenate([found, edges[batch]], 1), degree, relax)
        _add_reverse(nodes, edges, batch, degree, relax)
    begin = entries(n, length)
    for i in range(0, n if reach else 0, BATCH):
        batch = order[i : i + BATCH]
        found, _ = beam_search(nodes, np.concatenate([edges, far], 1), begin, nodes[batch], beam, length)
        # no edge twice, or a step would find its end twice
        known = np.concatenate([batch[:, None], edges[batch]], 1)
        found[(found[:, :, None] == known[:, None, :]).any(2)] = -1
        # those found lie before those that aren't, nearest first
        first = np.argsort(found < 0, 1, kind="stable")[:, :reach]
        far[batch, : first.shape[1]] = np.take_along_axis(found, first, 1)
    return np.concatenate([edges, far], 1)


def _add_reverse(nodes: np.ndarray, edges: np.ndarray, batch: np.ndarray, degree: int, relax: float) -> None:
    """Edges back to the batch; targets that would have too many are pruned, in rounds of at most `degree` new ones each."""
    source = np.repeat(batch, degree)
    target = edges[batch].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    while len(target):
        edge = np.flatnonzero(np.diff(target, prepend=-1))
        place = np.arange(len(target)) - np.repeat(edge, np.diff([*edge, len(target)]))
        now = place < degree
        own = np.unique(target[now])
        extra = np.full((len(own), degree), -1, np.int64)
        extra[np.searchsorted(own, target[now]), place[now]] = source[now]
        both = np.concatenate([edges[own], extra], 1)
        room = (both >= 0).sum(1) <= degree
        simple = np.sort(both[room], 1)[:, ::-1]
        repeated = np.zeros(simple.shape, bool)
        repeated[:, 1:] = (simple[:, 1:] == simple[:, :-1]) & (simple[:, 1:] >= 0)
        edges[own[room]] = np.sort(np.where(repeated, -1, simple), 1)[:, ::-1][:, :degree]
        if (~room).any():
            edges[own[~room]] = robust_prune(nodes, own[~room], both[~room], degree, relax)
        source, target = source[~now], target[~now]


def _clean(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    v = F.col("v")
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter("vec_id is not null and v is not null and size(v) > 0")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(good & F.exists(v, lambda x: x != 0)).distinct()


SHARD = "dim int, shard int, size int, vectors binary, edges binary, ids binary, edge binary"


def _build(table: pa.Table) -> pa.Table:
    """One row per shard: its vectors, graph and the ids of each node."""
    dim, shard = table.column("dim")[0].as_py(), table.column("shard")[0].as_py()
    flat = table.column("v").combine_chunks()
    vectors = flat.flatten().to_numpy().reshape(-1, dim)
    order = np.lexsort(vectors.T[::-1])
    vectors = vectors[order]
    ids = [table.column("ids")[int(i)].as_py() for i in order]
    edges = build_graph(vectors)
    count = np.cumsum([0, *map(len, ids)]).astype(np.int64)
    row = {"dim": dim, "shard": shard, "size": len(vectors), "vectors": vectors.tobytes(), "edges": edges.astype(np.int32).tobytes(), "ids": np.concatenate(ids).astype(np.int64).tobytes(), "edge": count.tobytes()}
    schema = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("size", pa.int32()), ("vectors", pa.binary()), ("edges", pa.binary()), ("ids", pa.binary()), ("edge", pa.binary())])
    return pa.Table.from_pylist([row], schema)


def build_index(vectors: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The written index: one row per shard. Every usable row is in it."""
    ship(vectors.sparkSession)
    rows = _clean(vectors, vec_id, vector)
    # partial limits before the shuffle keep a vector with very many copies small
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("_r") <= k + 1)
    nodes = ranked.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("dim", F.size("v"))
    nodes = stored(nodes, "ann-nodes")
    per = nodes.groupBy("dim").count().withColumn("shards", F.ceil(F.col("count") / shard_rows).cast("int")).drop("count")
    placed = nodes.join(F.broadcast(per), "dim").withColumn("shard", F.pmod(F.xxhash64("v"), F.col("shards")).cast("int"))
    return stored(placed.select("dim", "shard", "v", "ids").groupBy("dim", "shard").applyInArrow(_build, SHARD), "ann-index")


def _block(table: pa.Table) -> pa.Table:
    dim, block = table.column("dim")[0].as_py(), table.column("block")[0].as_py()
    ids = table.column("vec_id").combine_chunks().to_numpy()
    vectors = table.column("v").combine_chunks().flatten().to_numpy()
    return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int32()), "query_ids": pa.array([ids.tobytes()], pa.binary()), "queries": pa.array([vectors.tobytes()], pa.binary())})


FOUND = "query_id long, row int, block int, vec_id long, score double"


def _search(k: int, beam: int):
    """Of one shard and some blocks of queries: the k best of each query."""

    def answer(shard: dict, vectors: np.ndarray, nodes: np.ndarray, length: np.ndarray, block: dict) -> pa.RecordBatch:
        edges = np.frombuffer(shard["edges"], np.int32).reshape(len(vectors), -1)
        ids, edge = np.frombuffer(shard["ids"], np.int64), np.frombuffer(shard["edge"], np.int64)
        owner = np.frombuffer(block["query_ids"], np.int64)
        queries = np.frombuffer(block["queries"], np.float64).reshape(len(owner), -1)
        found, _ = beam_search(nodes, edges, entries(len(vectors), length), directions(queries), beam, length)
        q, c = np.nonzero(found >= 0)
        node = found[q, c]
        product = products(queries[q], vectors[node])
        size = edge[node + 1] - edge[node]
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        one_q, one_s = np.repeat(q, size), np.repeat(product, size)
        one_id = ids[np.repeat(edge[node], size) + inner]
        other = one_id != owner[one_q]
        one_q, one_s, one_id = one_q[other], one_s[other], one_id[other]
        order = np.lexsort((one_id, -one_s, one_q))
        one_q, one_s, one_id = one_q[order], one_s[order], one_id[order]
        start = np.searchsorted(one_q, np.arange(len(queries)))
        keep = np.arange(len(one_q)) - start[one_q] < k
        columns = [pa.array(owner[one_q[keep]]), pa.array(one_q[keep].astype(np.int32)), pa.array(np.full(keep.sum(), block["block"], np.int32)), pa.array(one_id[keep]), pa.array(one_s[keep])]
        return pa.RecordBatch.from_arrays(columns, ["query_id", "row", "block", "vec_id", "score"])

    def run(shards: pa.Table, blocks: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("row", pa.int32()), ("block", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])
        out = []
        for shard in shards.to_pylist() if blocks.num_rows else []:
            vectors = np.frombuffer(shard["vectors"], np.float64).reshape(-1, shard["dim"])
            nodes, length = directions(vectors), lengths(vectors)
            out += [answer(shard, vectors, nodes, length, b) for b in blocks.to_pylist()]
        return pa.Table.from_batches(out, schema)

    return run


def nearest(queries: DataFrame, index: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding", beam: int = SEARCH_BEAM, block_rows: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found in all shards, never the query's own id."""
    spark = queries.sparkSession
    ship(spark)
    rows = _clean(queries, vec_id, vector).withColumn("dim", F.size("v"))
    count = max(1, math.ceil(rows.count() / block_rows))
    parts = math.ceil(count / BLOCKS)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)).cast("int"))
    blocks = rows.select("dim", "block", "vec_id", "v").groupBy("dim", "block").applyInArrow(_block, "dim int, block int, query_ids binary, queries binary")
    blocks = stored(blocks, "ann-queries").withColumn("part", F.pmod("block", F.lit(parts)))
    # every block goes to every shard of its length, and every shard to every part of the blocks
    shards = index.groupBy("dim").agg(F.max("shard").alias("last"))
    asked = blocks.join(F.broadcast(shards), "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), "last"))).drop("last")
    copies = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    key = ["dim", "shard", "part"]
    found = copies.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(_search(max(k, 1), max(beam, k)), FOUND)
    best = Window.partitionBy("query_id", "block", "row").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
