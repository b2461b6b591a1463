"""Centroid clustering of quantised vectors with scalar lookup tables, in exact integers.

Vectors are quantised to floor(scale * x) and packed into blocks of up to BLOCK_ROWS rows: per dimension the integer values that
occur, sorted, and for each vector the place of its value among them. A round tabulates, per dimension, the squared difference of
every occurring value and every centroid; the distances of a block are gathers from these tables, added up over the
dimensions. A task adds up counts and components per cluster over all its blocks before anything is shuffled, and the driver
receives one row per cluster and dimension. Blocks are written once to the shared folder; each round is a job over
them, so a lost executor costs its running tasks.

Defined results: vectors that are null, have another number of components, or hold null or non-finite ones take no part, nor do those
with a quantised component beyond LARGEST, whose distances need not fit a long. The first centroids are the vectors with the
smallest SHA-256 of `seed:id` (a null id: `seed:`), equal ids by components; with fewer vectors than clusters, each is a centroid. Ties go to the smaller
number, empty clusters keep their centroid, repeated rows count each, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlight.session import ship, stored

#: Rows of a block; its tables are of at most so many values a dimension.
BLOCK_ROWS = 16_384
#: Largest quantised component: 64 squared differences of such still fit a long.
LARGEST = 1 << 27


def quantised(vectors: DataFrame, size: int, scale: int, vector: str, vec_id: str) -> DataFrame:
    """vec_id and q (array<long>) of the vectors that take part."""
    x = F.transform(F.col(vector), lambda e: F.floor(e.cast("double") * F.lit(float(scale))))
    fits = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double") * F.lit(float(scale))) <= F.lit(float(LARGEST)))
    taken = (F.size(vector) == size) & F.forall(F.col(vector), fits)
    return vectors.filter(taken).select(F.col(vec_id).alias("vec_id"), x.alias("q"))


def first_centroids(kept: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """Vectors of the smallest hashes of `seed:id`, one row each."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(name.alias("h"), "q").orderBy("h", "q").limit(clusters).collect()  # as many as there are clusters
    return np.array([r.q for r in rows], np.int64)


def pack(kept: DataFrame, size: int) -> DataFrame:
    """Blocks of vectors: ids, and as bytes the values of each dimension (int32, with their number) and each vector's places among them (uint16, by dimension)."""
    kind = kept.schema["vec_id"].dataType.simpleString()

    def block(ids: list[pa.Array], rows: list[np.ndarray]) -> pa.RecordBatch:
        q = np.concatenate(rows)
        values, places = zip(*[np.unique(q[:, d], return_inverse=True) for d in range(size)], strict=True)
        counts = np.array([len(v) for v in values], np.int32)
        named = pa.concat_arrays(ids)
        offsets = pa.array([0, len(named)], pa.int32())
        cells = [np.concatenate(values).astype(np.int32).tobytes(), counts.tobytes(), np.stack(places).astype(np.uint16).tobytes()]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, named), *[pa.array([c], pa.binary()) for c in cells]], ["ids", "values", "counts", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, waiting = [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                if waiting + part.num_rows > BLOCK_ROWS:
                    yield block(ids, rows)
                    ids, rows, waiting = [], [], 0
                ids.append(part.column(0))
                rows.append(part.column(1).flatten().to_numpy().reshape(-1, size))
                waiting += part.num_rows
        if waiting:
            yield block(ids, rows)

    return kept.mapInArrow(run, f"ids array<{kind}>, values binary, counts binary, places binary")


class Block:
    """An unpacked block: per dimension the occurring values, and the place of each vector's value."""

    def __init__(self, values: bytes, counts: bytes, places: bytes):
        counts = np.frombuffer(counts, np.int32)
        self.values = np.split(np.frombuffer(values, np.int32).astype(np.int64), np.cumsum(counts)[:-1])
        self.places = np.frombuffer(places, np.uint16).reshape(len(counts), -1)

    def assign(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance) of each vector."""
        total = np.zeros((self.places.shape[1], len(centroids)), np.int64)
        for values, places, c in zip(self.values, self.places, centroids.T, strict=True):
            table = (values[:, None] - c[None, :]) ** 2
            total += table[places]
        near = total.argmin(axis=1)
        return near, total[np.arange(len(near)), near]

    def sums(self, near: np.ndarray, clusters: int) -> np.ndarray:
        """Sum of each component over each cluster."""
        found = np.zeros((clusters, len(self.values)), np.int64)
        for d, (values, places) in enumerate(zip(self.values, self.places, strict=True)):
            met = np.bincount(near * len(values) + places, minlength=clusters * len(values)).reshape(clusters, -1)
            found[:, d] = met @ values
        return found


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Block]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column(0)[i].values, Block(*[batch.column(c)[i].as_py() for c in (1, 2, 3)])


def next_centroids(packed: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of each cluster; those of empty clusters as they were."""
    clusters, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(clusters, np.int64), np.zeros((clusters, size), np.int64)
        for _, block in _blocks(batches):
            near, _ = block.assign(centroids)
            counts += np.bincount(near, minlength=clusters)
            sums += block.sums(near, clusters)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met]), pa.array(sums[met].tolist(), pa.list_(pa.int64()))], ["cluster", "members", "sums"])

    exact = "decimal(38,0)"
    partial = packed.mapInArrow(run, "cluster long, members long, sums array<long>")
    cells = partial.select("cluster", "members", F.posexplode("sums").alias("d", "x"))
    added = cells.groupBy("cluster", "d").agg(F.sum("members").alias("n"), F.sum(F.col("x").cast(exact)).alias("x"))
    new = centroids.copy()
    for r in added.collect():  # clusters times dimensions
        new[r.cluster, r.d] = int(r.x) // r.n
    return new


def assign(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance (squared) of every packed vector."""
    kind = packed.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in _blocks(batches):
            near, distance = block.assign(centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(near, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return packed.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def cluster(vectors: DataFrame, clusters: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: str = "3", vector: str = "embedding", vec_id: str = "vec_id") -> tuple[DataFrame, DataFrame]:
    """(vec_id, cluster, distance of each vector; centroids: cluster, centroid as array<long>, cluster_inertia, inertia, both null in an empty cluster).

    size times the squares must fit a long: with LARGEST that holds up to 64 components.
    """
    if size > 64:
        raise ValueError("more than 64 components: distances may not fit a long")
    spark: SparkSession = vectors.sparkSession
    ship(spark)
    kept = quantised(vectors, size, scale, vector, vec_id)
    centroids = first_centroids(kept, clusters, seed)
    if not len(centroids):
        kind = kept.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), spark.createDataFrame([], "cluster int, centroid array<long>, cluster_inertia long, inertia long")
    packed = stored(pack(kept, size), "centroid-blocks")
    for _ in range(rounds):
        moved = next_centroids(packed, centroids)
        if (moved == centroids).all():  # so would every later round
            break
        centroids = moved
    assigned = stored(assign(packed, centroids), "centroid-clusters")
    total = lambda x: F.sum(x.cast("decimal(38,0)"))
    own = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(total(F.col("distance")).alias("s")).collect()}  # a row a cluster
    rows = [(i, c.tolist(), own.get(i), sum(own.values())) for i, c in enumerate(centroids)]
    return assigned, spark.createDataFrame(rows, "cluster int, centroid array<long>, cluster_inertia long, inertia long")


def centroid_digest(centroid: Column) -> Column:
    """SHA-256 of the components, as decimal integers joined by commas."""
    return F.sha2(F.array_join(centroid.cast("array<string>"), ","), 256)
