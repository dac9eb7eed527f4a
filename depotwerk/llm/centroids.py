"""Clustering of integer vectors around centroids, by dictionaries of subvectors.

Vectors are cut into blocks of a few dimensions.  Each chunk of vectors keeps,
as a dictionary page of a columnar file does, the distinct subvectors of each
block and one small code per vector and block; nothing is rounded.  A round
computes the exact squared distance of every dictionary entry to every
centroid's block once, and a vector's distance is the sum of its codes'
entries.  New centroids come from counts per (cluster, code), not from the
vectors.  A dictionary belongs to its chunk because one over all vectors
grows with the data and could be neither broadcast nor held by a task.

The chunks are written once and read in every round; only the centroids,
``clusters * dimensions`` numbers, pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

CHUNK = 1 << 15  # vectors that share dictionaries; codes have 16 bits
BLOCK = 2  # dimensions of a subvector
LARGEST = 1 << 24  # of a component: sums of 2^14 squared differences still fit 63 bits

_ENCODED = "ids array<long>, sizes array<int>, entries binary, codes binary"
_RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


# ---------------------------------------------------------------- dictionaries


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of an integer matrix, and the number of its row for each input row."""
    code = np.zeros(len(rows), np.int64)
    first = np.zeros(min(1, len(rows)), np.int64)
    for column in rows.T:
        values, own = np.unique(column, return_inverse=True)
        _, first, code = np.unique(code * len(values) + own, return_index=True, return_inverse=True)
    return rows[first], code


def encode_chunk(vectors: np.ndarray, block: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Per block its distinct subvectors, and the codes (blocks x vectors)."""
    entries, codes = [], []
    for at in range(0, vectors.shape[1], block):
        different, code = distinct_rows(vectors[:, at : at + block])
        entries.append(different)
        codes.append(code.astype(np.uint16))
    return entries, np.array(codes, np.uint16)


def decode_row(sizes: np.ndarray, entries: bytes, codes: bytes, dimensions: int, block: int) -> tuple[list[np.ndarray], np.ndarray]:
    flat, parts, at = np.frombuffer(entries, np.int32).astype(np.int64), [], 0
    for size, width in zip(sizes, _widths(dimensions, block), strict=True):
        parts.append(flat[at : at + size * width].reshape(size, width))
        at += size * width
    return parts, np.frombuffer(codes, np.uint16).reshape(len(parts), -1)


def _widths(dimensions: int, block: int) -> list[int]:
    return [min(block, dimensions - at) for at in range(0, dimensions, block)]


def nearest(entries: list[np.ndarray], codes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the squared distance, per vector."""
    total, at = np.zeros((codes.shape[1], len(centroids)), np.int64), 0
    for different, code in zip(entries, codes, strict=True):
        part = centroids[:, at : at + different.shape[1]]
        total += np.square(different[:, None, :] - part[None]).sum(axis=2)[code]
        at += different.shape[1]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(total)), cluster]


def sums_by_cluster(entries: list[np.ndarray], codes: np.ndarray, cluster: np.ndarray, clusters: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors per cluster, and the sum of their components, from counts per code."""
    parts = []
    for different, code in zip(entries, codes, strict=True):
        n = len(different)
        met = np.bincount(cluster * n + code, minlength=clusters * n).reshape(clusters, n)
        parts.append(met @ different)
    return np.bincount(cluster, minlength=clusters), np.concatenate(parts, axis=1)


# ---------------------------------------------------------------- Spark


def _whole(embedding: Column, dimensions: int, scale: int) -> Column:
    """The vector as integers, null if it takes no part; a component beyond ``LARGEST`` is an error."""
    scaled = F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x))
    taken = (F.size(embedding) == dimensions) & F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    small = F.forall(embedding, lambda x: F.abs(x) * scale <= LARGEST)
    return F.when(taken, F.when(small, scaled).otherwise(
        F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}")).cast("array<bigint>")))


def _encoded(vectors: DataFrame, dimensions: int, block: int) -> DataFrame:
    """One row per chunk of vectors: ids, sizes of the dictionaries, their entries, codes."""

    def row(ids: list[pa.Array], parts: list[np.ndarray]) -> pa.RecordBatch:
        entries, codes = encode_chunk(np.concatenate(parts), block)
        raw = b"".join(e.astype(np.int32).tobytes() for e in entries)
        return pa.RecordBatch.from_pylist(
            [{"ids": pa.concat_arrays(ids).to_pylist(), "sizes": [len(e) for e in entries], "entries": raw, "codes": codes.tobytes()}],
            pa.schema([("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("entries", pa.binary()), ("codes", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        parts: list[np.ndarray] = []
        for batch in batches:
            while batch.num_rows:
                some = batch.slice(0, CHUNK - sum(map(len, ids)))
                ids.append(some.column("vec_id"))
                parts.append(some.column("v").flatten().to_numpy().reshape(-1, dimensions))
                batch = batch.slice(some.num_rows)
                if sum(map(len, ids)) == CHUNK:
                    yield row(ids, parts)
                    ids, parts = [], []
        if ids:
            yield row(ids, parts)

    return vectors.mapInArrow(run, _ENCODED)


@dataclass(frozen=True)
class Clustering:
    """Encoded vectors and the centroids found for them."""

    encoded: DataFrame
    centroids: list[list[int]]
    dimensions: int
    block: int

    def _chunks(self, batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                sizes = batch.column("sizes")[i].values.to_numpy()
                yield batch.column("ids")[i].values, decode_row(
                    sizes, batch.column("entries")[i].as_py(), batch.column("codes")[i].as_py(), self.dimensions, self.block)

    def assigned(self) -> DataFrame:
        """vec_id, cluster, distance (squared) of every vector."""
        chunks, centroids = _reader(self), np.array(self.centroids, np.int64)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, (entries, codes) in chunks(batches):
                cluster, distance = nearest(entries, codes, centroids)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

        return self.encoded.mapInArrow(run, "vec_id long, cluster int, distance long")

    def moved(self) -> Clustering:
        """One round: non-empty centroids become the floor of the mean of their vectors."""
        chunks, centroids = _reader(self), np.array(self.centroids, np.int64)
        k = len(centroids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count, total = np.zeros(k, np.int64), np.zeros(centroids.shape, np.int64)
            for _, (entries, codes) in chunks(batches):
                some, part = sums_by_cluster(entries, codes, nearest(entries, codes, centroids)[0], k)
                count, total = count + some, total + part
            met = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(met.astype(np.int32)), pa.array(count[met]), pa.array(total[met].tolist(), pa.list_(pa.int64()))],
                names=["cluster", "n", "total"])

        sums = (
            self.encoded.mapInArrow(run, "cluster int, n long, total array<long>")
            .select("cluster", "n", F.posexplode("total").alias("dimension", "x"))
            .groupBy("cluster", "dimension").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
        )
        after = [list(c) for c in self.centroids]
        for r in sums.collect():  # clusters x dimensions rows at most
            after[r.cluster][r.dimension] = r.x // r.n
        return Clustering(self.encoded, after, self.dimensions, self.block)


def _reader(clustering: Clustering):
    """Chunks of a batch, without the DataFrame in the closure."""
    return Clustering(None, [], clustering.dimensions, clustering.block)._chunks  # type: ignore[arg-type]


def fit(
    vectors: DataFrame, *, clusters: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64, seed: int = 1,
    block: int = BLOCK, id_column: str = "vec_id", vector_column: str = "embedding",
) -> Clustering:
    """Centroids after ``rounds`` rounds over all vectors.

    A component x counts as floor(scale * x).  Vectors that are null, have
    another length, or hold a null or non-finite component take no part;
    components of more than ``LARGEST`` after scaling are an error, as their
    distances need not fit a long.  The first centroids are the ``clusters``
    vectors (all, if fewer) whose ``seed:id`` has the smallest SHA-256; rows
    with the same id follow by their components, a null id counts as empty.
    Equal vectors each count.  Only the two columns named are read.
    """
    embedding = F.col(vector_column).cast("array<double>")
    whole = vectors.select(F.col(id_column).cast("long").alias("vec_id"), _whole(embedding, dimensions, scale).alias("v")).where("v is not null")
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = whole.select(named.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    found = Clustering(written(_encoded(whole, dimensions, block)), [list(r.v) for r in first], dimensions, block)
    for _ in range(rounds if first else 0):
        found = found.moved()
    return found


def cluster(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row per vector that takes part.

    Inertia is the squared distance summed over the vector's cluster, and over
    all vectors.  The digest is that of the centroid's components as decimal
    numbers joined by commas.  Options are those of :func:`fit`; without
    vectors the result is empty.
    """
    found = fit(vectors, **options)
    spark = vectors.sparkSession
    if not found.centroids:
        return spark.createDataFrame([], _RESULT)
    assigned = written(found.assigned())
    inertia = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())  # a row per cluster
    whole = sum(inertia.values())
    table = spark.createDataFrame(
        [(i, inertia[i], whole, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
         for i, c in enumerate(found.centroids) if i in inertia],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
