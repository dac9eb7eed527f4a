"""Exact top-k inner products by pivot-table elimination.

Distances of every vector to a set of pivots are computed once.  For a query q
and a candidate v the triangle inequality gives |q - v| >= max over pivots p of
| |q - p| - |v - p| |, hence an upper bound of the inner product,
(|q|^2 + |v|^2 - that^2) / 2.  Candidates are evaluated in the order of this
bound, and a query stops when the next bound is below its k-th score.

Queries and candidates meet in blocks of bounded size; each block pair gives
its own k best per query, of which the k best over all blocks remain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 48
CANDIDATES_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 2048
EVALUATE = 128  # candidates evaluated between two checks of the stopping rule

_TABLE = "vec_id long, dim int, v array<long>, pivot_distance array<double>"
_HITS = "query_id long, vector long, vec_id long, score long"
_HITS_ARROW = pa.schema([("query_id", pa.int64()), ("vector", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def integer_vectors(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """Vectors as floor(scale * x); those that are null or hold null or non-finite components are left out."""
    v = F.col(vector_column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(v.isNotNull() & finite).select(
        F.col(id_column).cast("long").alias("vec_id"), F.size(v).alias("dim"),
        F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("v"))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 1024,
    pivots: int = PIVOTS,
    candidates_per_block: int = CANDIDATES_PER_BLOCK,
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query, ties to the smaller id.

    ``is_query`` is a condition on the columns of ``vectors``.  A query's own
    row (same id) is no candidate; vectors of another length take no part; null
    ids take no part.  Fewer than k candidates are all returned.  Rows that
    repeat an id are candidates of their own; as queries, each different vector
    of an id has a ranking of its own, in rows of that id.
    """
    source = vectors.where(F.col(id_column).isNotNull())
    rows = integer_vectors(source, id_column, vector_column, scale)
    queries = integer_vectors(source.where(is_query), id_column, vector_column, scale).dropDuplicates(["vec_id", "v"])
    n = rows.count()
    chosen = [np.array(r["v"], np.float64) for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()]
    candidate_blocks = max(1, -(-n // candidates_per_block))
    query_blocks = max(1, -(-queries.count() // queries_per_block))

    spread = F.xxhash64("vec_id", "v")

    def table(df: DataFrame) -> DataFrame:
        return df.mapInArrow(lambda batches: _distances(batches, chosen), _TABLE).withColumn("vector", spread)

    left = table(queries).withColumns({
        "q": F.pmod(spread, F.lit(query_blocks)).cast("int"), "c": F.explode(F.sequence(F.lit(0), F.lit(candidate_blocks - 1))),
        "asks": F.lit(True)})
    right = table(rows).withColumns({
        "c": F.pmod(spread, F.lit(candidate_blocks)).cast("int"),
        "q": F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))), "asks": F.lit(False)})
    hits = left.unionByName(right).groupBy("dim", "q", "c").applyInArrow(lambda block: _search(block, k), _HITS)
    order = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score"))


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int, kind) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(rows, -1)


def _distances(batches: Iterator[pa.RecordBatch], pivots: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Vectors with their distances to the pivots: one matrix product per length of vector and batch."""
    for batch in batches:
        dim = batch.column("dim").to_numpy()
        far = np.zeros((len(dim), len(pivots)))
        flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
        begin = np.r_[0, np.cumsum(dim)[:-1]]
        for width in np.unique(dim).tolist():
            own = [i for i, p in enumerate(pivots) if len(p) == width]
            if not own or not width:
                continue
            rows, point = np.flatnonzero(dim == width), np.array([pivots[i] for i in own])
            x = flat[begin[rows][:, None] + np.arange(width)].astype(np.float64)
            if max(np.abs(x).max(), np.abs(point).max()) ** 2 * 4 * width < 1 << 53:  # then these sums are exact
                square = np.square(x).sum(axis=1)[:, None] + np.square(point).sum(axis=1) - 2 * (x @ point.T)
            else:
                square = np.stack([np.square(x - p).sum(axis=1) for p in point], axis=1)
            far[np.ix_(rows, own)] = np.sqrt(square)
        offsets = pa.array(np.arange(len(dim) + 1, dtype=np.int32) * len(pivots))
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("dim"), batch.column("v"), pa.ListArray.from_arrays(offsets, pa.array(far.ravel()))],
            names=["vec_id", "dim", "v", "pivot_distance"])


def _search(block: pa.Table, k: int) -> pa.Table:
    """The k best candidates of one candidate block for each query of one query block."""
    asks = block.column("asks").to_numpy()
    if not asks.any() or asks.all():
        return _HITS_ARROW.empty_table()
    ids, vector = block.column("vec_id").to_numpy(), block.column("vector").to_numpy()
    v = _matrix(block.column("v"), len(ids), np.int64)
    far = _matrix(block.column("pivot_distance"), len(ids), np.float64)
    # doubles hold these integers exactly unless components are huge
    exact = v.astype(np.float64) if v.size == 0 or np.abs(v).max() < 1 << 20 else v
    square = np.square(v.astype(np.float64)).sum(axis=1)
    there = np.flatnonzero(~asks)
    cand, cand_far, cand_square, cand_ids = exact[there], far[there], square[there], ids[there]
    found = []
    for i in np.flatnonzero(asks):
        gap = np.abs(cand_far - far[i]).max(axis=1) if cand_far.shape[1] else np.zeros(len(there))
        bound = (square[i] + cand_square - np.square(gap)) / 2
        bound += 1e-9 * (square[i] + cand_square) + 1e-6  # rounding of the bound never eliminates a hit
        order = np.argsort(-bound, kind="stable")
        best_score, best_id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for start in range(0, len(order), EVALUATE):
            if len(best_score) == k and bound[order[start]] < best_score[-1]:
                break
            some = order[start : start + EVALUATE]
            some = some[cand_ids[some] != ids[i]]
            score = np.concatenate([best_score, (cand[some] @ exact[i]).astype(np.int64)])
            who = np.concatenate([best_id, cand_ids[some]])
            keep = np.lexsort((who, -score))[:k]
            best_score, best_id = score[keep], who[keep]
        found.append((np.full(len(best_id), ids[i]), np.full(len(best_id), vector[i]), best_id, best_score))
    return pa.table([np.concatenate(c) for c in zip(*found, strict=True)], schema=_HITS_ARROW)
