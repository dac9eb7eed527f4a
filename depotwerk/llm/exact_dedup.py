"""Exact deduplication by sorting the content.

Normalised texts are range-partitioned by sampled splitters and sorted, so
equal texts become neighbours; neighbours are compared in full.  The sort key
is (first bytes, SHA-256, id): short enough for splitters that the driver can
hold, and with the id as last part a text that fills a third of the table is
spread over many partitions instead of one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

HEAD = 32  # characters of the text at the front of the sort key

_RUNS = "doc_id long, text_sha256 string, first_id long, n long, edge boolean, head boolean"
_ARROW = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("first_id", pa.int64()), ("n", pa.int64()),
                    ("edge", pa.bool_()), ("head", pa.bool_())])


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, the id that stays, group size, whether it stays, SHA-256 of the normalised text.

    Null and empty texts are equal.  A null id is never smaller than another
    id; of rows that repeat an id with the same text all say ``kept``.
    Empty tables give no rows.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), normalised(F.col(text_column)).alias("body")
    ).withColumn("text_sha256", F.sha2("body", 256))
    key = [F.substring("body", 1, HEAD), F.col("text_sha256"), F.col("doc_id").asc_nulls_last()]
    ordered = rows.repartitionByRange(*key).sortWithinPartitions(*key)
    # only boundary runs are incomplete: two per partition at most
    runs = written(ordered.mapInArrow(_runs, _RUNS))
    edges = (
        runs.where("edge and head")
        .groupBy("text_sha256")
        .agg(F.sum("n").alias("all_n"), F.min("first_id").alias("all_first"))
    )
    return runs.join(F.broadcast(edges), "text_sha256", "left").select(
        "doc_id",
        F.coalesce("all_first", "first_id").alias("keep_id"),
        F.coalesce("all_n", "n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.coalesce("all_first", "first_id")).alias("kept"),
        "text_sha256",
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each run of equal neighbours with its first id and length.

    A run may span batches; only its ids are held until it ends.  The first
    and the last run of a partition may go on in the next one: ``edge``.
    """
    last, held, sha, opening = None, [], None, True

    def close(edge: bool) -> pa.RecordBatch:
        ids = pa.concat_arrays(held)
        n = len(ids)
        head = np.zeros(n, bool)
        head[0] = True
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([sha] * n, pa.string()), pa.array([ids[0].as_py()] * n, pa.int64()),
             pa.array(np.full(n, n)), pa.array(np.full(n, edge)), pa.array(head)], schema=_ARROW)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        body, ids, shas = batch.column("body"), batch.column("doc_id"), batch.column("text_sha256")
        new = np.ones(n, bool)
        if n > 1:
            new[1:] = ~pc.equal(body.slice(1), body.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        if last is not None:
            new[0] = body[0].as_py() != last
        last = body[n - 1].as_py()
        starts = np.flatnonzero(new)
        if not len(starts):
            held.append(ids)
            continue
        if held:
            if starts[0]:
                held.append(ids.slice(0, int(starts[0])))
            yield close(opening)
            opening = False
        if len(starts) > 1:  # runs that lie within the batch
            begin, sizes = starts[:-1], np.diff(starts)
            lo, hi = int(starts[0]), int(starts[-1])
            first = ids.take(pa.array(begin))
            owner = np.repeat(np.arange(len(begin)), sizes)
            edge = np.zeros(hi - lo, bool)
            if opening:
                edge[: sizes[0]] = True
                opening = False
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), shas.slice(lo, hi - lo), first.take(pa.array(owner)),
                 pa.array(sizes[owner].astype(np.int64)), pa.array(edge), pa.array(new[lo:hi])], schema=_ARROW)
        tail = int(starts[-1])
        held, sha = [ids.slice(tail)], shas[tail].as_py()
    if held:
        yield close(True)
