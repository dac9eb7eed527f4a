"""Surrogate keys.

``number_rows`` gives gap-free numbers in a stated order (new dimension rows).
``arrival_ids`` numbers rows in the order of delivery without moving a row
(staged, validated and fact rows).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# monotonically_increasing_id() keeps the position inside the task in 33 bits.
_POSITION_BITS = 33

# File and part of the file a row comes from.
ARRIVAL = ("__datei", "__block")


def number_rows(
    df: DataFrame, order_by: Sequence[str], into: str, *, start: int = 1, partitions: int | None = None
) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in the order of ``order_by`` (unique).

    The rows are range-partitioned and sorted, then checkpointed, so that a
    retried task cannot see another order.  Only the row counts per partition
    come to the driver; each partition then counts on from its own offset.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ranged = (
        df.repartitionByRange(partitions, *order_by)
        if partitions
        else df.repartitionByRange(*[F.col(c) for c in order_by])
    )
    fixed = ranged.sortWithinPartitions(*order_by).checkpoint(eager=True)

    part = F.spark_partition_id()
    sizes = sorted((r["p"], r["n"]) for r in fixed.groupBy(part.alias("p")).count()
                   .withColumnRenamed("count", "n").collect())
    offsets, total = [], start
    for p, n in sizes:
        offsets.append((p, total))
        total += n
    if not offsets:
        return fixed.withColumn(into, F.lit(None).cast("bigint"))
    position = F.monotonically_increasing_id().bitwiseAND((1 << _POSITION_BITS) - 1)
    numbered = fixed.withColumn("__p", part).withColumn("__pos", position)
    table = spark.createDataFrame(offsets, "__p int, __start bigint")
    return (
        numbered.join(F.broadcast(table), "__p")
        .withColumn(into, F.col("__start") + F.col("__pos"))
        .drop("__p", "__pos", "__start")
    )


def with_arrival(df: DataFrame) -> DataFrame:
    """Rows of a file scan with the file and the part of it they come from."""
    return df.withColumns({
        ARRIVAL[0]: F.col("_metadata.file_path"), ARRIVAL[1]: F.col("_metadata.file_block_start")})


def arrival_ids(df: DataFrame, into: str, reserve: Callable[[int], int]) -> DataFrame:
    """Gap-free ids in the order of delivery: file name, then position in the file.

    ``df`` carries the columns of :func:`with_arrival` (dropped here) and only
    narrow operations after the scan.  ``reserve(n)`` sets ``n`` numbers aside
    and returns the first.  Row counts per file part come to the driver, no row
    moves, and neither rows, tasks nor loads are limited.
    """
    marked = df.withColumn("__stelle", F.monotonically_increasing_id())
    parts = marked.groupBy(*ARRIVAL).agg(F.count("*").alias("n"), F.min("__stelle").alias("erste")).collect()
    parts.sort(key=lambda r: (r[ARRIVAL[0]], r[ARRIVAL[1]]))
    number = reserve(sum(r["n"] for r in parts))
    shifts = []
    for r in parts:
        shifts.append((r[ARRIVAL[0]], r[ARRIVAL[1]], number - r["erste"]))
        number += r["n"]
    table = df.sparkSession.createDataFrame(shifts, f"{ARRIVAL[0]} string, {ARRIVAL[1]} bigint, __versatz bigint")
    return (
        marked.join(F.broadcast(table), list(ARRIVAL))  # one row per file part
        .withColumn(into, F.col("__stelle") + F.col("__versatz"))
        .drop("__stelle", "__versatz", *ARRIVAL)
    )


def next_number(df: DataFrame, column: str) -> int:
    """``max + 1``, or 1 for an empty table."""
    return df.select(F.coalesce(F.max(column), F.lit(0)) + 1).first()[0]
