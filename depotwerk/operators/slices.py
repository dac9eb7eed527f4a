"""Work done on one slice of the rows after the other.

A job keeps what it shuffles until it ends, so a chain of shuffles takes the
disk of all of them at once.  Where rows only meet others that agree in some
columns, they can be cut by a hash of these columns and worked on slice by
slice: then the disk holds the shuffles of one slice and the results so far.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import nullable

# Up to so many rows are one slice.  Every slice reads the input again, so there is a bound of slices.
ROWS_PER_SLICE = 2_000_000
MOST_SLICES = 8

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def slice_count(rows: DataFrame, rows_per_slice: int = ROWS_PER_SLICE, most: int = MOST_SLICES) -> int:
    """Into how many slices to cut ``rows``, which are counted."""
    return max(1, min(most, math.ceil(rows.count() / rows_per_slice)))


def cut(rows: DataFrame, by: Sequence[str], n: int) -> list[DataFrame]:
    """``rows`` in ``n`` slices; rows that agree in ``by``, NULL included, lie in the same one."""
    place = F.pmod(F.xxhash64(*by), F.lit(n))
    return [rows.where(place == i) for i in range(n)]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a query in here shuffles goes when it ends, and not when the driver next collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def slice_by_slice(
    slices: Sequence[DataFrame],
    build: Callable[[DataFrame, Callable[[DataFrame], DataFrame]], DataFrame],
    folder: str,
    drop: Callable[[str], None],
) -> DataFrame:
    """The results of ``build`` for all slices; each is written to ``folder`` before the next slice is begun.

    ``build`` gets a slice and a function that stores rows it uses twice; these
    rows are dropped, by ``drop``, when the slice is done.
    """
    work, results = f"{folder}/arbeit", f"{folder}/ergebnis"

    def stored(rows: DataFrame) -> DataFrame:
        path = f"{work}/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return rows.sparkSession.read.schema(nullable(rows.schema)).parquet(path)

    for part in slices:
        with shuffles_dropped(part.sparkSession):
            done = build(part, stored)
            done.write.mode("append").option("compression", "zstd").parquet(results)
        drop(work)
    return done.sparkSession.read.schema(nullable(done.schema)).parquet(results)
