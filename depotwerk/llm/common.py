"""What the operators share: tables, written intermediate results, and text as arrays of bytes.

Texts reach Python as Arrow batches.  ``blocks`` cuts a batch into pieces of
bounded size, so the memory of a task does not depend on how long texts are
(one text is never cut: the largest text plus the bound is what a task holds).
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

BLOCK_BYTES = 4 << 20
BITS = 1 << 26  # of a table that lets few hashes pass

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_CODES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def ship(spark: SparkSession) -> None:
    """Give the package to the executors, unless PYTHONPATH already names its folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    context = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_depotwerk_shipped", False):
        return
    # Spark copies the archive from the driver to every executor
    name = os.path.join(tempfile.mkdtemp(prefix="depotwerk-"), "depotwerk")
    context.addPyFile(shutil.make_archive(name, "zip", root, "depotwerk"))
    context._depotwerk_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read again.

    Later stages and lost executors read the files instead of repeating the
    work.  The folder belongs to the cluster, which clears it after the job.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_bucket(column: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``: splits learned from held-out rows."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % buckets


class Passing:
    """Table of bits, two for each hash: whether a hash may be in the set."""

    def __init__(self, table: np.ndarray):
        self.table = table

    def __call__(self, h: np.ndarray) -> np.ndarray:
        hit = np.ones(len(h), bool)
        for shift in (0, 32):
            bit = (h >> np.uint64(shift)) & np.uint64(64 * len(self.table) - 1)
            hit &= (self.table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return hit


def bit_table(hashes: DataFrame) -> np.ndarray:
    """The table for the column ``hash``: Spark sets the bits, at most ``BITS / 64`` numbers reach the driver."""
    filled = (
        hashes.select(F.explode(F.array(*[F.shiftrightunsigned("hash", s).bitwiseAND(F.lit(BITS - 1)) for s in (0, 32)])).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("at"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 AS int)))").alias("bits"))
        .toArrow()
    )
    table = np.zeros(BITS // 64, np.uint64)
    table[filled.column("at").to_numpy()] = filled.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return table


def blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of ``column`` (or one row)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(np.asarray(lengths(batch.column(column))))
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def lengths(values: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def as_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values one after another as bytes, and where each begins (with the end of the last); null is empty."""
    sizes = lengths(values)
    kind = pa.large_binary() if pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type) else pa.binary()
    values = values.cast(kind)
    at = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    if values.null_count:
        values = values.fill_null(b"")
    width = np.int64 if kind == pa.large_binary() else np.int32
    raw = values.buffers()
    if len(values) == 0 or raw[2] is None:
        return np.zeros(0, np.uint8), at
    begin = int(np.frombuffer(raw[1], width)[values.offset])
    return np.frombuffer(raw[2], np.uint8)[begin : begin + int(at[-1])], at


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the splitmix64 finish)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Prefixes:
    """Hash of any stretch of a byte array in constant time (polynomial in the ring of 64-bit numbers)."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        n = len(data)
        codes = _BYTE_CODES if not seed else mix(_BYTE_CODES + np.uint64(seed))
        powers = np.empty(n + 1, np.uint64)
        powers[0] = 1
        powers[1:] = _BASE
        np.cumprod(powers, out=powers)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes[data] * powers[:n], out=self.sums[1:])
        powers[1:] = _BASE_INVERSE
        np.cumprod(powers, out=powers)
        self.back = powers

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = (end - start).astype(np.uint64)
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + size)


def word_bounds(data: np.ndarray, at: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of bytes not in ``between``, and per text the index of its first word (with the total)."""
    gap = between[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    full = ~gap
    starts = full.copy()
    starts[1:] &= gap[:-1] | edge[1:-1]
    ends = full
    ends[:-1] &= gap[1:] | edge[1:-1]
    begin = np.flatnonzero(starts)
    return begin, np.flatnonzero(ends) + 1, np.searchsorted(begin, at)


def window_extremes(values: np.ndarray, width: int, largest: bool = False) -> np.ndarray:
    """Smallest (or largest) of every ``width`` neighbours, by doubling."""
    pick = np.maximum if largest else np.minimum
    out, done = values, 1
    while 2 * done <= width:
        out, done = pick(out[:-done], out[done:]), 2 * done
    rest = width - done
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def window_anchors(values: np.ndarray, low: np.ndarray, width: int) -> np.ndarray:
    """Positions that are the smallest of some window; ``low`` holds the smallest of each window."""
    pad = np.zeros(width - 1, values.dtype)
    return np.flatnonzero(values == window_extremes(np.concatenate([pad, low, pad]), width, largest=True))


def leftmost_anchor(values: np.ndarray, anchors: np.ndarray, low: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Where each of the windows has its smallest value first."""
    index = np.searchsorted(anchors, window)
    wrong = values[anchors[index]] != low[window]
    while wrong.any():
        index[wrong] += 1
        wrong = values[anchors[index]] != low[window]
    return anchors[index]
