"""Key joins that stay balanced when one key holds a large share of the rows.

``lookup`` first counts the lookup side.  Up to a bound of rows and of
estimated bytes it is broadcast and the rows never move.  Beyond that the rows
are shuffled by key and piece: a row's piece comes from its other columns, and
every lookup row is copied once per piece.  So a hot key is spread whatever it
is, and each lookup uses the rows once: a chain of lookups reads its input once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds of a broadcast: rows, and bytes at the widths below.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 << 20
# Pieces of a key in a shuffle join.  Adaptive skew handling splits further.
PIECES = 16

# Of a key that is counted as hot: rows for one task, pieces, and keys that are looked at.
ROWS_PER_PIECE = 1_000_000
MOST_PIECES = 4096
HOT_KEYS = 1024

_PIECE = "__teil"


def row_bytes(schema: T.StructType) -> int:
    """Estimated width of a row: declared or assumed text lengths, eight bytes for the rest."""
    def width(kind: T.DataType) -> int:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return getattr(kind, "length", None) or 64
        if isinstance(kind, T.StructType):
            return sum(width(f.dataType) for f in kind.fields)
        return 16
    return sum(width(f.dataType) for f in schema.fields)


def small_enough(table: DataFrame, max_rows: int = BROADCAST_ROWS, rows: int | None = None) -> bool:
    """Whether a table may be broadcast; ``rows`` is an upper bound of its size, counted if not given."""
    rows = table.count() if rows is None else rows
    return rows <= max_rows and rows * row_bytes(table.schema) <= BROADCAST_BYTES


def lookup(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    *,
    spread_by: Sequence[str],
    table_rows: int | None = None,
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    pieces: int = PIECES,
) -> DataFrame:
    """Join ``table`` (one row per key) to ``rows``.

    ``spread_by`` names columns that tell the rows of one key apart; they
    decide the piece of a row.  ``table_rows`` is an upper bound of the
    table size when the caller knows one, which saves the count.  Rows that are
    a slice of a larger table, over whose slices a key is spread already, need
    fewer ``pieces``.
    """
    if small_enough(table, max_rows, table_rows):
        return rows.join(F.broadcast(table), list(on), how)
    return split_hot_join(rows, table, on, spread_by=spread_by, how=how, pieces=pieces)


def split_hot_join(
    rows: DataFrame, table: DataFrame, on: Sequence[str], *, spread_by: Sequence[str], how: str = "left",
    pieces: int = PIECES,
) -> DataFrame:
    """Shuffle join in which every key is cut into ``pieces``, NULL keys too.

    The hint keeps Spark from broadcasting the copies: its estimate comes from
    the size of compressed files and knows nothing of how often a row is copied.
    """
    left = rows.withColumn(_PIECE, F.pmod(F.xxhash64(*spread_by), F.lit(pieces)).cast("int"))
    right = table.withColumn(_PIECE, F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    return left.join(right.hint("merge"), [*on, _PIECE], how).drop(_PIECE)


def fits_tasks(rows: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_PIECE) -> bool:
    """Whether no key, NULL included, has more rows than one task should take.  Counts the rows of every key."""
    return rows.groupBy(*on).agg(F.count("*").alias("__zeilen")).where(F.col("__zeilen") > rows_per_task).isEmpty()


def hot_keys(rows: DataFrame, on: Sequence[str], rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """(on, __teile): keys with more rows than one task should take, and into how many pieces to cut them.

    At most ``HOT_KEYS``, the largest: that bounds the table, which is broadcast.
    What is beyond is even enough for adaptive skew handling.
    """
    counts = rows.groupBy(*on).agg(F.count("*").alias("__zeilen")).where(F.col("__zeilen") > rows_per_piece)
    pieces = F.least(F.ceil(F.col("__zeilen") / rows_per_piece), F.lit(MOST_PIECES)).cast("int")
    largest = counts.orderBy(F.desc("__zeilen"), *on).limit(HOT_KEYS).select(*on, pieces.alias("__teile")).collect()
    schema = T.StructType([*[rows.schema[c] for c in on], T.StructField("__teile", T.IntegerType())])
    return rows.sparkSession.createDataFrame(largest, schema)


def split_hot(
    rows: DataFrame, table: DataFrame, on: Sequence[str], hot: DataFrame, *, spread_by: Sequence[str]
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a join and its columns, with the hot keys cut into pieces.

    Only the hot keys' rows of ``table`` are copied, once per piece.
    """
    marks = {c: f"__heiss_{c}" for c in on}
    hot = F.broadcast(hot.withColumnsRenamed(marks))

    def marked(side: DataFrame) -> DataFrame:
        same = F.lit(True)
        for c, mark in marks.items():
            same = same & F.col(c).eqNullSafe(F.col(mark))
        return side.join(hot, same, "left").drop(*marks.values())

    pieces = F.coalesce("__teile", F.lit(1))
    left = marked(rows).withColumn(_PIECE, F.pmod(F.xxhash64(*spread_by), pieces).cast("int")).drop("__teile")
    right = marked(table).withColumn(_PIECE, F.explode(F.sequence(F.lit(0), pieces - 1))).drop("__teile")
    return left, right, [*on, _PIECE]


def anti(rows: DataFrame, existing: DataFrame, on: Sequence[str], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose key is absent from ``existing``.

    The large table of existing keys is first reduced to the keys that occur
    in ``rows``: by a broadcast semi join when the row keys are few, otherwise
    by a shuffle semi join that Spark can prune with a runtime bloom filter.
    """
    keys = rows.select(*on).distinct()
    if small_enough(keys, max_rows):
        keys = F.broadcast(keys)
    present = existing.select(*on).join(keys, list(on), "left_semi").distinct()
    return rows.join(present, list(on), "left_anti")


def null_safe(left: str, right: str, on: Sequence[str]) -> Column:
    """Key equality in which two NULLs match, between two aliased frames."""
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return condition
