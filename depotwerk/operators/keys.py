"""Natural key -> surrogate key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import BROADCAST_ROWS, PIECES, lookup


@dataclass(frozen=True)
class KeyTable:
    """Two-column table (``code``, ``id``), one row per code, with a known row count."""

    table: DataFrame
    rows: int

    @classmethod
    def build(cls, dim: DataFrame, code: str, sk: str) -> KeyTable:
        """Current rows of a dimension; the lowest key wins where a code repeats.

        Two columns and one row per code, so the count behind the broadcast
        decision covers exactly what would be broadcast.
        """
        table = (
            dim.where((F.col("ist_aktuell") == "J") & F.col(code).isNotNull())
            .groupBy(F.col(code).alias("code"))
            .agg(F.min(sk).cast("bigint").alias("id"))
        )
        return cls(table, table.count())

    @classmethod
    def sectors(cls, branche: DataFrame) -> KeyTable:
        """GICS sector code or internal code; a GICS code wins over an equal internal one.

        Both codes go into one lookup, so the join stays an equality join.
        """
        current = branche.where(F.col("ist_aktuell") == "J")
        codes = current.select(F.col("gics_sektor_code").alias("code"), "branche_id", F.lit(0).alias("art")).unionAll(
            current.select(F.col("branche_intern_code"), "branche_id", F.lit(1))
        )
        table = (
            codes.where(F.col("code").isNotNull())
            .groupBy("code")
            .agg(F.min(F.struct("art", "branche_id"))["branche_id"].cast("bigint").alias("id"))
        )
        return cls(table, table.count())


def with_key(
    rows: DataFrame,
    keys: KeyTable,
    code: Column | str,
    into: str,
    *,
    spread_by: Sequence[str],
    max_rows: int = BROADCAST_ROWS,
    pieces: int = PIECES,
) -> DataFrame:
    """Add the surrogate key of ``code`` as ``into``; unknown codes give NULL."""
    code = F.col(code) if isinstance(code, str) else code
    return (
        lookup(
            rows.withColumn("__code", code),
            keys.table.withColumnsRenamed({"code": "__code", "id": into}),
            ["__code"],
            spread_by=spread_by,
            table_rows=keys.rows,
            max_rows=max_rows,
            pieces=pieces,
        ).drop("__code")
    )
