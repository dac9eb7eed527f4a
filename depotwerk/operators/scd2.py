"""Versioned dimensions (SCD type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import moment
from ..schemas import nullable
from .joins import BROADCAST_ROWS, ROWS_PER_PIECE, hot_keys, small_enough, split_hot

OPEN_END = date(9999, 12, 31)
BIN_DAYS = 366  # of a point-in-time join by shuffle


@dataclass(frozen=True)
class Scd2Result:
    """``kept`` rows are untouched, ``closed`` rows end now, ``inserted`` rows have no key yet."""

    kept: DataFrame
    closed: DataFrame
    inserted: DataFrame

    def snapshot(self) -> DataFrame:
        return self.kept.unionByName(self.closed).unionByName(self.inserted)


def _differs(tracked: Sequence[str]) -> Column:
    """Null-safe inequality in any tracked column of aliases ``alt`` and ``neu``."""
    return reduce(
        lambda a, b: a | b,
        [~F.col(f"alt.{c}").eqNullSafe(F.col(f"neu.{c}")) for c in tracked],
    )


def scd2(
    dim: DataFrame,
    batch: DataFrame,
    *,
    key: str,
    sk: str,
    tracked: Sequence[str],
    run_date: date,
    run_ts: datetime,
    batch_id: int,
    max_rows: int = BROADCAST_ROWS,
) -> Scd2Result:
    """Close current rows that changed and open a new version for changed and new keys.

    ``batch`` holds the accepted rows of one delivery with the columns of
    ``dim``, one row per key.  Only ``tracked`` columns open a new version;
    other changes are ignored.  Keys missing from the batch stay current.
    A second load on the same day leaves ``gueltig_bis`` one day before
    ``gueltig_von`` on the closed row; point-in-time reads skip such rows.

    History rows take no part in the joins except for one narrow aggregate of
    the version numbers, which combines before the shuffle.
    """
    delivered = F.broadcast(batch) if small_enough(batch, max_rows) else batch

    # a row without a flag is not current
    current = F.coalesce("ist_aktuell", F.lit("N")) == "J"
    history = dim.where(~current)
    compared = (
        dim.where(current).alias("alt")
        .join(
            delivered.select(key, *tracked, F.lit(True).alias("__da")).alias("neu"),
            F.col(f"alt.{key}") == F.col(f"neu.{key}"),
            "left",
        )
        .select(
            "alt.*",
            (F.coalesce(F.col("neu.__da"), F.lit(False)) & _differs(tracked)).alias("__anders"),
        )
    )
    unchanged = compared.where(~F.col("__anders")).drop("__anders")
    closed = (
        compared.where("__anders").drop("__anders")
        .withColumns({
            "gueltig_bis": F.date_sub(F.lit(run_date), 1),
            "ist_aktuell": F.lit("N"),
            "geaendert_am": moment(run_ts),
            "batch_id_geaendert": F.lit(batch_id).cast("bigint"),
        })
    )

    # per delivered key: newest version, and whether a current row stays
    state = (
        dim.select(key, "dwh_version", F.lit(False).alias("__bleibt"))
        .unionByName(unchanged.select(key, "dwh_version", F.lit(True).alias("__bleibt")))
        .join(delivered.select(key), key, "left_semi")
        .groupBy(key)
        .agg(F.max("dwh_version").alias("__letzte"), F.bool_or("__bleibt").alias("__bleibt"))
    )
    fresh = batch.join(state, key, "left").where(~F.coalesce("__bleibt", F.lit(False)))
    values = {
        sk: F.lit(None).cast("bigint"),
        "gueltig_von": F.lit(run_date),
        "gueltig_bis": F.lit(OPEN_END),
        "ist_aktuell": F.lit("J"),
        "dwh_version": F.coalesce(F.col("__letzte") + 1, F.lit(1)),
        "erstellt_am": moment(run_ts),
        "geaendert_am": moment(run_ts),
        "batch_id_erstellt": F.lit(batch_id),
        "batch_id_geaendert": F.lit(batch_id),
    }
    inserted = fresh.withColumns(values).to(nullable(dim.schema))
    return Scd2Result(history.unionByName(unchanged), closed, inserted)


def version_at(dim: DataFrame, on: date | Column) -> DataFrame:
    """Rows valid on a date.  Empty intervals (end before start) never match."""
    day = on if isinstance(on, Column) else F.lit(on)
    return dim.where(day.between(F.col("gueltig_von"), F.col("gueltig_bis")))


def point_in_time(
    rows: DataFrame, dim: DataFrame, *, key: str, on_date: str, take: Sequence[str],
    spread_by: Sequence[str] | None = None, max_rows: int = BROADCAST_ROWS, bin_days: int = BIN_DAYS,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Attach the dimension version valid on each row's own date.

    A version list within the broadcast bound meets the rows where they are.
    Beyond that both sides are shuffled by key and bin of ``bin_days`` days: a
    version lies in every bin that it shares with the dates of the rows, a row
    in one.  Keys with many rows are cut into pieces; ``spread_by`` (all
    columns) tells their rows apart.  Rows without a valid version, a key or a
    date keep NULL.
    """
    side = dim.select(key, "gueltig_von", "gueltig_bis", *take)
    if small_enough(side, max_rows):
        left, right, on = rows, F.broadcast(side), [key]
    else:
        first, last = rows.agg(F.min(on_date), F.max(on_date)).first()
        hot = hot_keys(rows, [key], rows_per_piece)
        left, right, on = split_hot(rows, side, [key], hot, spread_by=spread_by or rows.columns)

        def bin_of(day: Column) -> Column:
            return F.floor(F.unix_date(day) / bin_days)

        begin, end = F.greatest("gueltig_von", F.lit(first)), F.least("gueltig_bis", F.lit(last))
        left = left.withColumn("__bin", bin_of(F.col(on_date)))
        overlaps = begin <= end if first is not None else F.lit(False)
        right = right.where(overlaps).withColumn("__bin", F.explode(F.sequence(bin_of(begin), bin_of(end))))
        on = [*on, "__bin"]
    match = reduce(lambda a, b: a & b, [F.col(f"r.{c}") == F.col(f"d.{c}") for c in on])
    valid = F.col(f"r.{on_date}").between(F.col("d.gueltig_von"), F.col("d.gueltig_bis"))
    return left.alias("r").join(right.alias("d"), match & valid, "left").select(
        *[f"r.{c}" for c in rows.columns], *[f"d.{c}" for c in take])
