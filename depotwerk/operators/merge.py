"""Upsert and insert-if-absent on plain files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import nullable
from .dedupe import latest
from .joins import BROADCAST_ROWS, anti, null_safe


class DuplicateKeyError(ValueError):
    """The delivery holds the same key twice."""


class UnresolvedKeyError(ValueError):
    """A required dimension key could not be found."""


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """New content of ``target``: matched rows take ``update`` columns, unmatched source rows are added.

    Keys are unique on both sides (see :func:`one_per_key`), so no key is hot;
    NULL key parts match each other.  Columns the source lacks stay NULL on new
    rows.  The caller passes only the partitions of ``target`` that the source
    touches.
    """
    old = target.withColumn("__alt", F.lit(True)).alias("alt")
    new = source.withColumn("__neu", F.lit(True)).alias("neu")
    joined = old.join(new, null_safe("alt", "neu", keys), "full_outer")
    present = set(source.columns)

    def value(c: str) -> str:
        if c not in present:
            return f"alt.{c}"
        takes_new = "neu.__neu" if c in update else "alt.__alt IS NULL"
        return f"CASE WHEN {takes_new} THEN neu.{c} ELSE alt.{c} END AS {c}"

    return joined.selectExpr(*[value(c) for c in target.columns]).to(nullable(target.schema))


def replace_batch(target: DataFrame, fresh: DataFrame, batch_id: int) -> DataFrame:
    """Content after the rows of one batch are exchanged for ``fresh``, which may be empty."""
    kept = target.where(F.col("batch_id").isNull() | (F.col("batch_id") != batch_id))
    return kept.unionByName(fresh)


def insert_if_absent(
    target: DataFrame, source: DataFrame, keys: Sequence[str], max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Source rows whose key is not in ``target`` yet, to be appended."""
    return anti(source, target, keys, max_rows)


def one_per_key(
    source: DataFrame, keys: Sequence[str], *, on_duplicate: str = "fail",
    order_by: Sequence[str] = ("vor_id",),
) -> DataFrame:
    """Guard before a load: raise on a repeated key, or keep the latest row of each key.

    NULL key parts count as equal.
    """
    if on_duplicate == "latest":
        # a struct around a NULL is not NULL, so such keys stay in
        marks = {f"__k_{c}": F.struct(F.col(c)) for c in keys}
        return latest(source.withColumns(marks), list(marks), order_by).drop(*marks)
    repeated = source.groupBy(*keys).count().where("count > 1").limit(3).collect()
    if repeated:
        raise DuplicateKeyError(f"duplicate key {list(keys)}: {[r.asDict() for r in repeated]}")
    return source


def split_unresolved(rows: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every required key, and the rest with the list of missing ones."""
    gap = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    marked = rows.withColumn("fehlende_schluessel", F.array_join(gap, ", "))
    good = marked.where("fehlende_schluessel = ''").drop("fehlende_schluessel")
    return good, marked.where("fehlende_schluessel <> ''")


def resolved(rows: DataFrame, required: Sequence[str], on_unresolved: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows; with ``'fail'`` any rejected row stops the load."""
    good, bad = split_unresolved(rows, required)
    if on_unresolved == "fail":
        sample = bad.select(*required, "fehlende_schluessel").limit(3).collect()
        if sample:
            raise UnresolvedKeyError(f"unresolved keys: {[r.asDict() for r in sample]}")
        return rows, bad
    return good, bad
