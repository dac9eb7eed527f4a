"""Constraint checks.  Each returns the violations; an empty result means the rule holds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import Table
from .joins import BROADCAST_ROWS, small_enough


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count; NULL parts count as equal."""
    return df.groupBy(*keys).agg(F.count("*").alias("anzahl")).where("anzahl > 1")


def fk_violations(
    df: DataFrame, column: str, parent: DataFrame, parent_key: str, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Values of ``column`` without a parent row, with their row count; NULL passes.

    The values are counted first, so a value that fills a third of the table
    reaches the join as a single row.
    """
    values = (
        df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("wert")).agg(F.count("*").alias("anzahl"))
    )
    known = parent.select(F.col(parent_key).alias("wert"))
    if small_enough(known, max_rows):
        known = F.broadcast(known)
    return values.join(known, "wert", "left_anti")


def reference_violations(
    df: DataFrame, table: Table, read: Callable[[str], DataFrame], max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """(spalte, wert, anzahl): values of every foreign key of a layout that have no parent row; NULL passes.

    One pass counts the values of all keys, so only distinct values meet their
    parents, whatever share of the rows one of them has.
    """
    columns = [c for c in table.foreign if c in df.columns]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("spalte"), F.col(c).cast("string").alias("wert")) for c in columns]))
    values = (
        df.select(pairs.alias("z")).select("z.*").where("wert is not null")
        .groupBy("spalte", "wert").agg(F.count("*").alias("anzahl"))
    )
    parents = None
    for c in columns:
        parent, key = table.foreign[c]
        known = read(parent).select(F.lit(c).alias("spalte"), F.col(key).cast("string").alias("wert"))
        parents = known if parents is None else parents.unionByName(known)
    if small_enough(parents, max_rows):
        parents = F.broadcast(parents)
    return values.join(parents, ["spalte", "wert"], "left_anti")


def allowed_violations(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is outside the list; NULL passes."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def _column_rules(df: DataFrame, table: Table) -> list[tuple[str, str, str]]:
    """(column, rule, condition that breaks it) of the NOT NULL, length and value-list rules."""
    tests = []
    for c in df.columns:
        if c not in table.types:
            continue
        if c in table.required:
            tests.append((c, "NOT NULL", f"{c} IS NULL"))
        if c in table.lengths:
            tests.append((c, f"LENGTH <= {table.lengths[c]}", f"length({c}) > {table.lengths[c]}"))
        if c in table.allowed:
            values = ", ".join(f"'{v}'" for v in table.allowed[c])
            tests.append((c, "VALUES", f"{c} NOT IN ({values})"))
    return tests


def row_violations(df: DataFrame, table: Table) -> DataFrame:
    """The rows that break a rule, with ``regeln``: 'column rule' of each broken one, in column order."""
    broken = ", ".join(f"CASE WHEN {test} THEN '{c} {rule}' END" for c, rule, test in _column_rules(df, table))
    return df.withColumn("regeln", F.expr(f"array_join(array_compact(array({broken})), ', ')")).where("regeln <> ''")


def column_violations(df: DataFrame, table: Table) -> DataFrame:
    """(spalte, regel, anzahl): broken NOT NULL, length and value-list rules in one pass."""
    counts = ", ".join(
        f"named_struct('spalte', '{c}', 'regel', '{rule}', 'anzahl', count_if({broken}))"
        for c, rule, broken in _column_rules(df, table)
    )
    return df.agg(F.expr(f"array({counts})").alias("z")).select(F.inline("z")).where("anzahl > 0")


def current_row_violations(dim: DataFrame, key: str) -> DataFrame:
    """Natural keys with more than one current row."""
    return unique_violations(dim.where(F.col("ist_aktuell") == "J"), [key])


def interval_violations(dim: DataFrame, key: str) -> DataFrame:
    """Versions that end before they begin (two loads on one day)."""
    return dim.where(F.col("gueltig_bis") < F.col("gueltig_von")).select(
        key, "dwh_version", "gueltig_von", "gueltig_bis"
    )
