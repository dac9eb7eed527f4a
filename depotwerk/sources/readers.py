"""Where deliveries come from.

A source answers ``read(view, table)`` with the raw rows of one delivery; the
staging functions do not know whether they come from a database, files or
literal rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import moment
from ..operators.numbering import with_arrival
from ..schemas import TABLES

# Staging columns filled during staging, not delivered.
DERIVED = {
    "STG_FB_BESTAND": {"marktwert_fondswaehrung"},
    "STG_FB_TRANSAKTION": {"gesamtbetrag_fondswaehrung", "src_transaktions_nr", "src_status"},
    "STG_FB_FONDSBEWEGUNG": {"src_bewegungs_nr", "src_status"},
    "STG_KV_KURS": {"src_kurs_id"},
    "STG_KV_WECHSELKURS": {"src_kurs_id"},
    "STG_WP_STAMMDATEN": {"src_wertpapier_id"},
    "STG_WP_FONDS_STAMMDATEN": {"src_fonds_id"},
}
# Views that grow every day: a single connection cannot read them.
LARGE = {"STG_FB_BESTAND", "STG_FB_TRANSAKTION", "STG_FB_FONDSBEWEGUNG", "STG_KV_KURS"}
GENERATED = {"stg_id", "batch_id", "ladezeit", "src_erstellt_am", "src_geaendert_am"}


def delivery_schema(table: str) -> T.StructType:
    """Columns a source system delivers for a staging table."""
    layout = TABLES[table]
    skip = GENERATED | DERIVED[table]
    fields = [f for f in layout.schema.fields if f.name not in skip]
    if table == "STG_KV_KURS":
        fields.append(T.StructField("kurs_id", T.StringType()))
    return T.StructType(fields)


class MissingColumnsError(ValueError):
    pass


_PLAIN = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss"})


def plain_name(name: str) -> str:
    """A column name as the warehouse writes it: lower case, umlauts as two letters."""
    return name.lower().translate(_PLAIN)


def delivered(df: DataFrame, table: str) -> DataFrame:
    """A delivery under the warehouse's column names; a column that is not delivered stops the load.

    A missing column would otherwise be staged as NULL without a word.
    """
    named = df.toDF(*[plain_name(c) for c in df.columns])
    missing = [c for c in delivery_schema(table).names if c not in named.columns]
    if missing:
        raise MissingColumnsError(f"{table}: not delivered: {', '.join(missing)}")
    return named


class Source(Protocol):
    def read(self, table: str) -> DataFrame: ...


@dataclass
class FrameSource:
    """Deliveries that already are DataFrames, keyed by staging table."""

    frames: Mapping[str, DataFrame]

    def read(self, table: str) -> DataFrame:
        return self.frames[table]


def literal_rows(spark: SparkSession, table: str, rows: Iterable[Mapping]) -> DataFrame:
    """Literal rows as a delivery; absent columns are NULL."""
    schema = delivery_schema(table)
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


@dataclass
class FileSource:
    """Deliveries as files: CSV with header, or Parquet.

    CSV is read with the declared types, column by column under the names of
    its header, and fails on a malformed line instead of loading NULLs.  Rows
    carry the file they come from: a later file (by name) corrects an earlier one.
    """

    spark: SparkSession
    paths: Mapping[str, str]
    format: str = "csv"
    options: Mapping[str, str] = field(default_factory=dict)

    def read(self, table: str) -> DataFrame:
        path = self.paths[table]
        if self.format != "csv":
            return with_arrival(self.spark.read.options(**self.options).format(self.format).load(path))
        options = {"header": "true", "mode": "FAILFAST", "enforceSchema": "false", **self.options}
        # the header decides which columns there are, the layout which types they have
        names = self.spark.read.options(**{**options, "inferSchema": "false"}).csv(path).columns
        types = {f.name: f.dataType for f in delivery_schema(table).fields}
        schema = T.StructType([T.StructField(n, types.get(plain_name(n), T.StringType())) for n in names])
        return with_arrival(self.spark.read.schema(schema).options(**options).csv(path))


@dataclass
class JdbcSource:
    """Deliveries as views of a relational database.

    The date predicate added by the staging function is pushed into the remote
    query.  ``split`` names, per table, a numeric or date column with its bounds
    and the number of parallel connections; the large views need one, as a
    view without it is read by one task over one connection.
    """

    spark: SparkSession
    url: str
    views: Mapping[str, str]
    properties: Mapping[str, str] = field(default_factory=dict)
    split: Mapping[str, tuple[str, str, str, int]] = field(default_factory=dict)
    fetch_size: int = 10_000

    def options(self, table: str) -> dict[str, str]:
        if table in LARGE and table not in self.split:
            raise ValueError(f"{table}: state how to split the view over connections")
        opts = {"url": self.url, "dbtable": self.views[table], "fetchsize": str(self.fetch_size),
                **self.properties}
        if table in self.split:
            column, low, high, n = self.split[table]
            opts |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
                     "numPartitions": str(n)}
        return opts

    def read(self, table: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options(table)).load()


def rows_of_day(df: DataFrame, date_column: str, lade_datum: date | None) -> DataFrame:
    """Full delivery of one business date; None takes every date (initial load)."""
    return df if lade_datum is None else df.where(F.col(date_column) == F.lit(lade_datum))


def rows_changed_since(df: DataFrame, changed_column: str, since: datetime | None) -> DataFrame:
    """Delta delivery: rows changed after the last successful load; all rows on the first load.

    A row without a change time may have changed at any time and is taken.
    """
    return df if since is None else df.where(F.col(changed_column).isNull() | (F.col(changed_column) > moment(since)))


@dataclass(frozen=True)
class Delta:
    """Incremental delivery of a table: its change time, what identifies a row, and how late rows may come."""

    column: str
    key: tuple[str, ...]
    overlap: timedelta = timedelta(hours=1)


def without_staged(changed: DataFrame, staged: DataFrame, key: Sequence[str], column: str = "src_geaendert_am") -> DataFrame:
    """Changed rows without those staged before: same key, NULL parts included, and same change time."""
    def marked(rows: DataFrame) -> DataFrame:
        # a struct around a NULL equals another one; keys are compared as the staging tables hold them
        return rows.withColumns({f"__k{i}": F.struct(F.col(c).cast("string").alias("w")) for i, c in enumerate(key)}
                                | {"__stand": F.col(column).cast("timestamp")})

    marks = [*[f"__k{i}" for i in range(len(key))], "__stand"]
    return marked(changed).join(marked(staged).select(*marks), marks, "left_anti").drop(*marks)


def last_load(log: DataFrame, table: str) -> datetime | None:
    """Start of the last successful load of a staging table, from the load log."""
    return (
        log.where((F.col("tabelle") == table) & (F.col("status") == "ERFOLGREICH"))
        .agg(F.max("ladestart")).first()[0]
    )
