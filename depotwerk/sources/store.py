"""Layer tables as Parquet folders.

* ``STG_*`` and ``VOR_*`` are partitioned by batch, ``FAKT_*`` by month of the
  leading date key.
* ``DIM_*`` are whole snapshots: each load writes a new folder ``stand=<n>``,
  and readers take the newest finished one.
* Log tables are events: ``ab=<n>`` holds those written since generation ``n``,
  ``stand=<n>`` what came before.  A full ``ab`` folder is merged into the next
  generation, which counts from the moment its success marker is there.
* A source system's batches become visible together: a note names the folders
  to move, and until it is gone readers skip that batch.  What was cut off is
  carried on, or taken back, by :meth:`Warehouse.recover`.

A single writer is assumed.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyfilter import FILTER_TYPES, groups_with, key_filters
from ..schemas import LOGS, STAGING, TABLES, Table, nullable

SNAPSHOTS_KEPT = 3
EVENT_FILES = 200  # of a log before they are merged
_TAKEN_BACK = ".zurueck"
_EPOCH = datetime(1970, 1, 1)


class Folders:
    """The few file-system calls Spark itself offers no API for."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        p, fs = self._path(path)
        return fs.exists(p)

    def children(self, path: str) -> list[str]:
        p, fs = self._path(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def make(self, path: str) -> None:
        p, fs = self._path(path)
        fs.mkdirs(p)

    def move(self, source: str, target: str) -> None:
        t, fs = self._path(target)
        fs.mkdirs(t.getParent())
        if not fs.rename(self._path(source)[0], t):
            raise OSError(f"cannot move {source} to {target}")

    def drop(self, path: str) -> None:
        p, fs = self._path(path)
        fs.delete(p, True)

    def write_text(self, path: str, text: str) -> None:
        """A small file that is there whole or not at all."""
        p, fs = self._path(f"{path}._neu")
        out = fs.create(p, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(f"{path}._neu", path)

    def read_text(self, path: str) -> str:
        p, fs = self._path(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def month_of(zeit_id: str) -> Column:
    return F.floor(F.col(zeit_id) / 100).cast("int")


def _in_months(months: Sequence[int | None]) -> Column:
    """Partition filter; None stands for rows without a date."""
    some = F.col("zeit_monat").isin([m for m in months if m is not None])
    return some | F.col("zeit_monat").isNull() if None in months else some


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.folders = Folders(spark)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # --- reading ----------------------------------------------------------

    def _stored_schema(self, layout: Table) -> T.StructType:
        schema = T.StructType(list(layout.schema.fields))
        if layout.partition and layout.partition not in layout.types:
            schema = schema.add(layout.partition, T.IntegerType())
        if layout.name in LOGS:
            schema = schema.add("ereignis_nr", T.IntegerType())
        return schema

    def read(self, table: str, *, months: Sequence[int] | None = None, batch_id: int | None = None) -> DataFrame:
        """Rows of a table, with partition filters; an absent table is empty."""
        layout = TABLES[table]
        schema = self._stored_schema(layout)
        if table.startswith("DIM_"):
            paths = [self._newest(table)]
        elif table in LOGS:
            paths = self._log_paths(table, self._generation(table))
        else:
            paths = [self.path(table)]
        paths = [p for p in paths if p is not None and self.folders.exists(p)]
        if paths:
            df = self.spark.read.schema(schema).parquet(*paths)
        else:
            df = self.spark.createDataFrame([], schema)
        if batch_id is not None:
            df = df.where(F.col("batch_id") == batch_id)
        hidden = self._unfinished() if table in STAGING else []
        if hidden:
            df = df.where(~F.col("batch_id").isin(hidden))
        if months is not None:
            df = df.where(_in_months(months))
        extra = ["ereignis_nr"] if "ereignis_nr" in schema.names else []
        return df.select(*layout.columns, *extra)

    def has_rows(self, table: str) -> bool:
        return not self.read(table).isEmpty()

    # --- batch partitions -------------------------------------------------

    def _columns(self, df: DataFrame, layout: Table) -> DataFrame:
        return df.to(layout.schema)

    def _observed_write(self, df: DataFrame, write, **measures: Column) -> dict[str, int]:
        """Write once and learn the row count ``n`` and further aggregates from the same pass."""
        seen = Observation()
        write(df.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(name) for name, c in measures.items()]))
        return seen.get

    def _counted_write(self, df: DataFrame, write) -> int:
        return self._observed_write(df, write)["n"]

    def stage_batch(self, table: str, df: DataFrame, batch_id: int) -> int:
        """Write a batch beside the table; :meth:`publish_batches` makes it visible."""
        return self.stage_observed(table, df, batch_id)["n"]

    def stage_observed(self, table: str, df: DataFrame, batch_id: int, **measures: Column) -> dict[str, int]:
        rows = self._columns(df, TABLES[table]).drop("batch_id")
        return self._observed_write(
            rows, lambda d: d.write.mode("overwrite").parquet(self._pending(table, batch_id)), **measures)

    def _pending(self, table: str, batch_id: int) -> str:
        return f"{self.root}/_laden/{batch_id}/{table}"

    def publish_batches(self, tables: Sequence[str], batch_id: int) -> None:
        """Move all written batches of a source system into their tables, or none.

        The note of what is to be moved is written first and removed last.  An
        error takes everything back; a crash leaves the note to :meth:`recover`.
        """
        note = f"{self._notes()}/{batch_id}-{uuid.uuid4().hex}"
        self.folders.write_text(note, "\n".join(tables))
        try:
            self._carry_out(note)
        except Exception:
            self.folders.move(note, f"{note}{_TAKEN_BACK}")
            self._take_back(f"{note}{_TAKEN_BACK}")
            raise

    def _notes(self) -> str:
        return f"{self.root}/_absichten"

    def _open_notes(self) -> list[str]:
        """Notes of publications that are under way or were cut off; half-written notes moved nothing."""
        return sorted(n for n in self.folders.children(self._notes()) if not n.endswith("._neu") and n[0] != ".")

    def _unfinished(self) -> list[int]:
        return sorted({int(n.split("-")[0]) for n in self._open_notes()})

    def _moves(self, note: str) -> list[tuple[str, str]]:
        batch_id = note.rsplit("/", 1)[1].split("-")[0]
        return [(self._pending(t, int(batch_id)), f"{self.path(t)}/batch_id={batch_id}")
                for t in self.folders.read_text(note).split("\n")]

    def _carry_out(self, note: str) -> None:
        """The moves of a note that are still to be made; a folder of an earlier try gives way."""
        for pending, target in self._moves(note):
            if self.folders.exists(pending):
                self.folders.drop(target)
                self.folders.move(pending, target)
            elif not self.folders.exists(target):
                raise FileNotFoundError(f"neither {pending} nor {target} is there")
        self.folders.drop(note)

    def _take_back(self, note: str) -> None:
        for pending, target in self._moves(note):
            self.folders.drop(target)
            self.folders.drop(pending)
        self.folders.drop(note)

    def recover(self) -> list[int]:
        """Finish what an earlier process left half done; returns the batches concerned.

        A note alone means that every batch was written whole, so its moves are
        carried on; one marked as taken back is undone to the end.
        """
        batches = self._unfinished()
        for name in self._open_notes():
            note = f"{self._notes()}/{name}"
            (self._take_back if name.endswith(_TAKEN_BACK) else self._carry_out)(note)
        return batches

    def work_table(self, table: str, df: DataFrame, batch_id: int) -> DataFrame:
        """Write an intermediate result once and read it back.

        Checks and merges that look at the same rows several times then scan
        the few columns they need instead of repeating the joins behind them.
        """
        path = f"{self.root}/_laden/{batch_id}/{table}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(nullable(df.schema)).parquet(path)

    def reserve(self, table: str, n: int) -> int:
        """Set ``n`` numbers of a table aside and return the first.

        The end of the numbers given out is the name of an empty folder, so no
        table is scanned to find it; numbers of failed loads are not given out again.
        """
        root = f"{self.root}/_nummern/{table}"
        ends = sorted(int(c.split("=")[1]) for c in self.folders.children(root))
        last = ends[-1] if ends else 0
        self.folders.make(f"{root}/bis={last + n}")
        for old in ends[:-1]:
            self.folders.drop(f"{root}/bis={old}")
        return last + 1

    def replace_rejects(self, table: str, df: DataFrame, batch_id: int) -> None:
        """Rows of a batch that no dimension resolves; a rerun of the batch replaces them."""
        df.drop("batch_id").write.mode("overwrite").parquet(f"{self.path(table)}_ABGELEHNT/batch_id={batch_id}")

    def discard_batches(self, batch_id: int, tables: Sequence[str] | None = None) -> None:
        """Drop what a batch left beside the tables: all of it, or that of some tables."""
        for path in [f"{self.root}/_laden/{batch_id}"] if tables is None else [self._pending(t, batch_id) for t in tables]:
            self.folders.drop(path)

    # --- watermarks -------------------------------------------------------

    def watermark(self, table: str) -> datetime | None:
        """Change time up to which the deliveries of a table are staged."""
        ends = [int(c.split("=")[1]) for c in self.folders.children(f"{self.root}/_marken/{table}")]
        return _EPOCH + timedelta(microseconds=max(ends)) if ends else None

    def advance_watermark(self, table: str, until: datetime) -> None:
        """Move a watermark forward, never back; like :meth:`reserve` it is the name of an empty folder."""
        last = self.watermark(table)
        if last is not None and until <= last:
            return
        root = f"{self.root}/_marken/{table}"
        self.folders.make(f"{root}/bis={(until - _EPOCH) // timedelta(microseconds=1)}")
        if last is not None:
            self.folders.drop(f"{root}/bis={(last - _EPOCH) // timedelta(microseconds=1)}")

    def replace_batch(self, table: str, df: DataFrame, batch_id: int) -> int:
        return self.replace_observed(table, df, batch_id)["n"]

    def replace_observed(self, table: str, df: DataFrame, batch_id: int, **measures: Column) -> dict[str, int]:
        """Replace one batch of a table; running it again gives the same content.

        Dynamic partition overwrite keeps the old files until the job commits.
        It leaves a partition alone when no row arrives, so an empty result
        drops the partition explicitly.
        """
        layout = TABLES[table]
        seen = self._observed_write(
            self._columns(df, layout),
            lambda d: d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(self.path(table)), **measures)
        if seen["n"] == 0:
            self.drop_batch(table, batch_id)
        return seen

    def drop_batch(self, table: str, batch_id: int) -> None:
        self.folders.drop(f"{self.path(table)}/batch_id={batch_id}")

    # --- facts ------------------------------------------------------------

    def write_months(self, table: str, df: DataFrame, date_key: str, *, replace: bool) -> int:
        """Write fact rows into their month partitions.

        ``rebalance`` groups rows by month for few, even files and cuts a month
        that holds most of the load.  With ``replace`` the months that occur
        are exchanged at commit, so reading them in the same plan is safe.
        """
        layout = TABLES[table]
        rows = self._columns(df, layout).withColumn("zeit_monat", month_of(date_key))
        rows = rows.hint("rebalance", "zeit_monat")

        def write(d: DataFrame) -> None:
            writer = d.write.partitionBy("zeit_monat")
            if replace:
                writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            else:
                writer = writer.mode("append")
            writer.parquet(self.path(table))

        return self._counted_write(rows, write)

    # --- key filters of facts ---------------------------------------------

    def _month_stands(self, table: str) -> dict[int | None, str]:
        """Months of a fact table, each with a digest of the names of its files.

        Files are only added or exchanged, never changed, so the digest tells
        whether a month is as it was.  Folders are listed; no row is read.
        """
        stands = {}
        for folder in sorted(self.folders.children(self.path(table))):
            name, _, value = folder.partition("=")
            if name == "zeit_monat":
                files = sorted(f for f in self.folders.children(f"{self.path(table)}/{folder}") if f[0] not in "._")
                stands[int(value) if value.isdigit() else None] = hashlib.sha256(",".join(files).encode()).hexdigest()[:32]
        return stands

    def _filter_path(self, table: str) -> str:
        return f"{self.path(table)}_SCHLUESSEL"

    def _without_filter(self, table: str, stands: dict[int | None, str]) -> list[int | None]:
        """Months whose filter is missing or older than their files, after a load that was cut off for one."""
        return [m for m, stand in stands.items()
                if m is None or f"stand={stand}" not in self.folders.children(f"{self._filter_path(table)}/zeit_monat={m}")]

    def months_with_keys(self, table: str, rows: DataFrame, keys: Sequence[str]) -> list[int | None] | None:
        """Months that may hold a key of ``rows``, by the key filters; None: any of them.

        Months without a valid filter are among them, so an interrupted load costs
        time but no duplicate.
        """
        stands = self._month_stands(table)
        unknown = self._without_filter(table, stands)
        covered = [m for m in stands if m not in unknown]
        if not covered:
            return unknown
        filters = (
            self.spark.read.schema(f"{FILTER_TYPES}, zeit_monat int, stand string").parquet(self._filter_path(table))
            .where(F.concat_ws("/", "zeit_monat", "stand").isin([f"{m}/{stands[m]}" for m in covered]))
        )
        found = groups_with(filters, rows, keys, "zeit_monat")
        return None if found is None else [m for m in stands if m in unknown or m in found]

    def refresh_key_filters(self, table: str, keys: Sequence[str]) -> list[int]:
        """Build the filters of the months that changed; returns these months."""
        stands = self._month_stands(table)
        months = [m for m in self._without_filter(table, stands) if m is not None]
        if not months:
            return []
        layout = TABLES[table]
        stored = self.spark.read.schema(self._stored_schema(layout)).parquet(self.path(table)).where(_in_months(months))
        marks = self.spark.createDataFrame([(m, stands[m]) for m in months], "zeit_monat int, stand string")
        fresh = key_filters(stored, keys, "zeit_monat").join(F.broadcast(marks), "zeit_monat")  # a row per month
        fresh.hint("rebalance", "zeit_monat").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("zeit_monat", "stand").parquet(self._filter_path(table))
        for m in months:
            folder = f"{self._filter_path(table)}/zeit_monat={m}"
            for old in self.folders.children(folder):
                if old != f"stand={stands[m]}":
                    self.folders.drop(f"{folder}/{old}")
        return sorted(months)

    # --- dimension snapshots ----------------------------------------------

    def _stands(self, table: str) -> list[int]:
        path = self.path(table)
        numbers = [int(c.split("=")[1]) for c in self.folders.children(path) if c.startswith("stand=")]
        return sorted(n for n in numbers if self.folders.exists(f"{path}/stand={n}/_SUCCESS"))

    def _newest(self, table: str) -> str | None:
        stands = self._stands(table)
        return f"{self.path(table)}/stand={stands[-1]}" if stands else None

    def write_snapshot(self, table: str, df: DataFrame) -> None:
        """Publish a new snapshot: visible once its success marker is there."""
        stands = self._stands(table)
        number = stands[-1] + 1 if stands else 1
        self._columns(df, TABLES[table]).write.mode("overwrite").parquet(f"{self.path(table)}/stand={number}")
        for old in stands[: -(SNAPSHOTS_KEPT - 1)]:
            self.folders.drop(f"{self.path(table)}/stand={old}")

    # --- logs -------------------------------------------------------------

    def _generation(self, table: str) -> int:
        """Newest finished generation of a log; 0 before the first."""
        return max(self._stands(table), default=0)

    def _log_paths(self, table: str, generation: int) -> list[str]:
        return [f"{self.path(table)}/stand={generation}", f"{self.path(table)}/ab={generation}"]

    def append_event(self, table: str, row: dict, number: int) -> None:
        """One event as one file.  A full folder is merged, so the number of files stays bounded."""
        schema = self._stored_schema(TABLES[table])
        values = {**row, "ereignis_nr": number}
        names = ", ".join(f":{c} AS {c}" for c in values)
        event = self.spark.sql(f"SELECT {names}", args=values).to(schema)
        path = self._log_paths(table, self._generation(table))[1]
        event.coalesce(1).write.mode("append").parquet(path)
        if sum(f[0] not in "._" for f in self.folders.children(path)) >= EVENT_FILES:
            self.compact_log(table)

    def compact_log(self, table: str, keep=lambda events: events) -> None:
        """Merge a log into its next generation, with the events that ``keep`` leaves.

        The old generation counts until the new one is written whole, and stays
        for readers until the one after that; older ones are dropped.
        """
        old = self._generation(table)
        keep(self.read(table)).hint("rebalance").write.mode("overwrite").parquet(f"{self.path(table)}/stand={old + 1}")
        for folder in self.folders.children(self.path(table)):
            name, _, number = folder.partition("=")
            if name in ("stand", "ab") and int(number) < old:
                self.folders.drop(f"{self.path(table)}/{folder}")
