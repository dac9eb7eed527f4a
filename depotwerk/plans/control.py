"""Running the load: phases, steps, logs, publishing, resuming, retention."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import moment
from ..operators.calendar import calendar
from ..operators.fx import LOOKBACK_DAYS, eur_rates
from ..operators.integrity import reference_violations, row_violations, unique_violations
from ..operators.keys import KeyTable
from ..operators.merge import DuplicateKeyError, insert_if_absent, one_per_key, resolved, upsert
from ..operators.numbering import ARRIVAL, arrival_ids, next_number, with_arrival
from ..operators.retention import RETENTION_DAYS, expired_batches, retain
from ..schemas import STAGING, TABLES, VALIDATED
from ..sources import seeds
from ..sources.readers import Delta, Source, plain_name, rows_changed_since, without_staged
from ..sources.staging import SOURCE_SYSTEMS, SourceSystem
from ..sources.store import Warehouse, month_of
from . import monitor, transforms
from .dimensions import assign_keys, load_fonds, load_wertpapier, new_depots
from .facts import FACT_LOADS, FactLoad, Keys

ERROR_LENGTH = 4000
PHASES = tuple(monitor.PHASES)
DONE = ("ERFOLGREICH", "UEBERSPRUNGEN")


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class IntegrityError(ValueError):
    pass


class Control:
    """One warehouse with its source and load policies.

    ``on_duplicate``   'fail' stops a load whose validated rows repeat a key,
                       'latest' keeps the newest row.
    ``on_unresolved``  'fail' stops a load with unknown dimension keys,
                       'reject' writes those rows to ``<fact>_ABGELEHNT``.
    ``on_integrity``   'report' leaves broken references and column rules to
                       :meth:`check_integrity`, 'fail' stops a fact load on them
                       (a date outside the calendar, for one).
    ``fx_batches``     'all' lets a conversion see rates of every batch,
                       'up_to_batch' only of batches up to its own.
    ``delta``          per staging table, how to take only what changed since the
                       last published load instead of the rows of one date.
    """

    def __init__(
        self, spark: SparkSession, root: str, source: Source | None = None, *,
        clock: Callable[[], datetime] = utc_now,
        on_duplicate: str = "fail", on_unresolved: str = "fail", on_integrity: str = "report",
        fx_batches: str = "all", allow_inverse: bool = False, lookback: int = LOOKBACK_DAYS,
        delta: Mapping[str, Delta] | None = None,
    ):
        for table in delta or {}:
            if "src_geaendert_am" not in TABLES[table].columns:
                raise ValueError(f"{table} keeps no change time")
        self.spark = spark
        self.store = Warehouse(spark, root)
        self.source = source
        self.clock = clock
        self.on_duplicate = on_duplicate
        self.on_unresolved = on_unresolved
        self.on_integrity = on_integrity
        self.fx_batches = fx_batches
        self.allow_inverse = allow_inverse
        self.lookback = lookback
        self.delta = dict(delta or {})
        self._numbers: dict[str, int] = {}
        self._log_lock = threading.RLock()

    # --- installation -----------------------------------------------------

    def install(self, first: date = date(2000, 1, 1), last: date = date(2040, 12, 31)) -> None:
        """Calendar and reference rows; what exists is kept."""
        days = self.store.read("DIM_ZEIT")
        fresh = calendar(self.spark, first, last, days)
        if not fresh.isEmpty():
            self.store.write_snapshot("DIM_ZEIT", days.unionByName(fresh))
        now = self.clock()
        for table, rows in (("DIM_WAEHRUNG", seeds.currencies), ("DIM_LAND", seeds.countries),
                            ("DIM_BRANCHE", seeds.sectors)):
            if not self.store.has_rows(table):
                self.store.write_snapshot(table, rows(self.spark, now))

    # --- logs -------------------------------------------------------------

    def process_log(self) -> DataFrame:
        return monitor.latest_events(self.store.read("ETL_PROZESSLOG"), "prozess_id")

    def load_log(self) -> DataFrame:
        return monitor.latest_events(self.store.read("STG_LADELOG"), "log_id")

    def step_log(self) -> DataFrame:
        return self.store.read("ETL_SCHRITTLOG").drop("ereignis_nr")

    def _next(self, table: str, column: str) -> int:
        """Next log number.  Read once, then counted on: there is a single writer."""
        with self._log_lock:
            if table not in self._numbers:
                self._numbers[table] = next_number(self.store.read(table), column)
            number = self._numbers[table]
            self._numbers[table] = number + 1
            return number

    def _event(self, table: str, row: dict, number: int) -> None:
        """Source systems load side by side and log one at a time."""
        with self._log_lock:
            self.store.append_event(table, row, number)

    @contextmanager
    def _phase(self, batch_id: int, lade_datum: date, phase: str):
        """Log a phase from start to end; yields the process id."""
        start = self.clock()
        number = self._next("ETL_PROZESSLOG", "prozess_id")
        row = {"prozess_id": number, "batch_id": batch_id, "lade_datum": lade_datum, "prozessstart": start,
               "phase": phase, "status": "GESTARTET", "erstellt_am": start}
        self.store.append_event("ETL_PROZESSLOG", row, 1)
        try:
            yield number
        except Exception as error:
            self.store.append_event("ETL_PROZESSLOG", {
                **row, "prozessende": self.clock(), "status": "FEHLER",
                "fehlermeldung": str(error)[:ERROR_LENGTH]}, 2)
            raise
        self.store.append_event(
            "ETL_PROZESSLOG", {**row, "prozessende": self.clock(), "status": "ERFOLGREICH"}, 2)

    def _skip_phase(self, batch_id: int, lade_datum: date, phase: str) -> None:
        now = self.clock()
        self._event("ETL_PROZESSLOG", {
            "prozess_id": self._next("ETL_PROZESSLOG", "prozess_id"), "batch_id": batch_id, "lade_datum": lade_datum,
            "prozessstart": now, "prozessende": now, "phase": phase, "status": "UEBERSPRUNGEN", "erstellt_am": now}, 1)

    def _run_steps(
        self, batch_id: int, phase: str, steps: Sequence[tuple[str, Callable[[], dict | None]]], done: set[str]
    ) -> bool:
        """Run the named steps in order, each with its line in the step log; finished ones are skipped.

        A step that runs changes what the later ones read, so nothing is
        skipped after it.  Returns whether any step ran.
        """
        ran = False
        for name, run in steps:
            if name in done and not ran:
                self._skip_step(batch_id, phase, name)
            else:
                ran = True
                self._logged_step(batch_id, phase, name, run)
        return ran

    def _log_step(self, batch_id: int, phase: str, name: str, start: datetime, status: str, **values) -> None:
        self._event("ETL_SCHRITTLOG", {
            "schritt_id": self._next("ETL_SCHRITTLOG", "schritt_id"), "batch_id": batch_id, "phase": phase, "tabelle": name,
            "schrittstart": start, "schrittende": self.clock(), "status": status, "erstellt_am": start, **values}, 1)

    def _skip_step(self, batch_id: int, phase: str, name: str) -> None:
        self._log_step(batch_id, phase, name, self.clock(), "UEBERSPRUNGEN")

    def _logged_step(self, batch_id: int, phase: str, name: str, run: Callable[[], dict | None]) -> None:
        """Run a step and log its end, with the counts that it returns."""
        start = self.clock()
        try:
            counts = run()
        except Exception as error:
            self._log_step(batch_id, phase, name, start, "FEHLER", fehlermeldung=str(error)[:ERROR_LENGTH])
            raise
        self._log_step(batch_id, phase, name, start, "ERFOLGREICH", **counts or {})

    def _finished_steps(self, batch_id: int) -> dict[str, set[str]]:
        """Per phase the steps of a batch whose newest try went well."""
        tries = self.step_log().where(F.col("batch_id") == batch_id)
        newest = tries.groupBy("phase", "tabelle").agg(F.max_by("status", "schritt_id").alias("status"))
        finished: dict[str, set[str]] = {phase: set() for phase in PHASES}
        for r in newest.where(F.col("status").isin(*DONE)).collect():  # one row per table of a load
            finished.setdefault(r.phase, set()).add(r.tabelle)
        return finished

    def _load_rows(self, batch_id: int, system: SourceSystem) -> dict[str, dict]:
        """Log lines of a system's tables, numbered in the order of the load."""
        return {table: {"log_id": self._next("STG_LADELOG", "log_id"), "batch_id": batch_id, "quellsystem": system.name,
                        "tabelle": table, "anzahl_saetze": 0} for table, _ in system.loads}

    def _log_load_start(self, row: dict) -> dict:
        now = self.clock()
        row = {**row, "ladestart": now, "status": "GESTARTET", "erstellt_am": now}
        self._event("STG_LADELOG", row, 1)
        return row

    def _log_load_end(self, row: dict, ended: datetime, count: int, status: str, error: str | None = None) -> None:
        self._event("STG_LADELOG", {
            **row, "ladeende": ended, "anzahl_saetze": count, "status": status,
            "fehlermeldung": error[:ERROR_LENGTH] if error else None}, 2)

    def new_batch_id(self) -> int:
        """Next batch number: above every batch the logs know."""
        return max(next_number(self.store.read("ETL_PROZESSLOG"), "batch_id"),
                   next_number(self.store.read("STG_LADELOG"), "batch_id"))

    # --- phase 1: staging -------------------------------------------------

    def load_source(self, system: SourceSystem, batch_id: int, lade_datum: date, rows: dict[str, dict] | None = None) -> int:
        """Stage all tables of one source system; returns the staged rows.

        The tables become visible together after the last one is written, and
        only then does the load log say so and the watermarks move on.
        """
        now = self.clock()
        lines = rows or self._load_rows(batch_id, system)
        tables = [t for t, _ in system.loads]
        done: list[tuple[dict, datetime, dict]] = []
        row: dict | None = None
        try:
            for table, stage in system.loads:
                row = self._log_load_start(lines[table])
                delivery, day = self._delivery(table, batch_id), lade_datum
                measures = {}
                if table in self.delta:
                    delivery, day = self._changes(table, delivery, batch_id), None
                    known = F.col("src_geaendert_am").isNotNull()
                    measures = {"stand": F.max(F.when(known, F.least("src_geaendert_am", moment(now))))}  # never ahead of the clock
                staged = self._numbered(table, stage(delivery, day, now), "stg_id")
                staged = staged.withColumn("batch_id", F.lit(batch_id)).withColumn("ladezeit", moment(now))
                done.append((row, self.clock(), self.store.stage_observed(table, staged, batch_id, **measures)))
                row = None
            self.store.publish_batches(tables, batch_id)
            for entry, _, seen in done:
                if seen.get("stand") is not None:
                    self.store.advance_watermark(entry["tabelle"], seen["stand"])
        except Exception as error:
            for entry, ended, _ in done:
                self._log_load_end(entry, ended, 0, "FEHLER", f"zurueckgerollt: {error}")
            if row is not None:
                self._log_load_end(row, self.clock(), 0, "FEHLER", str(error))
            self.store.discard_batches(batch_id, tables)
            raise
        for entry, ended, seen in done:
            self._log_load_end(entry, ended, seen["n"], "ERFOLGREICH")
        return sum(seen["n"] for _, _, seen in done)

    def _changes(self, table: str, delivery: DataFrame, batch_id: int) -> DataFrame:
        """What a delivery changes since the watermark, without what is staged already.

        The overlap lets late rows in and brings known ones again; those have a
        staged row with the same key and change time.  Rows without a change
        time are always new.
        """
        delta = self.delta[table]
        mark = self.store.watermark(table)
        since = mark - delta.overlap if mark else None
        named = delivery.toDF(*[plain_name(c) for c in delivery.columns])
        named = named.withColumn(delta.column, F.col(delta.column).cast("timestamp"))
        changed = rows_changed_since(named, delta.column, since).withColumnRenamed(delta.column, "src_geaendert_am")
        if since is None:
            return changed
        staged = self.store.read(table).where(
            (F.col("batch_id") != batch_id) & (F.col("src_geaendert_am") > moment(since)))
        return without_staged(changed, staged, delta.key)

    def _delivery(self, table: str, batch_id: int) -> DataFrame:
        """The delivery with the order of its rows.

        Files have an order.  What comes from elsewhere is written first, in the
        order in which the source returns it, and read from those files.
        """
        delivery = self.source.read(table)
        if set(ARRIVAL) <= set(delivery.columns):
            return delivery
        return with_arrival(self.store.work_table(f"{table}_LIEFERUNG", delivery, batch_id))

    def _numbered(self, table: str, rows: DataFrame, into: str) -> DataFrame:
        return arrival_ids(rows, into, lambda n: self.store.reserve(table, n))

    def run_full_staging(self, batch_id: int, lade_datum: date, done: set[str] = frozenset()) -> bool:
        """All source systems side by side: master data, prices, accounting.

        Each system has its own thread, job group and scheduler pool.  One that
        fails has its running jobs cancelled and its tables discarded; the
        others go on, and the first failure is raised at the end.
        """
        context = self.spark.sparkContext
        plans = []
        for system in SOURCE_SYSTEMS:
            if system.name in done:
                self._skip_step(batch_id, "STAGING", system.name)
            else:
                plans.append((system, self._load_rows(batch_id, system)))

        def load(system: SourceSystem, lines: dict[str, dict]) -> None:
            group = f"staging-{batch_id}-{system.name}"
            context.setJobGroup(group, f"{system.name}, batch {batch_id}", interruptOnCancel=True)
            context.setLocalProperty("spark.scheduler.pool", system.name)
            try:
                self._logged_step(batch_id, "STAGING", system.name, lambda: {
                    "anzahl_saetze": self.load_source(system, batch_id, lade_datum, lines)})
            except Exception:
                context.cancelJobGroup(group)
                raise

        with ThreadPoolExecutor(max(1, len(plans))) as pool:
            loads = [pool.submit(inheritable_thread_target(self.spark)(load), *plan) for plan in plans]
        errors = [e for e in (f.exception() for f in loads) if e is not None]
        self.store.discard_batches(batch_id)
        if errors:
            raise errors[0]
        return bool(plans)

    # --- phase 2: transformation ------------------------------------------

    def rates(self, batch_id: int) -> DataFrame:
        """The EUR rates that the staged rows of a batch ask for."""
        requests = self.store.work_table("KURSANFRAGEN", transforms.requested_rates(
            {name: self.store.read(name, batch_id=batch_id) for name in transforms.CONVERTED}), batch_id)
        fx = self.store.read("STG_KV_WECHSELKURS")
        if self.fx_batches == "up_to_batch":
            fx = fx.where(F.col("batch_id") <= batch_id)
        first, last = requests.agg(F.min("gilt_am"), F.max("gilt_am")).first()
        if first is not None:  # only the days that can be asked for
            fx = fx.where(F.col("kursdatum").between(first - timedelta(days=self.lookback), last))
        rates = eur_rates(requests, fx, lookback=self.lookback, allow_inverse=self.allow_inverse)
        return self.store.work_table("KURSE_EUR", rates, batch_id)

    def run_transformation(self, batch_id: int, done: set[str] = frozenset()) -> bool:
        """All seven transforms.  The rates are found once and stored for the four conversions."""
        now = self.clock()
        found: list[transforms.Rates] = []

        def rates() -> transforms.Rates:
            if not found:
                table = self.rates(batch_id)
                found.append(transforms.Rates(table, table.count()))
            return found[0]

        steps = [
            ("VOR_WERTPAPIER", lambda s: transforms.transform_wertpapier(s), "STG_WP_STAMMDATEN"),
            ("VOR_FONDS", lambda s: transforms.transform_fonds(s), "STG_WP_FONDS_STAMMDATEN"),
            ("VOR_WECHSELKURS", lambda s: transforms.transform_wechselkurse(s), "STG_KV_WECHSELKURS"),
            ("VOR_KURS", lambda s: transforms.transform_kurse(s, rates()), "STG_KV_KURS"),
            ("VOR_BESTAND", lambda s: transforms.transform_bestaende(
                s, rates(), stored=lambda d: self.store.work_table("VOR_BESTAND_EINDEUTIG", d, batch_id)), "STG_FB_BESTAND"),
            ("VOR_TRANSAKTION", lambda s: transforms.transform_transaktionen(s, rates()), "STG_FB_TRANSAKTION"),
            ("VOR_FONDSBEWEGUNG", lambda s: transforms.transform_fondsbewegungen(s, rates()),
             "STG_FB_FONDSBEWEGUNG"),
        ]
        try:
            return self._run_steps(batch_id, "TRANSFORMATION", [
                (target, lambda t=target, f=transform, o=origin: self._transform(t, f, o, batch_id, now))
                for target, transform, origin in steps], done)
        finally:
            self.store.discard_batches(batch_id)

    def _transform(self, target: str, transform, origin: str, batch_id: int, now: datetime) -> dict[str, int]:
        staged = self.store.read(origin, batch_id=batch_id)
        if self.on_duplicate == "latest" and target in transforms.CANONICAL_KEYS:
            staged = transforms.latest_delivery(staged, target)
        stored = with_arrival(self.store.work_table(target, transform(staged), batch_id))
        rows = self._numbered(target, stored, "vor_id").withColumn("verarbeitungszeit", moment(now))
        seen = self.store.replace_observed(target, rows, batch_id, **monitor.quality_measures(rows))
        self._check_unique(target, batch_id)
        return {"anzahl_saetze": seen.pop("n"), **seen}

    def _check_unique(self, table: str, batch_id: int) -> None:
        """The unique key of a validated table; repeats stop the load unless 'latest' handles them."""
        if self.on_duplicate != "fail":
            return
        repeated = unique_violations(self.store.read(table, batch_id=batch_id), TABLES[table].unique).limit(3).collect()
        if repeated:
            raise DuplicateKeyError(f"{table}: {[r.asDict() for r in repeated]}")

    # --- phase 3: star schema ---------------------------------------------

    def _current(self, table: str, code: str, sk: str) -> KeyTable:
        return KeyTable.build(self.store.read(table), code, sk)

    def load_dimensions(self, batch_id: int) -> None:
        for _, load in self._dimension_steps(batch_id):
            load()

    def _dimension_steps(self, batch_id: int) -> list[tuple[str, Callable[[], None]]]:
        now, today = self.clock(), self.clock().date()

        def securities() -> None:
            dim = self.store.read("DIM_WERTPAPIER")
            result = load_wertpapier(
                dim, self.store.read("VOR_WERTPAPIER", batch_id=batch_id),
                laender=self._current("DIM_LAND", "iso3_code", "land_id"),
                branchen=KeyTable.sectors(self.store.read("DIM_BRANCHE")),
                waehrungen=self._current("DIM_WAEHRUNG", "iso_code", "waehrung_id"),
                run_date=today, run_ts=now, batch_id=batch_id)
            self._publish_dimension("DIM_WERTPAPIER", result.snapshot(), ["isin"], next_number(dim, "wertpapier_sk"))

        def funds() -> None:
            dim = self.store.read("DIM_FONDS")
            result = load_fonds(
                dim, self.store.read("VOR_FONDS", batch_id=batch_id),
                laender=self._current("DIM_LAND", "iso3_code", "land_id"),
                waehrungen=self._current("DIM_WAEHRUNG", "iso_code", "waehrung_id"),
                run_date=today, run_ts=now, batch_id=batch_id)
            self._publish_dimension("DIM_FONDS", result.snapshot(), ["fonds_id"], next_number(dim, "fonds_sk"))

        def accounts() -> None:
            dim = self.store.read("DIM_DEPOT")
            fresh = new_depots(
                dim, self.store.read("VOR_BESTAND", batch_id=batch_id),
                self.store.read("VOR_TRANSAKTION", batch_id=batch_id), run_date=today, run_ts=now)
            self._publish_dimension(
                "DIM_DEPOT", dim.unionByName(fresh), ["depot_nr", "depotstelle"], next_number(dim, "depot_sk"))

        return [("DIM_WERTPAPIER", securities), ("DIM_FONDS", funds), ("DIM_DEPOT", accounts)]

    def _publish_dimension(self, table: str, snapshot: DataFrame, order: list[str], start: int) -> None:
        self.store.write_snapshot(table, assign_keys(snapshot, TABLES[table].id_column, order, start))

    def load_fact(self, load: FactLoad, batch_id: int, keys: Keys) -> int:
        now = self.clock()
        layout = TABLES[load.target]
        vor = self.store.read(load.source, batch_id=batch_id)
        rows = with_arrival(self.store.work_table(load.target, load.build(vor, keys), batch_id))
        # numbers of rows that turn out to be known already stay unused
        rows = self._numbered(load.target, rows, layout.id_column)
        rows, rejected = resolved(rows, load.required, self.on_unresolved)
        if self.on_unresolved == "reject":
            self.store.replace_rejects(load.target, rejected.drop(layout.id_column).withColumn("erstellt_am", moment(now)), batch_id)
        rows = rows.withColumn(layout.time_column, moment(now))
        if self.on_integrity == "fail":
            self._require_integrity(load.target, rows)

        if load.update is None:
            # only the months whose key filter knows one of the keys are read
            months = self.store.months_with_keys(load.target, rows, load.keys)
            fresh = insert_if_absent(self.store.read(load.target, months=months), rows, load.keys)
            count = self.store.write_months(load.target, fresh, load.date_key, replace=False)
            self.store.refresh_key_filters(load.target, load.keys)
            return count

        rows = one_per_key(rows, load.keys)
        # one number per calendar month of the delivery
        months = [r[0] for r in rows.select(month_of(load.date_key)).distinct().collect()]
        if not months:
            return 0
        merged = upsert(self.store.read(load.target, months=months), rows, load.keys, load.update)
        return self.store.write_months(load.target, merged, load.date_key, replace=True)

    def check_integrity(self, table: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Repeated keys, values without a parent row, and rows that break a column rule of a stored table."""
        rows, layout = self.store.read(table), TABLES[table]
        repeated = unique_violations(rows, layout.unique) if layout.unique else rows.limit(0)
        return repeated, reference_violations(rows, layout, self.store.read), row_violations(rows, layout)

    def _require_integrity(self, table: str, rows: DataFrame) -> None:
        layout = TABLES[table]
        orphans = reference_violations(rows, layout, self.store.read).limit(3).collect()
        broken = row_violations(rows, layout).select("regeln").limit(3).collect()
        if orphans or broken:
            raise IntegrityError(f"{table}: {[r.asDict() for r in [*orphans, *broken]]}")

    def run_zielbeladung(self, batch_id: int, done: set[str] = frozenset()) -> bool:
        """Dimensions, then facts."""
        built: list[Keys] = []

        def keys() -> Keys:
            if not built:
                built.append(Keys.build(*[self.store.read(t) for t in
                                          ("DIM_WERTPAPIER", "DIM_FONDS", "DIM_WAEHRUNG", "DIM_DEPOT")]))
            return built[0]

        facts = [(load.target, lambda load=load: {"anzahl_saetze": self.load_fact(load, batch_id, keys())}) for load in FACT_LOADS]
        try:
            return self._run_steps(batch_id, "ZIELBELADUNG", [*self._dimension_steps(batch_id), *facts], done)
        finally:
            self.store.discard_batches(batch_id)

    # --- entry points -----------------------------------------------------

    def run_daily_etl(self, lade_datum: date | None = None) -> int:
        """Staging, transformation and star-schema load of one date; returns the batch id."""
        day = lade_datum or self.clock().date()
        self.store.recover()
        batch_id = self.new_batch_id()
        self._run_phases(batch_id, day, {phase: set() for phase in PHASES})
        return batch_id

    def _run_phases(self, batch_id: int, day: date, finished: Mapping[str, set[str]]) -> None:
        """All phases of a batch.  A phase that runs changes what the next ones read, so those run whole."""
        every = {"STAGING": {s.name for s in SOURCE_SYSTEMS}, "TRANSFORMATION": set(VALIDATED),
                 "ZIELBELADUNG": {"DIM_WERTPAPIER", "DIM_FONDS", "DIM_DEPOT", *(load.target for load in FACT_LOADS)}}
        run = {"STAGING": lambda done: self.run_full_staging(batch_id, day, done),
               "TRANSFORMATION": lambda done: self.run_transformation(batch_id, done),
               "ZIELBELADUNG": lambda done: self.run_zielbeladung(batch_id, done)}
        ran = False
        with self._phase(batch_id, day, "GESAMT"):
            for phase in PHASES:
                done = set() if ran else finished.get(phase, set())
                if done >= every[phase]:
                    self._skip_phase(batch_id, day, phase)
                    continue
                with self._phase(batch_id, day, phase):
                    ran = run[phase](done) or ran

    def resume(self, batch_id: int | None = None) -> int | None:
        """Go on with a batch where it stopped: the given one, or the newest whose run did not end well.

        Steps that ended well are logged as skipped; the failed one and all
        after it run.  Every step replaces or leaves alone what an earlier try
        of it wrote.  Returns the batch, or None if there is nothing to do.
        """
        self.store.recover()
        runs = self.process_log().where("phase = 'GESAMT'")
        if batch_id is None:
            last = runs.orderBy(F.col("prozess_id").desc()).limit(1).collect()
            if not last or last[0].status in DONE:
                return None
            batch_id = last[0].batch_id
        self._run_phases(batch_id, self._batch_date(batch_id), self._finished_steps(batch_id))
        return batch_id

    def run_staging_only(self, lade_datum: date | None = None) -> int:
        """Stage one date and return the id the rows really carry."""
        day = lade_datum or self.clock().date()
        self.store.recover()
        batch_id = self.new_batch_id()
        with self._phase(batch_id, day, "STAGING"):
            self.run_full_staging(batch_id, day)
        return batch_id

    def _batch_date(self, batch_id: int) -> date:
        day = self.process_log().where(F.col("batch_id") == batch_id).agg(F.min("lade_datum")).first()[0]
        return day or self.clock().date()

    def run_transform_only(self, batch_id: int) -> None:
        with self._phase(batch_id, self._batch_date(batch_id), "TRANSFORMATION"):
            self.run_transformation(batch_id)

    def run_zielbeladung_only(self, batch_id: int) -> None:
        with self._phase(batch_id, self._batch_date(batch_id), "ZIELBELADUNG"):
            self.run_zielbeladung(batch_id)

    def last_batch_status(self) -> DataFrame:
        return monitor.last_batch_status(self.process_log())

    def check_data_quality(self, batch_id: int, *, with_fx: bool = False) -> DataFrame:
        """Invalid rows per validated table of a batch, with the verdict; tables without rows count 0.

        The counts were taken when the batch was written; a table whose last
        step left none, because it failed for one, is scanned.
        """
        labels = {**monitor.REPORT_TABLES, "VOR_WECHSELKURS": "Wechselkurse"}
        names = list(monitor.REPORT_TABLES) + (["VOR_WECHSELKURS"] if with_fx else [])
        report = monitor.stored_quality(self.step_log().where(F.col("batch_id") == batch_id), labels)
        counted = {r.tabelle for r in report.select("tabelle").collect()}  # seven at most
        missing = {n: self.store.read(n, batch_id=batch_id) for n in names if n not in counted}
        if missing:
            report = report.unionByName(monitor.quality_report(missing, labels={n: labels[n] for n in missing}))
        every = self.spark.createDataFrame(
            [(batch_id, n, labels[n]) for n in names], "batch_id bigint, tabelle string, bezeichnung string")
        full = every.join(report.drop("bezeichnung"), ["batch_id", "tabelle"], "left").na.fill(
            0, ["anzahl", "ungueltig", "ohne_eur_kurs"])
        return full.join(monitor.verdict(full).select("batch_id", "ergebnis"), "batch_id")

    def manual_run(self, lade_datum: date | None = None) -> tuple[int, DataFrame, DataFrame]:
        """Daily run followed by its process log and quality report."""
        batch_id = self.run_daily_etl(lade_datum)
        log = monitor.process_log_view(self.process_log().where(F.col("batch_id") == batch_id),
                                       self.clock().date(), days=36500)
        return batch_id, log, self.check_data_quality(batch_id)

    # --- retention --------------------------------------------------------

    def purge(self, days: int = RETENTION_DAYS) -> dict[str, int]:
        """Drop staged and validated batches and load-log entries past the limit.

        All rows of a batch share one load time, so whole partitions go and no
        file is rewritten.  Facts, dimensions and the process log stay.
        Returns the dropped rows per table.
        """
        now = self.clock()
        dropped = {}
        for table in STAGING + VALIDATED:
            old = expired_batches(self.store.read(table), TABLES[table].time_column, now, days).collect()
            for r in old:
                self.store.drop_batch(table, r["batch_id"])
            dropped[table] = sum(r["anzahl"] for r in old)
        dropped["STG_LADELOG"] = self._purge_load_log(now, days)
        return dropped

    def _purge_load_log(self, now: datetime, days: int) -> int:
        """Entries past the limit stay out of the log's next generation."""
        events = self.store.read("STG_LADELOG")
        kept = retain(events, "erstellt_am", now, days)
        gone = events.select("log_id").distinct().count() - kept.select("log_id").distinct().count()
        if gone:
            self.store.compact_log("STG_LADELOG", lambda rows: retain(rows, "erstellt_am", now, days))
        return gone
