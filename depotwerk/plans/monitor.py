"""Status, quality and log views."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import de_date, de_timestamp, moment, run_time

LOG_DAYS = 30

# Report label per validated table.
REPORT_TABLES = {
    "VOR_WERTPAPIER": "Wertpapier-Stammdaten",
    "VOR_FONDS": "Fonds-Stammdaten",
    "VOR_KURS": "Kursdaten",
    "VOR_BESTAND": "Bestandsdaten",
    "VOR_TRANSAKTION": "Transaktionsdaten",
    "VOR_FONDSBEWEGUNG": "Fondsbewegungsdaten",
}
PHASES = {"STAGING": "status_staging", "TRANSFORMATION": "status_transform",
          "ZIELBELADUNG": "status_zielladen"}


def latest_events(events: DataFrame, key: str) -> DataFrame:
    """Current state of an append-only log: the last event per entry."""
    window = Window.partitionBy(key).orderBy(F.col("ereignis_nr").desc())
    return (
        events.withColumn("__r", F.row_number().over(window)).where("__r = 1").drop("__r", "ereignis_nr")
    )


def last_batch_status(log: DataFrame) -> DataFrame:
    """Newest overall run with the newest status of each phase; one row, NULLs when there is no run."""
    newest = (
        log.where(F.col("phase") == "GESAMT")
        .orderBy(F.col("prozess_id").desc()).limit(1)
        .select("batch_id", "lade_datum", F.col("status").alias("status_gesamt"),
                F.col("fehlermeldung").alias("__fehler"))
    )
    phases = (
        log.where(F.col("phase") != "GESAMT")
        .join(F.broadcast(newest.select("batch_id")), "batch_id", "left_semi")
        .groupBy("batch_id")
        .agg(
            *[
                F.max_by("status", F.when(F.col("phase") == phase, F.col("prozess_id"))).alias(column)
                for phase, column in PHASES.items()
            ],
            F.max_by("fehlermeldung", F.when(F.col("fehlermeldung").isNotNull(), F.col("prozess_id")))
            .alias("__phasenfehler"),
        )
    )
    found = newest.join(phases, "batch_id", "left").select(
        "batch_id", "lade_datum", *PHASES.values(), "status_gesamt",
        F.coalesce("__phasenfehler", "__fehler").alias("fehler_detail"),
    )
    # an aggregate without keys yields its one row even when nothing was found
    return found.agg(*[F.first(c).alias(c) for c in found.columns])


def quality_measures(rows: DataFrame) -> dict[str, Column]:
    """Aggregates of a validated table: rejected rows, and accepted rows that got no EUR rate."""
    no_rate = (
        F.count_if((F.col("ist_gueltig") == "J") & F.col("wechselkurs_eur").isNull())
        if "wechselkurs_eur" in rows.columns
        else F.count_if(F.lit(False))
    )
    return {"ungueltig": F.count_if(F.col("ist_gueltig") == "N"), "ohne_eur_kurs": no_rate}


def quality_report(
    tables: Mapping[str, DataFrame], *, with_fx: bool = False, labels: Mapping[str, str] | None = None
) -> DataFrame:
    """Invalid rows per validated table and batch, one counting pass per table.

    ``ohne_eur_kurs`` counts accepted rows that got no EUR rate.  Batches
    without a row in a table have no line for it.  ``labels`` names other
    tables than those of the report.
    """
    wanted = dict(labels or REPORT_TABLES)
    if with_fx:
        wanted["VOR_WECHSELKURS"] = "Wechselkurse"
    parts = []
    for name in wanted:
        df = tables[name]
        measures = [c.alias(n) for n, c in quality_measures(df).items()]
        parts.append(
            df.groupBy("batch_id").agg(F.count("*").alias("anzahl"), *measures).select(
                "batch_id", F.lit(name).alias("tabelle"), F.lit(wanted[name]).alias("bezeichnung"),
                "anzahl", "ungueltig", "ohne_eur_kurs")
        )
    return reduce(DataFrame.unionByName, parts)


def stored_quality(steps: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """The report from the counts that the step log holds, of the last try of each table that was not skipped."""
    tries = steps.where((F.col("phase") == "TRANSFORMATION") & (F.col("status") != "UEBERSPRUNGEN"))
    last = tries.groupBy("batch_id", "tabelle").agg(
        *[F.max_by(c, "schritt_id").alias(c) for c in ("status", "anzahl_saetze", "ungueltig", "ohne_eur_kurs")])
    label = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])[F.col("tabelle")]
    return last.where("status = 'ERFOLGREICH' AND ungueltig IS NOT NULL").select(
        "batch_id", "tabelle", label.alias("bezeichnung"), F.col("anzahl_saetze").alias("anzahl"), "ungueltig", "ohne_eur_kurs")


def verdict(report: DataFrame) -> DataFrame:
    """OK or WARNUNG per batch."""
    return report.groupBy("batch_id").agg(F.sum("ungueltig").alias("ungueltig")).withColumn(
        "ergebnis", F.when(F.col("ungueltig") > 0, "WARNUNG").otherwise("OK")
    )


def process_log_view(log: DataFrame, run_date: date, days: int = LOG_DAYS) -> DataFrame:
    """Process log of the last days, newest first, run time in minutes."""
    return (
        log.where(F.col("lade_datum") >= F.date_sub(F.lit(run_date), days))
        .orderBy(F.col("prozess_id").desc())
        .select(
            "prozess_id", "batch_id", de_date("lade_datum").alias("lade_datum"), "phase", "status",
            de_timestamp("prozessstart").alias("prozessstart"),
            de_timestamp("prozessende").alias("prozessende"),
            run_time("prozessstart", "prozessende", 60).alias("laufzeit_minuten"),
            "fehlermeldung",
        )
    )


def load_log_view(log: DataFrame, run_ts: datetime, days: int = LOG_DAYS) -> DataFrame:
    """Load log of the last days, newest first, run time in seconds."""
    since = moment(run_ts) - F.expr(f"interval {days} days")
    return (
        log.where(F.col("ladestart") >= since)
        .orderBy(F.col("log_id").desc())
        .select(
            "log_id", "batch_id", "quellsystem", "tabelle", "status", "anzahl_saetze",
            de_timestamp("ladestart").alias("ladestart"),
            de_timestamp("ladeende").alias("ladeende"),
            run_time("ladestart", "ladeende", 1).alias("laufzeit_sekunden"),
            "fehlermeldung",
        )
    )


def phase_stats(log: DataFrame, like: str | None = None) -> DataFrame:
    """Runs, failures, last start and last duration per phase, of those whose name is like a pattern if one is given."""
    if like is not None:
        log = log.where(F.col("phase").like(like))
    return log.groupBy("phase").agg(
        F.count("*").alias("run_count"),
        F.count_if(F.col("status") == "FEHLER").alias("failure_count"),
        F.max("prozessstart").alias("last_start"),
        F.max_by(run_time("prozessstart", "prozessende", 1), F.struct("prozessstart", "prozess_id"))
        .alias("last_run_seconds"),
    )


def invalid_rows(vor: DataFrame, *keys: str) -> DataFrame:
    """Rejected rows with their error text."""
    return vor.where(F.col("ist_gueltig") == "N").select("batch_id", *keys, "validierungsfehler")
