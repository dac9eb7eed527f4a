"""Delivery -> staging rows.

Raw values are copied as they are; only the stated columns are derived.  Each
function returns the business columns of its ``STG_`` table; batch id, arrival
id and load time are added on write.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import concat_text, empty_to_null, moment
from ..operators.numbering import ARRIVAL
from ..schemas import TABLES
from .readers import delivered, rows_of_day

# Names of the source systems and the constant source status.
ACCOUNTING, PRICE_FEED, MASTER_DATA = "FONDSBUCHHALTUNG", "KURSVERSORGUNG", "WERTPAPIERSTAMMDATEN"
DONE = "ABGESCHLOSSEN"


def _times_rate(amount: str) -> Column:
    return (F.col(amount).cast("decimal(20,2)") * F.col("wechselkurs").cast("decimal(15,8)")).cast("decimal(20,2)")


def _stage(delivery: DataFrame, table: str, derived: dict[str, Column], run_ts: datetime) -> DataFrame:
    layout = TABLES[table]
    now = moment(run_ts)
    changed = F.col("src_geaendert_am") if "src_geaendert_am" in delivery.columns else now  # a delta brings its own
    values = {"src_erstellt_am": now, "src_geaendert_am": changed, **derived}
    schema = layout.schema_without(layout.id_column, layout.time_column, layout.partition)
    for name in ARRIVAL:  # where a row comes from is kept until it has its number
        if name in delivery.columns:
            schema = schema.add(name, delivery.schema[name].dataType)
    return empty_to_null(delivered(delivery, table)).withColumns(values).to(schema)


def stage_bestand(delivery: DataFrame, lade_datum: date | None, run_ts: datetime) -> DataFrame:
    """Holdings of one valuation date."""
    rows = rows_of_day(delivery, "bewertungsdatum", lade_datum)
    return _stage(rows, "STG_FB_BESTAND", {"marktwert_fondswaehrung": _times_rate("marktwert")}, run_ts)


def stage_transaktion(delivery: DataFrame, lade_datum: date | None, run_ts: datetime) -> DataFrame:
    """Trades of one trade date."""
    rows = rows_of_day(delivery, "handelsdatum", lade_datum)
    return _stage(rows, "STG_FB_TRANSAKTION", {
        "gesamtbetrag_fondswaehrung": _times_rate("gesamtbetrag"),
        "src_transaktions_nr": F.col("transaktions_id"),
        "src_status": F.lit(DONE),
    }, run_ts)


def stage_fondsbewegung(delivery: DataFrame, lade_datum: date | None, run_ts: datetime) -> DataFrame:
    """Fund flows of one trade date."""
    rows = rows_of_day(delivery, "handelsdatum", lade_datum)
    return _stage(rows, "STG_FB_FONDSBEWEGUNG", {
        "src_bewegungs_nr": F.col("bewegungs_id"),
        "src_status": F.lit(DONE),
    }, run_ts)


def stage_kurs(delivery: DataFrame, lade_datum: date | None, run_ts: datetime) -> DataFrame:
    """Prices of one price date."""
    rows = rows_of_day(delivery, "kursdatum", lade_datum)
    return _stage(rows, "STG_KV_KURS", {"src_kurs_id": F.col("kurs_id")}, run_ts)


def fx_source_id() -> Column:
    return concat_text(F.lit("WK-"), "waehrung_von", "waehrung_nach", F.date_format("kursdatum", "yyyyMMdd"))


def stage_wechselkurs(delivery: DataFrame, lade_datum: date | None, run_ts: datetime) -> DataFrame:
    """Exchange rates of one date, with a source id built from the pair and the date."""
    rows = rows_of_day(delivery, "kursdatum", lade_datum)
    return _stage(rows, "STG_KV_WECHSELKURS", {"src_kurs_id": fx_source_id()}, run_ts)


def stage_wertpapier(delivery: DataFrame, lade_datum: date | None, run_ts: datetime) -> DataFrame:
    """Security master: full delivery or delta, no date filter."""
    return _stage(delivery, "STG_WP_STAMMDATEN", {"src_wertpapier_id": F.col("isin")}, run_ts)


def stage_fonds(delivery: DataFrame, lade_datum: date | None, run_ts: datetime) -> DataFrame:
    """Fund master."""
    return _stage(delivery, "STG_WP_FONDS_STAMMDATEN", {"src_fonds_id": F.col("fonds_id")}, run_ts)


@dataclass(frozen=True)
class SourceSystem:
    """One source system: its tables are published together or not at all."""

    name: str
    loads: tuple[tuple[str, Callable[[DataFrame, date | None, datetime], DataFrame]], ...]


# Load order: master data, prices, accounting.
SOURCE_SYSTEMS = [
    SourceSystem(MASTER_DATA, (("STG_WP_STAMMDATEN", stage_wertpapier),
                               ("STG_WP_FONDS_STAMMDATEN", stage_fonds))),
    SourceSystem(PRICE_FEED, (("STG_KV_KURS", stage_kurs), ("STG_KV_WECHSELKURS", stage_wechselkurs))),
    SourceSystem(ACCOUNTING, (("STG_FB_BESTAND", stage_bestand),
                              ("STG_FB_TRANSAKTION", stage_transaktion),
                              ("STG_FB_FONDSBEWEGUNG", stage_fondsbewegung))),
]
