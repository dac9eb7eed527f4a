"""Dimension loads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import canonical, moment
from ..operators.joins import anti
from ..operators.keys import KeyTable, with_key
from ..operators.scd2 import OPEN_END, Scd2Result, scd2
from ..schemas import TABLES

# Columns whose change opens a new version.
SECURITY_TRACKED = ["bezeichnung_lang", "wertpapiertyp", "asset_klasse", "emittent_name", "land_id",
                    "faelligkeitsdatum"]
FUND_TRACKED = ["fondsname", "fondstyp", "fondswaehrung_id", "kag_name", "investmentstrategie"]


def _valid(vor: DataFrame) -> DataFrame:
    return vor.where(F.col("ist_gueltig") == "J")


def security_delivery(
    vor: DataFrame, laender: KeyTable, branchen: KeyTable, waehrungen: KeyTable
) -> DataFrame:
    """Accepted securities of a batch with resolved country, sector and currency keys."""
    rows = _valid(vor)
    rows = with_key(rows, laender, canonical("land_iso3"), "land_id", spread_by=["isin"])
    rows = with_key(rows, branchen, canonical("branche_code"), "branche_id", spread_by=["isin"])
    return with_key(rows, waehrungen, canonical("handelswaehrung"), "waehrung_id", spread_by=["isin"])


def fund_delivery(vor: DataFrame, laender: KeyTable, waehrungen: KeyTable) -> DataFrame:
    """Accepted funds of a batch with resolved currency and domicile keys."""
    rows = _valid(vor)
    rows = with_key(rows, waehrungen, canonical("fondswaehrung"), "fondswaehrung_id", spread_by=["fonds_id"])
    return with_key(rows, laender, canonical("domizil_land"), "domizil_land_id", spread_by=["fonds_id"])


def load_wertpapier(
    dim: DataFrame, vor: DataFrame, *, laender: KeyTable, branchen: KeyTable, waehrungen: KeyTable,
    run_date: date, run_ts: datetime, batch_id: int,
) -> Scd2Result:
    """Security dimension.  The country is compared by its key, as the dimension stores no code."""
    return scd2(
        dim, security_delivery(vor, laender, branchen, waehrungen),
        key="isin", sk="wertpapier_sk", tracked=SECURITY_TRACKED,
        run_date=run_date, run_ts=run_ts, batch_id=batch_id,
    )


def load_fonds(
    dim: DataFrame, vor: DataFrame, *, laender: KeyTable, waehrungen: KeyTable,
    run_date: date, run_ts: datetime, batch_id: int,
) -> Scd2Result:
    """Fund dimension.  The currency is compared by its key."""
    return scd2(
        dim, fund_delivery(vor, laender, waehrungen),
        key="fonds_id", sk="fonds_sk", tracked=FUND_TRACKED,
        run_date=run_date, run_ts=run_ts, batch_id=batch_id,
    )


def new_depots(
    dim: DataFrame, vor_bestand: DataFrame, vor_transaktion: DataFrame, *, run_date: date, run_ts: datetime
) -> DataFrame:
    """Custody accounts not known yet: first from holdings, then from trades.

    Rejected rows count too.  Two spellings of the custodian for one account
    give two rows; known accounts are never changed.
    """
    layout = TABLES["DIM_DEPOT"]
    current = dim.where(F.col("ist_aktuell") == "J").select("depot_nr")

    held = vor_bestand.where(F.col("depot_nr").isNotNull()).select("depot_nr", "depotstelle").distinct()
    from_holdings = anti(held, current, ["depot_nr"])

    traded = vor_transaktion.where(F.col("depot_nr").isNotNull()).select("depot_nr").distinct()
    known = current.unionByName(held.select("depot_nr"))
    from_trades = anti(traded, known, ["depot_nr"]).withColumn("depotstelle", F.lit(None).cast("string"))

    values = {
        "gueltig_von": F.lit(run_date),
        "gueltig_bis": F.lit(OPEN_END),
        "ist_aktuell": F.lit("J"),
        "dwh_version": F.lit(1),
        "erstellt_am": moment(run_ts),
        "geaendert_am": moment(run_ts),
    }
    return from_holdings.unionByName(from_trades).withColumns(values).to(layout.schema)


def assign_keys(snapshot: DataFrame, sk: str, order_by: Sequence[str], start: int) -> DataFrame:
    """Give rows without a surrogate key the next free numbers, in natural key order."""
    from ..operators.numbering import number_rows

    keyed = snapshot.where(F.col(sk).isNotNull())
    fresh = number_rows(snapshot.where(F.col(sk).isNull()).drop(sk), order_by, sk, start=start)
    return keyed.unionByName(fresh.select(*keyed.columns))
