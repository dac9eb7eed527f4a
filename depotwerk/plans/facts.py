"""Fact rows from validated rows, and how each fact table is merged.

Facts are matched on natural keys; the surrogate keys are outputs.  A snapshot
fact takes the newly resolved keys on a match, a transaction fact stays as it
was first loaded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import canonical, flow_sign, trade_sign, zeit_id
from ..operators.joins import PIECES
from ..operators.keys import KeyTable, with_key
from ..schemas import TABLES


@dataclass(frozen=True)
class Keys:
    """Key tables of the dimensions a fact load needs."""

    wertpapier: KeyTable
    fonds: KeyTable
    waehrung: KeyTable
    depot: KeyTable

    @classmethod
    def build(cls, wertpapier: DataFrame, fonds: DataFrame, waehrung: DataFrame, depot: DataFrame) -> Keys:
        return cls(
            KeyTable.build(wertpapier, "isin", "wertpapier_sk"),
            KeyTable.build(fonds, "fonds_id", "fonds_sk"),
            KeyTable.build(waehrung, "iso_code", "waehrung_id"),
            KeyTable.build(depot, "depot_nr", "depot_sk"),
        )


# Columns replaced on a match.  Surrogate keys belong to them because the match
# is on natural keys; the currency keys of a holding are set once.
PRICE_UPDATE = ["wertpapier_sk", "kurs", "kurs_in_eur", "wechselkurs_eur", "kurs_quelle", "kurs_qualitaet",
                "erstellt_am", "batch_id"]
FX_UPDATE = ["waehrung_von_id", "waehrung_nach_id", "kurs", "erstellt_am", "batch_id"]
HOLDING_UPDATE = ["fonds_sk", "wertpapier_sk", "depot_sk", "nominale", "stueckzahl", "einstandskurs",
                  "einstandswert", "aktueller_kurs", "marktwert", "unrealisierter_gv",
                  "marktwert_fondswaehrung", "einstandswert_fondswaehrung", "wechselkurs", "marktwert_eur",
                  "einstandswert_eur", "wechselkurs_eur", "portfoliogewicht", "erstellt_am", "batch_id"]


def _valid(vor: DataFrame) -> DataFrame:
    return vor.where(F.col("ist_gueltig") == "J")


def _fact(rows: DataFrame, table: str, computed: dict[str, Column]) -> DataFrame:
    """Columns of a fact table without id and load time; what the source lacks is NULL."""
    layout = TABLES[table]
    return rows.withColumns(computed).to(layout.schema_without(layout.id_column, layout.time_column))


def price_rows(vor: DataFrame, keys: Keys) -> DataFrame:
    rows = with_key(_valid(vor), keys.wertpapier, "isin", "wertpapier_sk", spread_by=["vor_id"])
    rows = with_key(rows, keys.waehrung, canonical("waehrung"), "waehrung_id", spread_by=["vor_id"])
    return _fact(rows, "FAKT_KURS", {"zeit_id": zeit_id("kursdatum")})


def fx_rows(vor: DataFrame, keys: Keys) -> DataFrame:
    rows = with_key(_valid(vor), keys.waehrung, canonical("waehrung_von"), "waehrung_von_id", spread_by=["vor_id"])
    rows = with_key(rows, keys.waehrung, canonical("waehrung_nach"), "waehrung_nach_id", spread_by=["vor_id"])
    return _fact(rows, "FAKT_WECHSELKURS", {"zeit_id": zeit_id("kursdatum")})


def holding_measures() -> dict[str, Column]:
    """Derived amounts.

    The cost value in fund currency is the unconverted cost value, and the cost
    value in EUR uses the rate of the fund currency (1 where there is none).
    """
    cost = F.col("einstandswert")
    return {
        "unrealisierter_gv": F.col("marktwert") - F.coalesce(cost, F.lit(0).cast("decimal(20,2)")),
        "einstandswert_fondswaehrung": cost,
        "einstandswert_eur": cost * F.coalesce(F.col("wechselkurs_eur"), F.lit(1).cast("decimal(15,8)")),
    }


def holding_rows(vor: DataFrame, keys: Keys, *, pieces: int = PIECES) -> DataFrame:
    rows, spread = _valid(vor), {"spread_by": ["vor_id"], "pieces": pieces}
    rows = with_key(rows, keys.fonds, "fonds_id", "fonds_sk", **spread)
    rows = with_key(rows, keys.wertpapier, "isin", "wertpapier_sk", **spread)
    rows = with_key(rows, keys.depot, "depot_nr", "depot_sk", **spread)
    rows = with_key(rows, keys.waehrung, canonical("waehrung_papier"), "waehrung_papier_id", **spread)
    rows = with_key(rows, keys.waehrung, canonical("waehrung_fonds"), "waehrung_fonds_id", **spread)
    return _fact(rows, "FAKT_BESTAND", {"zeit_id": zeit_id("bewertungsdatum"), **holding_measures()})


def _three_dates() -> dict[str, Column]:
    return {
        "zeit_id_handel": zeit_id("handelsdatum"),
        "zeit_id_valuta": zeit_id("valutatdatum"),
        "zeit_id_buchung": zeit_id("buchungsdatum"),
    }


def trade_rows(vor: DataFrame, keys: Keys) -> DataFrame:
    rows, spread = _valid(vor), ["vor_id"]
    rows = with_key(rows, keys.fonds, "fonds_id", "fonds_sk", spread_by=spread)
    rows = with_key(rows, keys.wertpapier, "isin", "wertpapier_sk", spread_by=spread)
    rows = with_key(rows, keys.depot, "depot_nr", "depot_sk", spread_by=spread)
    rows = with_key(rows, keys.waehrung, canonical("waehrung"), "waehrung_id", spread_by=spread)
    return _fact(rows, "FAKT_TRANSAKTION", {
        **_three_dates(), "vorzeichen": trade_sign("transaktionstyp_normiert"),
    })


def flow_rows(vor: DataFrame, keys: Keys) -> DataFrame:
    rows, spread = _valid(vor), ["vor_id"]
    rows = with_key(rows, keys.fonds, "fonds_id", "fonds_sk", spread_by=spread)
    rows = with_key(rows, keys.depot, "depot_nr", "depot_sk", spread_by=spread)
    rows = with_key(rows, keys.waehrung, canonical("waehrung"), "waehrung_id", spread_by=spread)
    return _fact(rows, "FAKT_FONDSBEWEGUNG", {
        **_three_dates(), "vorzeichen": flow_sign("bewegungstyp_normiert"),
    })


@dataclass(frozen=True)
class FactLoad:
    """One fact table: its source, builder, match keys and merge rule."""

    target: str
    source: str
    build: object
    keys: tuple[str, ...]
    date_key: str
    required: tuple[str, ...]
    update: tuple[str, ...] | None  # None: append if absent


# Load order: rates and prices first, then positions and movements.
FACT_LOADS = [
    FactLoad("FAKT_WECHSELKURS", "VOR_WECHSELKURS", fx_rows, TABLES["FAKT_WECHSELKURS"].unique,
             "zeit_id", ("waehrung_von_id", "waehrung_nach_id"), tuple(FX_UPDATE)),
    FactLoad("FAKT_KURS", "VOR_KURS", price_rows, TABLES["FAKT_KURS"].unique,
             "zeit_id", ("wertpapier_sk", "waehrung_id"), tuple(PRICE_UPDATE)),
    FactLoad("FAKT_BESTAND", "VOR_BESTAND", holding_rows, TABLES["FAKT_BESTAND"].unique,
             "zeit_id", ("fonds_sk", "wertpapier_sk"), tuple(HOLDING_UPDATE)),
    FactLoad("FAKT_TRANSAKTION", "VOR_TRANSAKTION", trade_rows, TABLES["FAKT_TRANSAKTION"].unique,
             "zeit_id_handel", ("fonds_sk", "wertpapier_sk"), None),
    FactLoad("FAKT_FONDSBEWEGUNG", "VOR_FONDSBEWEGUNG", flow_rows, TABLES["FAKT_FONDSBEWEGUNG"].unique,
             "zeit_id_handel", ("fonds_sk",), None),
]
