"""Test tables -> staging layout.

The column expressions are plain SQL that Spark and DuckDB read alike, so both
sides of a comparison start from the same staged rows.  Some values are broken
on purpose (short, lower-case and missing security numbers, blanks around
codes, missing amounts, unknown codes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import lookup


def pick(index: str, *values: str | None) -> str:
    """``CASE index WHEN 0 THEN ... END``; None stands for NULL."""
    arms = " ".join(f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


def floor_div(a: str, b: int) -> str:
    return f"cast(({a} - {a} % {b}) / {b} AS bigint)"


def security_number(part: str) -> str:
    """Well-formed number of a part."""
    return f"'DE' || lpad(cast({part} AS string), 9, '0') || cast({part} % 10 AS string)"


def raw_security_number(part: str) -> str:
    """The same with three kinds of damage."""
    return (f"CASE {part} % 20 WHEN 0 THEN 'DE' || cast({part} AS string) "
            f"WHEN 1 THEN 'de' || lpad(cast({part} AS string), 9, '0') || cast({part} % 10 AS string) "
            f"WHEN 2 THEN NULL ELSE {security_number(part)} END")


def fund_number(supplier: str) -> str:
    return f"'FONDS' || lpad(cast({supplier} AS string), 9, '0')"


def currency(index: str) -> str:
    return pick(f"{index} % 5", "EUR", " usd", "GBP", "CHF", "JPY")


def money(x: str) -> str:
    return f"cast({x} AS decimal(20,2))"


def hundredths(x: str) -> str:
    return f"cast({x} AS decimal(4,2))"


# price = value / quantity with six digits, half up, in whole numbers
_CENTS = "cast(round(l_extendedprice * 100) AS bigint)"
_QTY = "cast(l_quantity AS bigint)"
_TWICE = f"({_CENTS} * 20000 + {_QTY})"
UNIT_PRICE = (f"cast(cast(({_TWICE} - {_TWICE} % (2 * {_QTY})) / (2 * {_QTY}) AS decimal(18,0)) "
              f"* cast(0.000001 AS decimal(7,6)) AS decimal(20,6))")

BATCH_BY_LINE = "cast(CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END AS bigint)"
VALUE = money("l_extendedprice")

# order of arrival of staged lineitem rows, newest last
ARRIVAL = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_quantity"]

STG: dict[str, dict[str, str]] = {
    "STG_FB_BESTAND": {
        "batch_id": BATCH_BY_LINE,
        "fonds_id": fund_number("l_suppkey"),
        "isin": raw_security_number("l_partkey"),
        "bewertungsdatum": "last_day(cast(l_shipdate AS date))",
        "stueckzahl": "cast(l_quantity AS decimal(20,6))",
        "einstandskurs": UNIT_PRICE,
        "einstandswert": f"cast({VALUE} * (1 - {hundredths('l_discount')}) AS decimal(20,2))",
        "aktueller_kurs": UNIT_PRICE,
        "marktwert": VALUE,
        "waehrung_fonds": currency("s_nationkey"),
        "waehrung_papier": currency("l_partkey"),
        "wechselkurs": f"cast(1 + {hundredths('l_tax')} AS decimal(15,8))",
        "marktwert_fondswaehrung": f"cast({VALUE} * (1 + {hundredths('l_tax')}) AS decimal(20,2))",
        "depot_nr": "CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE 'DEPOT' || cast(l_suppkey % 7 AS string) END",
        "depotstelle": "'BANK' || cast(l_suppkey % 7 AS string)",
    },
    "STG_KV_WECHSELKURS": {
        "stg_id": "o_orderkey",
        "batch_id": "cast(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END AS bigint)",
        "waehrung_von": pick("o_custkey % 4", "USD", " gbp", "CHF", "JPY"),
        "waehrung_nach": "'EUR'",
        "kursdatum": "cast(o_orderdate AS date)",
        "kurstyp": pick("o_orderkey % 3", "EZB", " referenz", "GELD"),
        "kurs": "cast(cast(0.5 AS decimal(4,3)) + cast(o_orderkey % 1000 AS decimal(6,0)) "
                "* cast(0.001 AS decimal(4,3)) AS decimal(20,8))",
    },
    "STG_KV_KURS": {
        "batch_id": BATCH_BY_LINE,
        "isin": raw_security_number("l_partkey"),
        "kursdatum": "cast(l_shipdate AS date)",
        "kurstyp": pick("l_linenumber % 2", " schluss", "GELD"),
        "kurs": UNIT_PRICE,
        "waehrung": currency("l_suppkey"),
        "boerse": "CASE l_returnflag WHEN 'A' THEN 'XETRA' WHEN 'R' THEN 'NASDAQ' END",
        "kurs_quelle": "'QUELLE' || cast(l_suppkey % 3 AS string)",
        "kurs_qualitaet": "'EOD'",
    },
    "STG_FB_TRANSAKTION": {
        "batch_id": BATCH_BY_LINE,
        "transaktions_id": "cast(o_orderkey AS string) || '-' || cast(l_linenumber AS string)",
        "fonds_id": fund_number("o_custkey % 97"),
        "isin": raw_security_number("l_partkey"),
        "transaktionstyp": "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN ' buy ' WHEN '2' THEN 'Verkauf' "
                           "WHEN '3' THEN 'SWAP' WHEN '4' THEN 'Kaufauftrag' END",
        "handelsdatum": "cast(o_orderdate AS date)",
        "valutatdatum": "CASE WHEN l_linenumber = 7 THEN NULL ELSE cast(l_shipdate AS date) END",
        "buchungsdatum": "CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE cast(l_shipdate AS date) END",
        "stueckzahl": "cast(l_quantity AS decimal(20,6))",
        "kurs": UNIT_PRICE,
        "transaktionswert": VALUE,
        "provision": f"CASE WHEN l_discount = 0 THEN NULL ELSE cast({VALUE} * {hundredths('l_discount')} "
                     f"* cast(0.01 AS decimal(3,2)) AS decimal(20,2)) END",
        "stueckzinsen": f"cast({VALUE} * {hundredths('l_tax')} * cast(0.01 AS decimal(3,2)) AS decimal(20,2))",
        "gesamtbetrag": f"CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE {VALUE} END",
        "waehrung": currency("o_custkey"),
        "kontrahent": "'KONTRAHENT' || cast(l_suppkey % 5 AS string)",
        "depot_nr": "'DEPOT' || cast(o_custkey % 11 AS string)",
    },
    "STG_FB_FONDSBEWEGUNG": {
        "batch_id": "cast(1 + event_id % 2 AS bigint)",
        "bewegungs_id": "cast(event_id AS string)",
        "fonds_id": fund_number("user_id"),
        "bewegungstyp": "CASE event_type WHEN 'purchase' THEN 'Subscription' WHEN 'signup' THEN ' ZEICHNUNG' "
                        "WHEN 'click' THEN 'redemption' WHEN 'view' THEN 'AUSSCHUETTUNG' ELSE 'xyz' END",
        "handelsdatum": "cast(ts AS date) - 8766",
        "valutatdatum": "cast(ts AS date) - 8764",
        "buchungsdatum": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE cast(ts AS date) - 8763 END",
        "anteile": "cast(value AS decimal(20,6))",
        "anteilswert_nav": "cast(10 AS decimal(20,6))",
        "ausgabeaufschlag": "cast(cast(event_id % 40 AS decimal(4,0)) * cast(0.001 AS decimal(4,3)) AS decimal(10,4))",
        "bruttobetrag": "cast(cast(value AS decimal(20,2)) * 10 AS decimal(20,2))",
        "nettobetrag": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE cast(cast(value AS decimal(20,2)) * 9 AS decimal(20,2)) END",
        "depot_nr": "'DEPOT' || cast(user_id % 13 AS string)",
        "anleger_id": "'ANLEGER' || cast(user_id AS string)",
        "waehrung": currency("user_id"),
    },
    "STG_WP_STAMMDATEN": {
        "isin": raw_security_number("p_partkey"),
        "bezeichnung_lang": "' ' || p_name || ' '",
        "wertpapiertyp": "lower(p_type)",
        "asset_klasse": pick("p_partkey % 3", "aktien", " renten", None),
        "emittent_name": "p_brand",
        "land_emittent": pick("p_partkey % 9", "DEU", "aut", "CHE", " usa ", "GBR", "JPN", "LUX", "IRL", "XXX"),
        "branche_code": pick("p_size % 12", "10", "15", "20", "25", "30", "35", "40", "45", " it ", "Finanz", "60",
                             "99"),
        "nominalwert": "cast(p_retailprice AS decimal(20,4))",
        "faelligkeitsdatum": "cast('2030-01-01' AS date) + p_size",
        "handelswaehrung": currency("p_partkey"),
    },
    "STG_WP_FONDS_STAMMDATEN": {
        "fonds_id": fund_number("s_suppkey"),
        "fondsname": "s_name",
        "fondstyp": pick("s_suppkey % 2", "publikumsfonds", "SPEZIALFONDS"),
        "investmentstrategie": pick("s_nationkey % 3", "Wachstum", None, "Ertrag"),
        "fondswaehrung": currency("s_nationkey"),
        "kag_name": "'KAG' || cast(s_nationkey AS string)",
        "domizil_land": pick("s_nationkey % 4", "DEU", "lux", "IRL", "ZZZ"),
    },
}

# What the second delivery of the master data changes.
SECOND_DELIVERY = {
    "STG_WP_STAMMDATEN": {"wertpapiertyp": "CASE WHEN p_partkey % 7 = 0 THEN 'promo' ELSE lower(p_type) END",
                          "branche_code": "'10'"},
    "STG_WP_FONDS_STAMMDATEN": {"kag_name": "'KAG' || cast(s_nationkey AS string) || "
                                            "CASE WHEN s_suppkey % 7 = 0 THEN ' neu' ELSE '' END"},
}
# The first delivery lacks some rows, so the second brings new keys.
MISSING_FIRST = {"STG_WP_STAMMDATEN": "p_partkey % 11 = 0", "STG_WP_FONDS_STAMMDATEN": "s_suppkey % 11 = 0"}

# Rows broken further for the rule checks, one error per remainder.
BROKEN = {
    "STG_KV_WECHSELKURS": {
        "kurs": "CASE o_orderkey % 50 WHEN 0 THEN cast(0 AS decimal(20,8)) WHEN 1 THEN NULL "
                "WHEN 2 THEN cast(-1 AS decimal(20,8)) ELSE {kurs} END",
        "waehrung_von": "CASE WHEN o_orderkey % 50 IN (2, 3) THEN NULL ELSE {waehrung_von} END",
        "waehrung_nach": "CASE WHEN o_orderkey % 50 IN (3, 4) THEN NULL ELSE {waehrung_nach} END",
    },
    "STG_KV_KURS": {
        "kurs": "CASE l_orderkey % 50 WHEN 0 THEN cast(0 AS decimal(20,6)) WHEN 1 THEN NULL "
                "WHEN 2 THEN cast(-1 AS decimal(20,6)) ELSE {kurs} END",
        "waehrung": "CASE WHEN l_orderkey % 50 IN (2, 3) THEN NULL ELSE {waehrung} END",
    },
    "STG_FB_BESTAND": {
        "fonds_id": "CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE {fonds_id} END",
        "bewertungsdatum": "CASE WHEN l_orderkey % 50 = 1 THEN NULL ELSE {bewertungsdatum} END",
        "marktwert": "CASE WHEN l_orderkey % 50 IN (1, 2) THEN NULL ELSE {marktwert} END",
    },
    "STG_FB_TRANSAKTION": {
        "transaktions_id": "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE {transaktions_id} END",
        "fonds_id": "CASE WHEN o_orderkey % 50 IN (0, 1) THEN NULL ELSE {fonds_id} END",
        "handelsdatum": "CASE WHEN o_orderkey % 50 = 2 THEN NULL ELSE {handelsdatum} END",
    },
    "STG_FB_FONDSBEWEGUNG": {
        "bewegungs_id": "CASE WHEN event_id % 50 = 0 THEN NULL ELSE {bewegungs_id} END",
        "fonds_id": "CASE WHEN event_id % 50 IN (0, 1) THEN NULL ELSE {fonds_id} END",
        "handelsdatum": "CASE WHEN event_id % 50 = 2 THEN NULL ELSE {handelsdatum} END",
        "anteile": "CASE WHEN event_id % 50 IN (2, 3) THEN NULL ELSE {anteile} END",
    },
    "STG_WP_STAMMDATEN": {
        "bezeichnung_lang": "CASE WHEN p_partkey % 50 IN (3, 4) THEN NULL ELSE {bezeichnung_lang} END",
        "wertpapiertyp": "CASE WHEN p_partkey % 50 IN (4, 5) THEN NULL ELSE {wertpapiertyp} END",
    },
    "STG_WP_FONDS_STAMMDATEN": {
        "fonds_id": "CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE {fonds_id} END",
        "fondsname": "CASE WHEN s_suppkey % 10 IN (0, 1) THEN NULL ELSE {fondsname} END",
        "fondstyp": "CASE WHEN s_suppkey % 10 = 2 THEN NULL ELSE {fondstyp} END",
        "fondswaehrung": "CASE WHEN s_suppkey % 10 IN (2, 3) THEN NULL ELSE {fondswaehrung} END",
    },
}

LOG = {
    "prozess_id": "event_id",
    "log_id": "event_id",
    "batch_id": floor_div("event_id", 4),
    "lade_datum": "cast(ts AS date)",
    "phase": pick("event_id % 4", "GESAMT", "STAGING", "TRANSFORMATION", "ZIELBELADUNG"),
    "quellsystem": pick("event_id % 3", "FONDSBUCHHALTUNG", "KURSVERSORGUNG", "WERTPAPIERSTAMMDATEN"),
    "tabelle": pick("event_id % 3", "STG_FB_BESTAND", "STG_KV_KURS", "STG_WP_STAMMDATEN"),
    "status": "CASE event_type WHEN 'error' THEN 'FEHLER' ELSE 'ERFOLGREICH' END",
    "anzahl_saetze": "cast(round(value * 100) AS bigint)",
    "fehlermeldung": "CASE event_type WHEN 'error' THEN 'Fehler ' || props END",
}


def columns(table: str, second: bool = False, broken: bool = False) -> dict[str, str]:
    base = dict(STG[table])
    if second:
        base.update(SECOND_DELIVERY[table])
    if broken:
        base.update({c: e.format(**base) for c, e in BROKEN[table].items()})
    return base


def select_list(exprs: dict[str, str]) -> list[str]:
    return [f"{e} AS {c}" for c, e in exprs.items()]


class Tables:
    """The given tables and the staging rows derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        """A given table."""
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _origin(self, table: str) -> DataFrame:
        if table == "STG_FB_BESTAND":
            supplier = self.raw("supplier").selectExpr("s_suppkey AS l_suppkey", "s_nationkey")
            return lookup(self.raw("lineitem"), supplier, ["l_suppkey"], spread_by=ARRIVAL, how="inner")
        if table == "STG_FB_TRANSAKTION":
            return self.raw("orders").join(
                self.raw("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
        name = {"STG_KV_WECHSELKURS": "orders", "STG_KV_KURS": "lineitem", "STG_FB_FONDSBEWEGUNG": "events",
                "STG_WP_STAMMDATEN": "part", "STG_WP_FONDS_STAMMDATEN": "supplier"}[table]
        return self.raw(name)

    def stg(self, table: str, *, broken: bool = False, arrival: bool = False) -> DataFrame:
        """Staged rows; with ``arrival`` the columns that order rows of one key are kept."""
        extra = ARRIVAL if arrival else []
        return self._origin(table).selectExpr(*select_list(columns(table, broken=broken)), *extra)

    def delivery(self, table: str, number: int, *, broken: bool = False) -> DataFrame:
        """First or second delivery of a master-data table."""
        rows = self._origin(table)
        if number == 1:
            rows = rows.where(f"NOT ({MISSING_FIRST[table]})")
        exprs = {"batch_id": f"cast({number} AS bigint)", **columns(table, second=number == 2, broken=broken)}
        return rows.selectExpr(*select_list(exprs))

    def log(self) -> DataFrame:
        # the end lies `value` seconds after the start
        start = "cast(ts AS timestamp) AS prozessstart"
        end = "CASE event_type WHEN 'view' THEN NULL ELSE cast(ts AS timestamp) + make_dt_interval(0, 0, 0, " \
              "cast(value AS decimal(18,6))) END AS prozessende"
        return self.raw("events").selectExpr(*select_list(LOG), start, end)
