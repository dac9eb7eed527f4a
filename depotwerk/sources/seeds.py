"""Reference rows: currencies, countries, sectors."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from ..operators.scd2 import OPEN_END
from ..schemas import TABLES

SINCE = date(2000, 1, 1)

# iso_code, iso_code_numerisch, name_de, name_en, symbol, dezimalstellen, ist_euro_waehrung.
CURRENCIES = [
    ("EUR", "978", "Euro", "Euro", "€", 2, "J"),
    ("USD", "840", "US-Dollar", "US Dollar", "$", 2, "N"),
    ("CHF", "756", "Schweizer Franken", "Swiss Franc", "Fr", 2, "N"),
    ("GBP", "826", "Britisches Pfund", "British Pound", "£", 2, "N"),
    ("JPY", "392", "Japanischer Yen", "Japanese Yen", "¥", 0, "N"),
    ("SEK", "752", "Schwedische Krone", "Swedish Krona", "kr", 2, "N"),
    ("NOK", "578", "Norwegische Krone", "Norwegian Krone", "kr", 2, "N"),
    ("DKK", "208", "Dänische Krone", "Danish Krone", "kr", 2, "N"),
]

# iso3_code, iso2_code, name_de, name_en, region, waehrung_iso3, ist_eu_mitglied, ist_eurozone.
COUNTRIES = [
    ("DEU", "DE", "Deutschland", "Germany", "Europa", "EUR", "J", "J"),
    ("AUT", "AT", "Österreich", "Austria", "Europa", "EUR", "J", "J"),
    ("CHE", "CH", "Schweiz", "Switzerland", "Europa", "CHF", "N", "N"),
    ("USA", "US", "Vereinigte Staaten", "United States", "Amerika", "USD", "N", "N"),
    ("GBR", "GB", "Vereinigtes Königreich", "United Kingdom", "Europa", "GBP", "N", "N"),
    ("JPN", "JP", "Japan", "Japan", "Asien", "JPY", "N", "N"),
    ("LUX", "LU", "Luxemburg", "Luxembourg", "Europa", "EUR", "J", "J"),
    ("IRL", "IE", "Irland", "Ireland", "Europa", "EUR", "J", "J"),
]

# gics_sektor_code, name, branche_intern_code.
SECTORS = [
    ("10", "Energie", "ENERGIE"),
    ("15", "Rohstoffe", "ROHSTOFF"),
    ("20", "Industrie", "INDUSTRIE"),
    ("25", "Nicht-Basiskonsumgüter", "KONSUM_ZY"),
    ("30", "Basiskonsumgüter", "KONSUM_ST"),
    ("35", "Gesundheitswesen", "GESUNDH"),
    ("40", "Finanzwesen", "FINANZ"),
    ("45", "Informationstechnologie", "IT"),
    ("50", "Telekommunikation", "TELEKOM"),
    ("55", "Versorger", "VERSORGER"),
    ("60", "Immobilien", "IMMOBILIEN"),
]


def _seed(spark: SparkSession, table: str, names: list[str], rows: list[tuple], run_ts: datetime) -> DataFrame:
    layout = TABLES[table]
    fixed = {"gueltig_von": SINCE, "gueltig_bis": OPEN_END, "ist_aktuell": "J", "dwh_version": 1,
             "erstellt_am": run_ts, "geaendert_am": run_ts}
    filled = []
    for number, row in enumerate(rows, start=1):
        values = {**fixed, **dict(zip(names, row, strict=True)), layout.id_column: number}
        filled.append(tuple(values.get(c) for c in layout.columns))
    return spark.createDataFrame(filled, layout.schema)


def currencies(spark: SparkSession, run_ts: datetime) -> DataFrame:
    names = ["iso_code", "iso_code_numerisch", "name_de", "name_en", "symbol", "dezimalstellen",
             "ist_euro_waehrung"]
    return _seed(spark, "DIM_WAEHRUNG", names, CURRENCIES, run_ts)


def countries(spark: SparkSession, run_ts: datetime) -> DataFrame:
    names = ["iso3_code", "iso2_code", "name_de", "name_en", "region", "waehrung_iso3",
             "ist_eu_mitglied", "ist_eurozone"]
    return _seed(spark, "DIM_LAND", names, COUNTRIES, run_ts)


def sectors(spark: SparkSession, run_ts: datetime) -> DataFrame:
    names = ["gics_sektor_code", "gics_sektor_name", "branche_intern_code", "branche_intern_name"]
    rows = [(code, name, intern, name) for code, name, intern in SECTORS]
    return _seed(spark, "DIM_BRANCHE", names, rows, run_ts)
