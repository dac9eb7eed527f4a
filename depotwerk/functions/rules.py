"""Row validation.

A rule is a column that is NULL when the row passes and holds the error text
when it does not.  The first failing rule wins; all rules look at raw values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _col

# Shape of a security number and the error texts.
# \z, not $: in Java "$" also matches before a trailing newline.
ISIN_LENGTH = 12
ISIN_PATTERN = r"^[A-Z]{2}[A-Z0-9]{9}[0-9]\z"
ISIN_MISSING = "ISIN fehlt"
ISIN_BAD_LENGTH = "ISIN muss 12 Zeichen lang sein (aktuell: "
ISIN_BAD_FORMAT = (
    "ISIN hat ungueltiges Format (erwartet: 2 Grossbuchstaben + 9 alphanum + 1 Ziffer)"
)


def check(failed: Column, message: str) -> Column:
    return F.when(failed, F.lit(message))


def missing(c: Column | str, message: str) -> Column:
    return check(_col(c).isNull(), message)


def isin_error(c: Column | str) -> Column:
    """Error text of a security number, NULL when it is well formed."""
    c = _col(c)
    return (
        F.when(c.isNull(), F.lit(ISIN_MISSING))
        .when(
            F.length(c) != ISIN_LENGTH,
            F.concat(F.lit(ISIN_BAD_LENGTH), F.length(c).cast("string"), F.lit(")")),
        )
        .when(~c.rlike(ISIN_PATTERN), F.lit(ISIN_BAD_FORMAT))
    )


def prefixed(prefix: str, error: Column) -> Column:
    """Prefix an error text; stays NULL when there is none."""
    return F.concat(F.lit(prefix), error)


def first_error(*rules: Column) -> Column:
    return F.coalesce(*rules)


# The rule lists per table.  Texts are part of the contract.

def security_rules() -> list[Column]:
    return [
        prefixed("ISIN ungueltig: ", isin_error("isin")),
        missing("bezeichnung_lang", "Bezeichnung fehlt"),
        missing("wertpapiertyp", "Wertpapiertyp fehlt"),
    ]


def fund_rules() -> list[Column]:
    return [
        missing("fonds_id", "Fonds-ID fehlt"),
        missing("fondsname", "Fondsname fehlt"),
        missing("fondstyp", "Fondstyp fehlt"),
        missing("fondswaehrung", "Fondswaehrung fehlt"),
    ]


def fx_rules() -> list[Column]:
    kurs = F.col("kurs")
    return [
        check(kurs.isNull() | (kurs <= 0), "Kurs muss groesser als 0 sein"),
        missing("waehrung_von", "Quellwaehrung fehlt"),
        missing("waehrung_nach", "Zielwaehrung fehlt"),
    ]


def price_rules() -> list[Column]:
    kurs = F.col("kurs")
    return [
        prefixed("Ungueltige ISIN: ", isin_error("isin")),
        check(kurs.isNull() | (kurs < 0), "Kurs ungueltig (NULL oder negativ)"),
        missing("waehrung", "Waehrung fehlt"),
    ]


def holding_rules() -> list[Column]:
    return [
        missing("fonds_id", "Fonds-ID fehlt"),
        prefixed("Ungueltige ISIN: ", isin_error("isin")),
        missing("bewertungsdatum", "Bewertungsdatum fehlt"),
        missing("marktwert", "Marktwert fehlt"),
    ]


def trade_rules() -> list[Column]:
    return [
        missing("transaktions_id", "Transaktions-ID fehlt"),
        missing("fonds_id", "Fonds-ID fehlt"),
        prefixed("Ungueltige ISIN: ", isin_error("isin")),
        missing("handelsdatum", "Handelsdatum fehlt"),
        missing("transaktionstyp", "Transaktionstyp fehlt"),
    ]


def flow_rules() -> list[Column]:
    return [
        missing("bewegungs_id", "Bewegungs-ID fehlt"),
        missing("fonds_id", "Fonds-ID fehlt"),
        missing("handelsdatum", "Handelsdatum fehlt"),
        missing("anteile", "Anteile fehlen"),
    ]


def with_verdict(df: DataFrame, rules: list[Column]) -> DataFrame:
    """Add ``validierungsfehler`` and the J/N flag ``ist_gueltig``; no row is dropped."""
    return df.withColumn("validierungsfehler", first_error(*rules)).withColumn(
        "ist_gueltig", F.when(F.col("validierungsfehler").isNull(), "J").otherwise("N")
    )
