"""Code mapping: trade and fund-flow types to their normalised form and sign."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import canonical

# Source spellings per normalised trade type.
TRADE_TYPES = {
    "KAUF": ["KAUF", "KAUFAUFTRAG", "BUY", "PURCHASE"],
    "VERKAUF": ["VERKAUF", "VERKAUFSAUFTRAG", "SELL", "SALE"],
    "TAUSCH": ["TAUSCH", "SWAP"],
}
TRADE_DEFAULT = "SONSTIGE"

# Source spellings per normalised fund-flow type.
FLOW_TYPES = {
    "ZUFLUSS": ["AUSGABE", "ZEICHNUNG", "SUBSCRIPTION"],
    "ABFLUSS": ["RUECKNAHME", "REDEMPTION", "RUECKGABE"],
    "NEUTRAL": ["AUSSCHUETTUNG", "THESAURIERUNG", "DIVIDENDE"],
}
FLOW_DEFAULT = "NEUTRAL"


def mapped(c: Column | str, groups: dict[str, list[str]], default: str) -> Column:
    """Canonical code -> name of the group that lists it, else ``default``."""
    code = canonical(c)
    hits = [F.when(code.isin(spellings), F.lit(name)) for name, spellings in groups.items()]
    return F.coalesce(*hits, F.lit(default))


def trade_type(c: Column | str) -> Column:
    return mapped(c, TRADE_TYPES, TRADE_DEFAULT)


def flow_type(c: Column | str) -> Column:
    return mapped(c, FLOW_TYPES, FLOW_DEFAULT)


def _sign(c: Column, plus: str, minus: str) -> Column:
    return F.when(c == plus, 1).when(c == minus, -1).otherwise(0)


def trade_sign(normalised: Column | str) -> Column:
    """+1 for a purchase, -1 for a sale, else 0."""
    c = F.col(normalised) if isinstance(normalised, str) else normalised
    return _sign(c, "KAUF", "VERKAUF")


def flow_sign(normalised: Column | str) -> Column:
    """+1 for an inflow, -1 for an outflow, else 0."""
    c = F.col(normalised) if isinstance(normalised, str) else normalised
    return _sign(c, "ZUFLUSS", "ABFLUSS")
