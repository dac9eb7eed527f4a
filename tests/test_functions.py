"""Every message branch and every code mapping, against values written by hand."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from depotwerk.functions import (
    canonical, clean, concat_text, cut, de_date, de_timestamp, empty_to_null, flow_sign, flow_type,
    isin_error, rules, run_time, trade_sign, trade_type, with_verdict, zeit_id,
)
from depotwerk.functions import sql as sql_functions
from depotwerk.plans.transforms import flow_amounts, trade_amounts


def values(spark, rows, ddl, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*cols).collect()]


ISINS = {
    None: "ISIN fehlt",
    "DE000514000": "ISIN muss 12 Zeichen lang sein (aktuell: 11)",
    "DE0005140008X": "ISIN muss 12 Zeichen lang sein (aktuell: 13)",
    "DE0005140008\n": "ISIN muss 12 Zeichen lang sein (aktuell: 13)",
    "DE000514000\n": "ISIN hat ungueltiges Format (erwartet: 2 Grossbuchstaben + 9 alphanum + 1 Ziffer)",
    "de0005140008": "ISIN hat ungueltiges Format (erwartet: 2 Grossbuchstaben + 9 alphanum + 1 Ziffer)",
    "DE000514000A": "ISIN hat ungueltiges Format (erwartet: 2 Grossbuchstaben + 9 alphanum + 1 Ziffer)",
    "DE0005140008": None,
    "US5949181045": None,
    "DE0005140009": None,  # wrong check digit is not tested
}


def test_isin(spark):
    got = values(spark, [(k,) for k in ISINS], "isin string", "isin", isin_error("isin"))
    assert dict(got) == ISINS


def test_text(spark):
    rows = [("  a b ",), ("   ",), ("",), (None,), ("straße",)]
    assert values(spark, rows, "x string", clean("x"), canonical("x")) == [
        ("a b", "A B"), (None, None), (None, None), (None, None), ("straße", "STRASSE")]
    assert values(spark, [("a", None, 3)], "a string, b string, c int", concat_text("a", "b", "c"), cut("a", 5)) == [("a3", "a")]
    df = empty_to_null(spark.createDataFrame([("", 1), (" ", 2)], "x string, n int"))
    assert [tuple(r) for r in df.collect()] == [(None, 1), (" ", 2)]


@pytest.mark.parametrize("raw, normalised, sign", [
    ("KAUF", "KAUF", 1), (" kaufauftrag ", "KAUF", 1), ("Buy", "KAUF", 1), ("PURCHASE", "KAUF", 1),
    ("VERKAUF", "VERKAUF", -1), ("verkaufsauftrag", "VERKAUF", -1), ("SELL", "VERKAUF", -1), ("sale", "VERKAUF", -1),
    ("TAUSCH", "TAUSCH", 0), ("swap", "TAUSCH", 0), ("xyz", "SONSTIGE", 0), (None, "SONSTIGE", 0)])
def test_trade_type(spark, raw, normalised, sign):
    got = values(spark, [(raw,)], "t string", trade_type("t").alias("n"), trade_sign(trade_type("t")))
    assert got == [(normalised, sign)]


@pytest.mark.parametrize("raw, normalised, sign", [
    ("AUSGABE", "ZUFLUSS", 1), (" zeichnung", "ZUFLUSS", 1), ("Subscription", "ZUFLUSS", 1),
    ("RUECKNAHME", "ABFLUSS", -1), ("redemption", "ABFLUSS", -1), ("Rueckgabe", "ABFLUSS", -1),
    ("AUSSCHUETTUNG", "NEUTRAL", 0), ("THESAURIERUNG", "NEUTRAL", 0), ("DIVIDENDE", "NEUTRAL", 0),
    ("xyz", "NEUTRAL", 0), (None, "NEUTRAL", 0)])
def test_flow_type(spark, raw, normalised, sign):
    got = values(spark, [(raw,)], "t string", flow_type("t").alias("n"), flow_sign(flow_type("t")))
    assert got == [(normalised, sign)]


def test_dates(spark):
    rows = [(date(2024, 3, 5), datetime(2024, 3, 5, 6, 7, 8), datetime(2024, 3, 5, 6, 8, 38, 500000)), (None, None, None)]
    got = values(spark, rows, "d date, a timestamp, b timestamp", zeit_id("d"), de_date("d"), de_timestamp("a"),
                 run_time("a", "b", 60), run_time("a", "b", 1))
    assert got == [(20240305, "05.03.2024", "05.03.2024 06:07:08", Decimal("1.51"), Decimal("90.50")),
                   (None,) * 5]


GOOD = "DE0005140008"
CASES = [
    (rules.security_rules, "isin string, bezeichnung_lang string, wertpapiertyp string", [
        (("x", None, None), "ISIN ungueltig: ISIN muss 12 Zeichen lang sein (aktuell: 1)"),
        ((GOOD, None, None), "Bezeichnung fehlt"), ((GOOD, "a", None), "Wertpapiertyp fehlt"), ((GOOD, " ", "x"), None)]),
    (rules.fund_rules, "fonds_id string, fondsname string, fondstyp string, fondswaehrung string", [
        ((None,) * 4, "Fonds-ID fehlt"), (("f", None, None, None), "Fondsname fehlt"),
        (("f", "n", None, None), "Fondstyp fehlt"), (("f", "n", "t", None), "Fondswaehrung fehlt"),
        (("f", "n", "t", "EUR"), None)]),
    (rules.fx_rules, "kurs decimal(20,8), waehrung_von string, waehrung_nach string", [
        ((None, None, None), "Kurs muss groesser als 0 sein"), ((Decimal(0), "a", "b"), "Kurs muss groesser als 0 sein"),
        ((Decimal(1), None, None), "Quellwaehrung fehlt"), ((Decimal(1), "a", None), "Zielwaehrung fehlt"),
        ((Decimal(1), "a", "b"), None)]),
    (rules.price_rules, "isin string, kurs decimal(20,6), waehrung string", [
        ((None, None, None), "Ungueltige ISIN: ISIN fehlt"), ((GOOD, None, None), "Kurs ungueltig (NULL oder negativ)"),
        ((GOOD, Decimal(-1), "a"), "Kurs ungueltig (NULL oder negativ)"), ((GOOD, Decimal(0), None), "Waehrung fehlt"),
        ((GOOD, Decimal(0), "EUR"), None)]),
    (rules.holding_rules, "fonds_id string, isin string, bewertungsdatum date, marktwert decimal(20,2)", [
        ((None,) * 4, "Fonds-ID fehlt"), (("f", None, None, None), "Ungueltige ISIN: ISIN fehlt"),
        (("f", GOOD, None, None), "Bewertungsdatum fehlt"), (("f", GOOD, date(2024, 1, 1), None), "Marktwert fehlt"),
        (("f", GOOD, date(2024, 1, 1), Decimal(1)), None)]),
    (rules.trade_rules, "transaktions_id string, fonds_id string, isin string, handelsdatum date, transaktionstyp string", [
        ((None,) * 5, "Transaktions-ID fehlt"), (("t", None, None, None, None), "Fonds-ID fehlt"),
        (("t", "f", None, None, None), "Ungueltige ISIN: ISIN fehlt"), (("t", "f", GOOD, None, None), "Handelsdatum fehlt"),
        (("t", "f", GOOD, date(2024, 1, 1), None), "Transaktionstyp fehlt"),
        (("t", "f", GOOD, date(2024, 1, 1), "x"), None)]),
    (rules.flow_rules, "bewegungs_id string, fonds_id string, handelsdatum date, anteile decimal(20,6)", [
        ((None,) * 4, "Bewegungs-ID fehlt"), (("b", None, None, None), "Fonds-ID fehlt"),
        (("b", "f", None, None), "Handelsdatum fehlt"), (("b", "f", date(2024, 1, 1), None), "Anteile fehlen"),
        (("b", "f", date(2024, 1, 1), Decimal(1)), None)]),
]


@pytest.mark.parametrize("make, ddl, cases", CASES, ids=[c[0].__name__ for c in CASES])
def test_rules(spark, make, ddl, cases):
    df = with_verdict(spark.createDataFrame([row for row, _ in cases], ddl), make())
    got = [(r.validierungsfehler, r.ist_gueltig) for r in df.collect()]
    assert got == [(message, "J" if message is None else "N") for _, message in cases]


def test_amount_defaults(spark):
    ddl = ("buchungsdatum date, valutatdatum date, transaktionswert decimal(20,2), provision decimal(20,2), "
           "stueckzinsen decimal(20,2), gesamtbetrag decimal(20,2)")
    d = Decimal
    rows = [(None, date(2024, 1, 2), d("100"), d("2"), d("3"), None), (date(2024, 1, 1), None, None, None, None, None),
            (None, None, d("1"), d("1"), d("1"), d("9"))]
    got = values(spark, rows, ddl, *[c.alias(n) for n, c in trade_amounts().items()])
    assert got == [
        (date(2024, 1, 2), d(2), d(3), d(105), d(102)),  # EUR basis leaves out accrued interest
        (date(2024, 1, 1), d(0), d(0), d(0), d(0)), (None, d(1), d(1), d(9), d(9))]
    ddl = ("buchungsdatum date, valutatdatum date, nettobetrag decimal(20,2), bruttobetrag decimal(20,2), "
           "ausgabeaufschlag decimal(10,4)")
    got = values(spark, [(None, date(2024, 1, 2), None, d("7"), None)], ddl, *flow_amounts().values())
    assert got == [(date(2024, 1, 2), d(7), d(0))]


def test_rounding_half_up_on_assignment(spark):
    rows = [(Decimal("0.025"),), (Decimal("-0.025"),)]
    assert values(spark, rows, "x decimal(10,4)", F.col("x").cast("decimal(20,2)")) == [
        (Decimal("0.03"),), (Decimal("-0.03"),)]


def test_sql_functions(spark):
    sql_functions.register(spark)
    for isin, message in ISINS.items():
        assert spark.sql("SELECT isin_error(:x) AS e", args={"x": isin}).first().e == message
    row = spark.sql("SELECT trade_type(' Sell') AS a, flow_type('Redemption') AS b, trade_type(NULL) AS c").first()
    assert tuple(row) == ("VERKAUF", "ABFLUSS", "SONSTIGE")
