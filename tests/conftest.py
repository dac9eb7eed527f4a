import os
import sys
from datetime import date, datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from depotwerk.session import build_session  # noqa: E402
from depotwerk.sources.readers import FrameSource, literal_rows  # noqa: E402

DAY = date(2024, 1, 15)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4",
                            spark__driver__memory="4g", spark__ui__showConsoleProgress="false", spark__driver__host="localhost")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Clock:
    """A clock the test sets and that moves one second per reading."""

    def __init__(self, start: datetime):
        self.now = start

    def __call__(self) -> datetime:
        self.now = self.now.replace(microsecond=0)
        seconds = self.now.second + self.now.minute * 60 + self.now.hour * 3600
        self.now = datetime.combine(self.now.date(), datetime.min.time()).replace(
            hour=(seconds + 1) // 3600 % 24, minute=(seconds + 1) // 60 % 60, second=(seconds + 1) % 60)
        return self.now


@pytest.fixture
def clock():
    return Clock(datetime(2024, 1, 15, 6, 0, 0))


def D(text):
    from decimal import Decimal

    return None if text is None else Decimal(text)


def sample_rows(day: date) -> dict[str, list[dict]]:
    """The sample delivery of FIXTURES.md section 2."""
    from datetime import timedelta

    later, stamp = day + timedelta(days=2), day.strftime("%Y%m%d")
    return {
        "STG_FB_BESTAND": [
            dict(fonds_id="FONDS001", isin="DE0005140008", bewertungsdatum=day, stueckzahl=D("1000"),
                 einstandskurs=D("95.50"), einstandswert=D("95500.00"), aktueller_kurs=D("102.30"),
                 marktwert=D("102300.00"), waehrung_fonds="EUR", waehrung_papier="EUR", wechselkurs=D("1.0"),
                 depot_nr="DEPOT001", depotstelle="Musterbank AG"),
            dict(fonds_id="FONDS001", isin="US5949181045", bewertungsdatum=day, stueckzahl=D("500"),
                 einstandskurs=D("120.00"), einstandswert=D("60000.00"), aktueller_kurs=D("145.50"),
                 marktwert=D("72750.00"), waehrung_fonds="EUR", waehrung_papier="USD", wechselkurs=D("0.92"),
                 depot_nr="DEPOT001", depotstelle="Musterbank AG"),
        ],
        "STG_FB_TRANSAKTION": [
            dict(transaktions_id=f"TXN-{stamp}-001", fonds_id="FONDS001", isin="DE0005140008",
                 transaktionstyp="KAUF", handelsdatum=day, valutatdatum=later, buchungsdatum=later,
                 stueckzahl=D("100"), kurs=D("102.30"), kursdatum=day, transaktionswert=D("10230.00"),
                 provision=D("25.00"), stueckzinsen=D("0"), gesamtbetrag=D("10255.00"), waehrung="EUR",
                 waehrung_fonds="EUR", wechselkurs=D("1.0"), kontrahent="Musterkontrahent GmbH",
                 depot_nr="DEPOT001"),
        ],
        "STG_FB_FONDSBEWEGUNG": [
            dict(bewegungs_id=f"FBW-{stamp}-001", fonds_id="FONDS001", bewegungstyp="AUSGABE", handelsdatum=day,
                 valutatdatum=later, buchungsdatum=later, anteile=D("50"), anteilswert_nav=D("210.50"),
                 ausgabeaufschlag=D("0.03"), bruttobetrag=D("10857.75"), nettobetrag=D("10525.00"),
                 depot_nr="DEPOT001", depotstelle="Musterbank AG", anleger_id="ANLEGER001", waehrung="EUR"),
        ],
        "STG_KV_KURS": [
            dict(kurs_id=f"KURS-{stamp}-001", isin="DE0005140008", kursdatum=day, kurszeit="17:30:00",
                 kurstyp="SCHLUSS", kurs=D("102.30"), waehrung="EUR", handelsvolumen=D("5000000"),
                 umsatz_stueck=D("48900"), boerse="XETRA", boerse_kuerzel="ETR", kurs_quelle="REUTERS",
                 kurs_qualitaet="EOD"),
            dict(kurs_id=f"KURS-{stamp}-002", isin="US5949181045", kursdatum=day, kurszeit="21:00:00",
                 kurstyp="SCHLUSS", kurs=D("145.50"), waehrung="USD", handelsvolumen=D("25000000"),
                 umsatz_stueck=D("171800"), boerse="NASDAQ", boerse_kuerzel="NAS", kurs_quelle="BLOOMBERG",
                 kurs_qualitaet="EOD"),
        ],
        "STG_KV_WECHSELKURS": [
            dict(waehrung_von=a, waehrung_nach=b, kursdatum=day, kurstyp="EZB", kurs=D(k))
            for a, b, k in [("EUR", "USD", "1.0873"), ("EUR", "GBP", "0.8612"), ("EUR", "CHF", "0.9523"),
                            ("EUR", "JPY", "163.45"), ("USD", "EUR", "0.9197")]
        ],
        "STG_WP_STAMMDATEN": [
            dict(isin="DE0005140008", wkn="514000", ticker="DBK", bezeichnung_lang="Deutsche Bank AG",
                 bezeichnung_kurz="Deutsche Bank", wertpapiertyp="AKTIE", asset_klasse="AKTIEN",
                 sub_asset_klasse="GROSSBANKEN", emittent_name="Deutsche Bank AG", land_emittent="DEU",
                 branche="Finanzwesen", branche_code="40", handelswaehrung="EUR", notizwaehrung="EUR",
                 hauptboerse="XETRA", boerse_kuerzel="ETR", status="AKTIV"),
            dict(isin="US5949181045", ticker="MSFT", bezeichnung_lang="Microsoft Corporation",
                 bezeichnung_kurz="Microsoft", wertpapiertyp="AKTIE", asset_klasse="AKTIEN",
                 sub_asset_klasse="SOFTWARE", emittent_name="Microsoft Corporation", land_emittent="USA",
                 branche="Informationstechnologie", branche_code="45", handelswaehrung="USD",
                 notizwaehrung="USD", hauptboerse="NASDAQ", boerse_kuerzel="NAS", status="AKTIV"),
        ],
        "STG_WP_FONDS_STAMMDATEN": [
            dict(fonds_id="FONDS001", isin="DE000A0M23M0", wkn="A0M23M", fondsname="Musterfonds Aktien Global",
                 fondsname_kurz="Musterfonds AG Global", fondstyp="PUBLIKUMSFONDS",
                 investmentstrategie="Globale Aktien, Diversifiziert", asset_klasse="AKTIEN",
                 fondswaehrung="EUR", auflagedatum=date(2010, 1, 15), kag_name="Muster KAG GmbH",
                 verwahrstelle="Muster Verwahrstelle AG", domizil_land="DEU",
                 rechtliche_struktur="SONDERVERMÖGEN", ucits_konform="J", status="AKTIV"),
        ],
    }


def sample_source(spark, day: date, change=None) -> FrameSource:
    rows = sample_rows(day)
    if change:
        change(rows)
    return FrameSource({t: literal_rows(spark, t, r) for t, r in rows.items()})
