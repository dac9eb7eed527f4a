"""The hand-derived sample batch through all three layers, and what a second run may change."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import DAY, Clock, sample_source

from depotwerk.operators.merge import DuplicateKeyError, UnresolvedKeyError
from depotwerk.plans.control import Control
from depotwerk.schemas import FACTS, TABLES, VALIDATED


@pytest.fixture(scope="module", autouse=True)
def few_jobs(spark):
    """Adaptive planning runs every shuffle as a job of its own; tiny data does not need it."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Warehouse after two runs of the same day; the state between them is kept as rows."""
    control = Control(spark, str(tmp_path_factory.mktemp("dwh")), sample_source(spark, DAY),
                      clock=Clock(datetime(2024, 1, 15, 6, 0, 0)))
    control.install(date(2024, 1, 1), date(2024, 1, 31))
    first = control.run_daily_etl(DAY)
    tables = [t for t in TABLES if not t.startswith(("STG_LADELOG", "ETL_"))]
    after = {t: control.store.read(t).collect() for t in tables}
    after["log"] = control.process_log().collect()
    after["load"] = control.load_log().orderBy("log_id").collect()
    after["status"] = control.last_batch_status().first()
    after["quality"] = control.check_data_quality(first, with_fx=True).collect()
    second = control.run_daily_etl(DAY)
    return control, first, second, after


def by(rows, key):
    return {r[key]: r for r in rows}


def test_validated_layer(loaded):
    _, first, _, t = loaded
    assert first == 1
    for name in VALIDATED:
        assert {(r.ist_gueltig, r.validierungsfehler) for r in t[name]} == {("J", None)}, name
    held = by(t["VOR_BESTAND"], "isin")
    assert held["DE0005140008"].marktwert_eur == Decimal("102300.00")
    assert held["DE0005140008"].portfoliogewicht == Decimal("60.450275")
    assert held["US5949181045"].marktwert_fondswaehrung == Decimal("66930.00")
    assert held["US5949181045"].portfoliogewicht == Decimal("39.549725")
    prices = by(t["VOR_KURS"], "isin")
    assert prices["DE0005140008"].wechselkurs_eur == 1
    assert prices["US5949181045"].kurs_in_eur == Decimal("133.816350")
    trade, flow = t["VOR_TRANSAKTION"][0], t["VOR_FONDSBEWEGUNG"][0]
    assert (trade.transaktionstyp_normiert, trade.gesamtbetrag, trade.gesamtbetrag_eur) == (
        "KAUF", Decimal("10255.00"), Decimal("10255.00"))
    assert (flow.bewegungstyp_normiert, flow.nettobetrag_eur, flow.ausgabeaufschlag) == (
        "ZUFLUSS", Decimal("10525.00"), Decimal("0.03"))
    assert {r.src_kurs_id for r in t["STG_KV_WECHSELKURS"]} >= {"WK-EURUSD20240115", "WK-USDEUR20240115"}


def test_dimensions(loaded):
    _, _, _, t = loaded
    paper = by(t["DIM_WERTPAPIER"], "isin")
    assert len(t["DIM_WERTPAPIER"]) == 2
    a, b = paper["DE0005140008"], paper["US5949181045"]
    assert (a.land_id, a.branche_id, a.waehrung_id) == (1, 7, 1)
    assert (b.land_id, b.branche_id, b.waehrung_id) == (4, 8, 2)
    for r in (a, b, *t["DIM_FONDS"], *t["DIM_DEPOT"]):
        assert (r.dwh_version, r.ist_aktuell, r.gueltig_bis, r.gueltig_von) == (
            1, "J", date(9999, 12, 31), DAY)
    fund = t["DIM_FONDS"][0]
    assert (len(t["DIM_FONDS"]), fund.fondswaehrung_id, fund.domizil_land_id) == (1, 1, 1)
    assert [r.depot_nr for r in t["DIM_DEPOT"]] == ["DEPOT001"]
    assert {a.wertpapier_sk, b.wertpapier_sk} == {1, 2}


def test_facts(loaded):
    _, _, _, t = loaded
    held = by(t["FAKT_BESTAND"], "isin")
    assert {r.zeit_id for r in held.values()} == {20240115}
    assert held["DE0005140008"].unrealisierter_gv == Decimal("6800.00")
    assert held["US5949181045"].unrealisierter_gv == Decimal("12750.00")
    assert held["DE0005140008"].einstandswert_eur == Decimal("95500.00")
    assert held["US5949181045"].einstandswert_eur == Decimal("60000.00")
    assert len(t["FAKT_KURS"]) == 2
    assert {(r.waehrung_von_id, r.waehrung_nach_id) for r in t["FAKT_WECHSELKURS"]} == {
        (1, 2), (1, 4), (1, 3), (1, 5), (2, 1)}
    trade = t["FAKT_TRANSAKTION"][0]
    assert (trade.zeit_id_handel, trade.zeit_id_valuta, trade.zeit_id_buchung, trade.vorzeichen) == (
        20240115, 20240117, 20240117, 1)
    flow = t["FAKT_FONDSBEWEGUNG"][0]
    assert flow.vorzeichen == 1 and flow.depot_sk == t["DIM_DEPOT"][0].depot_sk


def test_logs_and_reports(loaded):
    _, _, _, t = loaded
    assert [(r.tabelle, r.anzahl_saetze, r.status) for r in t["load"]] == [
        ("STG_WP_STAMMDATEN", 2, "ERFOLGREICH"), ("STG_WP_FONDS_STAMMDATEN", 1, "ERFOLGREICH"),
        ("STG_KV_KURS", 2, "ERFOLGREICH"), ("STG_KV_WECHSELKURS", 5, "ERFOLGREICH"),
        ("STG_FB_BESTAND", 2, "ERFOLGREICH"), ("STG_FB_TRANSAKTION", 1, "ERFOLGREICH"),
        ("STG_FB_FONDSBEWEGUNG", 1, "ERFOLGREICH")]
    assert {(r.phase, r.status) for r in t["log"]} == {
        (p, "ERFOLGREICH") for p in ("GESAMT", "STAGING", "TRANSFORMATION", "ZIELBELADUNG")}
    assert len(t["log"]) == 4 and all(r.prozessende > r.prozessstart for r in t["log"])
    s = t["status"]
    assert (s.batch_id, s.lade_datum, s.status_staging, s.status_transform, s.status_zielladen,
            s.status_gesamt, s.fehler_detail) == (1, DAY, *["ERFOLGREICH"] * 4, None)
    assert len(t["quality"]) == 7
    assert {(r.ungueltig, r.ohne_eur_kurs, r.ergebnis) for r in t["quality"]} == {(0, 0, "OK")}


def test_second_run_changes_nothing_but_batches(loaded):
    control, first, second, before = loaded
    assert second == 2
    for name in ("DIM_WERTPAPIER", "DIM_FONDS", "DIM_DEPOT"):
        assert sorted(control.store.read(name).collect()) == sorted(before[name]), name
    for name in FACTS:
        now = control.store.read(name).collect()
        assert len(now) == len(before[name]), name
        expected = {1} if name in ("FAKT_TRANSAKTION", "FAKT_FONDSBEWEGUNG") else {2}
        assert {r.batch_id for r in now} == expected, name
        ids = TABLES[name].id_column
        assert sorted(r[ids] for r in now) == sorted(r[ids] for r in before[name]), name


def test_new_version_does_not_duplicate_facts(spark, loaded):
    """A renamed security gets a new version; holdings and trades keep one row each."""
    control = loaded[0]

    def rename(rows):
        rows["STG_WP_STAMMDATEN"][0]["bezeichnung_lang"] = "Umbenannt AG"
        rows["STG_WP_FONDS_STAMMDATEN"][0]["wkn"] = "ZZZZZZ"  # not tracked

    control.source = sample_source(spark, DAY, rename)
    control.clock.now = datetime(2024, 1, 16, 6, 0, 0)
    control.run_daily_etl(DAY)
    versions = sorted(
        (r.isin, r.dwh_version, r.ist_aktuell, r.gueltig_von, r.gueltig_bis)
        for r in control.store.read("DIM_WERTPAPIER").collect())
    assert versions == [
        ("DE0005140008", 1, "N", DAY, DAY),
        ("DE0005140008", 2, "J", date(2024, 1, 16), date(9999, 12, 31)),
        ("US5949181045", 1, "J", DAY, date(9999, 12, 31))]
    assert control.store.read("DIM_FONDS").count() == 1
    current = {r.isin: r.wertpapier_sk
               for r in control.store.read("DIM_WERTPAPIER").where("ist_aktuell='J'").collect()}
    held = control.store.read("FAKT_BESTAND").collect()
    assert {(r.isin, r.wertpapier_sk) for r in held} == set(current.items())
    assert control.store.read("FAKT_TRANSAKTION").count() == 1
    assert control.store.read("FAKT_FONDSBEWEGUNG").count() == 1


def test_retention(loaded):
    control = loaded[0]
    control.clock.now = datetime(2024, 6, 1, 6, 0, 0)
    batch = control.run_staging_only(DAY)
    dropped = control.purge()
    assert dropped["STG_FB_BESTAND"] == 6 and dropped["VOR_KURS"] == 6 and dropped["STG_LADELOG"] == 21
    assert {r.batch_id for r in control.store.read("STG_FB_BESTAND").collect()} == {batch}
    assert control.store.read("VOR_BESTAND").count() == 0
    assert control.store.read("FAKT_BESTAND").count() == 2
    assert control.process_log().count() == 13
    assert control.load_log().count() == 7
    assert control.new_batch_id() == batch + 1


def test_phases_one_by_one(spark, tmp_path, clock):
    control = Control(spark, str(tmp_path), sample_source(spark, DAY), clock=clock)
    control.install(date(2024, 1, 1), date(2024, 1, 31))
    batch = control.run_staging_only(DAY)
    assert control.store.read("STG_FB_BESTAND", batch_id=batch).count() == 2
    control.run_transform_only(batch)
    control.run_transform_only(batch)  # idempotent
    assert control.store.read("VOR_BESTAND").count() == 2
    control.run_zielbeladung_only(batch)
    control.run_zielbeladung_only(batch)
    assert control.store.read("FAKT_BESTAND").count() == 2
    assert {r.lade_datum for r in control.process_log().collect()} == {DAY}
    ids = [r.bestand_id for r in control.store.read("FAKT_BESTAND").collect()]
    assert len(set(ids)) == 2


def test_failure_publishes_nothing_and_skips_later_phases(spark, tmp_path, clock):
    class Broken:
        def __init__(self, inner):
            self.inner = inner

        def read(self, table):
            if table == "STG_FB_FONDSBEWEGUNG":
                raise RuntimeError("Quelle nicht erreichbar")
            return self.inner.read(table)

    control = Control(spark, str(tmp_path), Broken(sample_source(spark, DAY)), clock=clock)
    control.install(date(2024, 1, 1), date(2024, 1, 31))
    with pytest.raises(RuntimeError):
        control.run_daily_etl(DAY)
    assert control.store.read("STG_FB_BESTAND").count() == 0
    assert control.store.read("STG_KV_KURS").count() == 2
    load = {r.tabelle: r.status for r in control.load_log().collect()}
    assert load["STG_KV_KURS"] == "ERFOLGREICH"
    assert load["STG_FB_BESTAND"] == load["STG_FB_FONDSBEWEGUNG"] == "FEHLER"
    s = control.last_batch_status().first()
    assert (s.status_staging, s.status_transform, s.status_gesamt) == ("FEHLER", None, "FEHLER")
    assert "nicht erreichbar" in s.fehler_detail


def test_policies(spark, tmp_path, clock):
    def second_exchange(rows):
        extra = dict(rows["STG_KV_KURS"][0], boerse="TRADEGATE", kurs=Decimal("102.40"))
        rows["STG_KV_KURS"].append(extra)
        rows["STG_FB_TRANSAKTION"][0]["isin"] = "FR0000000001"  # no such security

    control = Control(spark, str(tmp_path), sample_source(spark, DAY, second_exchange), clock=clock)
    control.install(date(2024, 1, 1), date(2024, 1, 31))
    with pytest.raises(DuplicateKeyError):
        control.run_daily_etl(DAY)
    assert control.last_batch_status().first().status_transform == "FEHLER"

    control.on_duplicate = "latest"
    control.run_transform_only(1)
    with pytest.raises(UnresolvedKeyError):
        control.run_zielbeladung_only(1)

    control.on_unresolved = "reject"
    control.run_zielbeladung_only(1)
    prices = {r.isin: r.boerse for r in control.store.read("FAKT_KURS").collect()}
    assert prices["DE0005140008"] == "TRADEGATE"
    rejected = spark.read.parquet(control.store.path("FAKT_TRANSAKTION_ABGELEHNT")).collect()
    assert [(r.isin, r.fehlende_schluessel) for r in rejected] == [("FR0000000001", "wertpapier_sk")]
    assert control.store.read("FAKT_TRANSAKTION").count() == 0
    assert control.store.read("FAKT_FONDSBEWEGUNG").count() == 1
