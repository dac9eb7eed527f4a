"""Files, literal rows, database options and deltas."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import DAY, sample_rows
from pyspark.sql import functions as F

from depotwerk.operators.numbering import ARRIVAL
from depotwerk.schemas import TABLES
from depotwerk.sources import readers, seeds, staging


def test_csv_and_parquet_deliveries(spark, tmp_path):
    rows = readers.literal_rows(spark, "STG_KV_WECHSELKURS", sample_rows(DAY)["STG_KV_WECHSELKURS"])
    rows.write.option("header", True).csv(str(tmp_path / "csv"))
    rows.write.parquet(str(tmp_path / "pq"))
    want = sorted(map(tuple, rows.collect()))
    for kind, name in (("csv", "csv"), ("parquet", "pq")):
        source = readers.FileSource(spark, {"STG_KV_WECHSELKURS": str(tmp_path / name)}, format=kind)
        got = source.read("STG_KV_WECHSELKURS")
        assert set(ARRIVAL) <= set(got.columns)
        assert sorted(map(tuple, got.select(*rows.columns).collect())) == want


def test_broken_csv_fails(spark, tmp_path):
    path = tmp_path / "broken.csv"
    path.write_text("waehrung_von,waehrung_nach,kursdatum,kurstyp,kurs\nUSD,EUR,kein-datum,EZB,1.0\n")
    source = readers.FileSource(spark, {"STG_KV_WECHSELKURS": str(path)})
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|kein-datum"):
        source.read("STG_KV_WECHSELKURS").collect()


def test_jdbc_options(spark):
    source = readers.JdbcSource(spark, "jdbc:oracle:thin:@//host/db", {"STG_FB_BESTAND": "BESTAND_VIEW"},
                                {"user": "dwh"}, {"STG_FB_BESTAND": ("positions_nr", "1", "1000000", 16)})
    assert source.options("STG_FB_BESTAND") == {
        "url": "jdbc:oracle:thin:@//host/db", "dbtable": "BESTAND_VIEW", "fetchsize": "10000", "user": "dwh",
        "partitionColumn": "positions_nr", "lowerBound": "1", "upperBound": "1000000", "numPartitions": "16"}
    with pytest.raises(ValueError, match="split"):
        readers.JdbcSource(spark, "jdbc:x", {"STG_KV_KURS": "KURS_VIEW"}).options("STG_KV_KURS")


def test_staging_keeps_raw_values_and_filters_the_day(spark):
    rows = sample_rows(DAY)["STG_FB_BESTAND"]
    rows[0]["depotstelle"] = ""
    other = dict(rows[1], bewertungsdatum=date(2024, 1, 14))
    delivery = readers.literal_rows(spark, "STG_FB_BESTAND", [*rows, other])
    now = datetime(2024, 1, 15, 8)
    staged = staging.stage_bestand(delivery, DAY, now)
    got = {r.isin: r for r in staged.collect()}
    assert len(got) == 2
    assert got["US5949181045"].marktwert_fondswaehrung == Decimal("66930.00")
    assert got["DE0005140008"].depotstelle is None
    assert got["DE0005140008"].src_geaendert_am == now
    assert set(staged.columns) == set(TABLES["STG_FB_BESTAND"].columns) - {"stg_id", "batch_id", "ladezeit"}


def test_names_as_delivered_and_missing_columns(spark, tmp_path):
    rows = readers.literal_rows(spark, "STG_WP_STAMMDATEN", sample_rows(DAY)["STG_WP_STAMMDATEN"])
    rows = rows.withColumn("faelligkeitsdatum", F.lit(date(2030, 1, 1)))
    named = rows.withColumnsRenamed({"faelligkeitsdatum": "Fälligkeitsdatum", "handelswaehrung": "handelswährung"})
    named.coalesce(1).write.option("header", True).csv(str(tmp_path / "csv"))
    source = readers.FileSource(spark, {"STG_WP_STAMMDATEN": str(tmp_path / "csv")})
    staged = staging.stage_wertpapier(source.read("STG_WP_STAMMDATEN"), DAY, datetime(2024, 1, 15))
    assert {(r.faelligkeitsdatum, r.handelswaehrung) for r in staged.collect()} == {(date(2030, 1, 1), "EUR"), (date(2030, 1, 1), "USD")}
    with pytest.raises(readers.MissingColumnsError, match="handelswaehrung"):
        staging.stage_wertpapier(rows.drop("handelswaehrung"), DAY, datetime(2024, 1, 15))


def test_delta(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], "n int, src_geaendert_am timestamp")
    assert readers.rows_changed_since(df, "src_geaendert_am", None).count() == 2
    assert readers.rows_changed_since(df, "src_geaendert_am", datetime(2024, 1, 1)).count() == 1


def test_seeds(spark):
    now = datetime(2024, 1, 1)
    money = {r.iso_code: r for r in seeds.currencies(spark, now).collect()}
    assert [money[c].waehrung_id for c in ("EUR", "USD", "CHF", "GBP", "JPY", "SEK", "NOK", "DKK")] == list(range(1, 9))
    assert money["JPY"].dezimalstellen == 0 and money["EUR"].ist_euro_waehrung == "J"
    land = {r.iso3_code: r for r in seeds.countries(spark, now).collect()}
    assert land["IRL"].land_id == 8 and land["CHE"].ist_eu_mitglied == "N"
    assert [r.gics_sektor_code for r in seeds.sectors(spark, now).orderBy("branche_id").collect()] == [
        "10", "15", "20", "25", "30", "35", "40", "45", "50", "55", "60"]


def test_layouts():
    assert len(TABLES) == 29  # those of the contract and the step log
    assert len(TABLES["STG_WP_STAMMDATEN"].columns) == 35
    assert len(TABLES["VOR_BESTAND"].columns) == 24
    assert len(TABLES["DIM_WERTPAPIER"].columns) == 31
    assert len(TABLES["FAKT_TRANSAKTION"].columns) == 26
