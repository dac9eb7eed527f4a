"""What a load reads, and what a crash, a rerun or a late row may change."""

import random
import threading
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from conftest import DAY, sample_source
from pyspark.sql import functions as F

from depotwerk.operators import keyfilter, merge
from depotwerk.operators.joins import hot_keys, split_hot
from depotwerk.operators.scd2 import point_in_time
from depotwerk.plans import monitor
from depotwerk.plans.control import Control
from depotwerk.plans.facts import FACT_LOADS
from depotwerk.schemas import TABLES
from depotwerk.sources import store as store_module
from depotwerk.sources.readers import Delta
from depotwerk.sources.staging import SOURCE_SYSTEMS
from depotwerk.sources.store import Warehouse


class Crash(BaseException):
    """A process that ends: no handler for errors sees it."""


@pytest.fixture(autouse=True)
def few_jobs(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- key filters


def test_key_filters_miss_nothing(spark):
    rng = random.Random(4)
    stored = {(g, f"t{rng.randrange(10**9)}", f"f{rng.randrange(5)}") for g in range(6) for _ in range(400 * g + 3)}
    history = spark.createDataFrame([*stored, (1, None, "f"), (9, None, None)], "g int, k string, f string")
    filters = keyfilter.key_filters(history, ["k", "f"], "g").cache()
    assert {r.g for r in filters.select("g").distinct().collect()} == set(range(6))
    for g in range(6):
        some = [(k, f) for have, k, f in stored if have == g][:20]
        found = keyfilter.groups_with(filters, spark.createDataFrame([*some, (None, "f")], "k string, f string"), ["k", "f"], "g")
        assert g in found
    strangers = spark.createDataFrame([(f"x{i}", "f1") for i in range(3000)], "k string, f string")
    assert keyfilter.groups_with(filters, strangers, ["k", "f"], "g") == []
    assert keyfilter.groups_with(filters, strangers, ["k", "f"], "g", max_rows=10) is None
    assert keyfilter.groups_with(filters.where("false"), strangers, ["k", "f"], "g") == []


def trades(spark, keys):
    data = [(f"t{n}", f"f{n % 3}", 100 * month + 1 + n % 28, 1) for month, n in keys]
    return spark.createDataFrame(data, "transaktions_id string, fonds_id string, zeit_id_handel int, batch_id bigint")


MONTHS = [y * 100 + m for y in (2022, 2023) for m in range(1, 13)]
KEYS = TABLES["FAKT_TRANSAKTION"].unique


def test_a_load_reads_the_months_of_its_keys_only(spark, tmp_path):
    """24 months of trades; a delivery of new trades, of old ones, and of one that moved to another month."""
    store = Warehouse(spark, str(tmp_path))
    history = trades(spark, [(m, 1000 * i + n) for i, m in enumerate(MONTHS) for n in range(200)])
    store.write_months("FAKT_TRANSAKTION", history, "zeit_id_handel", replace=False)
    assert store.months_with_keys("FAKT_TRANSAKTION", history.limit(1), KEYS) == MONTHS  # no filters yet
    assert store.refresh_key_filters("FAKT_TRANSAKTION", KEYS) == MONTHS
    assert store.refresh_key_filters("FAKT_TRANSAKTION", KEYS) == []

    delivery = trades(spark, [(202312, 23500 + n) for n in range(50)] + [(202203, 2000 + n) for n in range(5)] + [(202312, 7003)])
    months = store.months_with_keys("FAKT_TRANSAKTION", delivery, KEYS)
    assert months == [202203, 202208]
    existing = store.read("FAKT_TRANSAKTION", months=months)
    assert existing.count() == 400
    fresh = merge.insert_if_absent(existing, delivery, KEYS)
    assert rows(fresh) == rows(merge.insert_if_absent(store.read("FAKT_TRANSAKTION"), delivery, KEYS)) and fresh.count() == 50
    assert store.read("FAKT_TRANSAKTION", months=store.months_with_keys("FAKT_TRANSAKTION", fresh, KEYS)).count() == 0

    # a load that ends before its filter is built: that month is read until it is
    store.write_months("FAKT_TRANSAKTION", fresh, "zeit_id_handel", replace=False)
    assert store.months_with_keys("FAKT_TRANSAKTION", fresh, KEYS) == [202312]
    assert merge.insert_if_absent(store.read("FAKT_TRANSAKTION", months=[202312]), fresh, KEYS).count() == 0
    assert store.refresh_key_filters("FAKT_TRANSAKTION", KEYS) == [202312]
    assert store.months_with_keys("FAKT_TRANSAKTION", delivery, KEYS) == [202203, 202208, 202312]
    assert store.read("FAKT_TRANSAKTION", months=[None]).count() == 0


# ---------------------------------------------------------------- point in time


@pytest.mark.parametrize("bin_days", [30, 366, 40000])
def test_point_in_time_by_bins(spark, bin_days):
    rng = random.Random(bin_days)
    start = date(2020, 1, 1)
    versions, ask = [], []
    for k in ["hot", *[f"k{i}" for i in range(20)]]:
        day = start + timedelta(days=rng.randrange(100))
        for v in range(rng.randrange(1, 6)):
            end = day + timedelta(days=rng.randrange(-1, 500))
            versions.append((k, day, end, v))
            day = end + timedelta(days=1)
        versions.append((k, day, date(9999, 12, 31), 99))
    for n in range(900):
        k = "hot" if n % 3 == 0 else rng.choice([f"k{i}" for i in range(25)] + [None])
        ask.append((n, k, start + timedelta(days=rng.randrange(-300, 2500)) if rng.random() < 0.97 else None))
    versions += [("hot", None, date(2021, 1, 1), 7), (None, start, date(2021, 1, 1), 8)]
    dim = spark.createDataFrame(versions, "k string, gueltig_von date, gueltig_bis date, v int")
    df = spark.createDataFrame(ask, "n int, k string, d date")
    got = point_in_time(df, dim, key="k", on_date="d", take=["v"], max_rows=0, bin_days=bin_days, rows_per_piece=50)
    text = plan(got)
    assert "SortMergeJoin" in text and "__bin" in text and "NestedLoop" not in text and "Cartesian" not in text
    assert got.columns == ["n", "k", "d", "v"]
    want = Counter()
    for n, k, d in ask:
        met = [v for kk, a, b, v in versions if k is not None and d is not None and a is not None and kk == k and a <= d <= b]
        want += Counter((n, k, d, v) for v in met or [None])
    assert rows(got) == want
    none = df.where("n < 0")
    assert point_in_time(none, dim, key="k", on_date="d", take=["v"], max_rows=0).count() == 0


def test_hot_keys_are_cut_and_others_are_not(spark):
    df = spark.createDataFrame([("hot", i) for i in range(1000)] + [(None, i) for i in range(300)] + [(f"k{i}", i) for i in range(500)], "k string, n int")
    hot = hot_keys(df, ["k"], 100)
    assert rows(hot) == Counter([("hot", 10), (None, 3)])
    table = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, x int")
    left, right, on = split_hot(df, table, ["k"], hot, spread_by=["n"])
    assert left.where("k = 'hot'").select("__teil").distinct().count() == 10
    assert rows(right.groupBy("k").count()) == Counter([("hot", 10), ("k1", 1), ("k2", 1)])
    assert rows(left.join(right, on, "left").select("k", "n", "x")) == rows(df.join(table, "k", "left"))


# ---------------------------------------------------------------- publication


def staged(spark, store, batch):
    for table in ("STG_WP_STAMMDATEN", "STG_WP_FONDS_STAMMDATEN"):
        store.stage_batch(table, spark.createDataFrame([(batch, "x")], "stg_id bigint, wkn string"), batch)
    return ["STG_WP_STAMMDATEN", "STG_WP_FONDS_STAMMDATEN"]


def batches(store, table):
    return sorted(r.batch_id for r in store.read(table).collect())


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_a_crash_between_moves_is_carried_on(spark, tmp_path, monkeypatch, moves):
    store = Warehouse(spark, str(tmp_path))
    tables = staged(spark, store, 1)
    store.publish_batches(tables, 1)
    staged(spark, store, 2)
    real, made = store.folders.move, []

    def move(source, target):
        if "batch_id=" in target:
            if len(made) == moves:
                raise Crash
            made.append(target)
        real(source, target)

    def drop(path, real_drop=store.folders.drop):
        if "_absichten" in path:
            raise Crash
        real_drop(path)

    monkeypatch.setattr(store.folders, "move", move)
    monkeypatch.setattr(store.folders, "drop", drop)
    with pytest.raises(Crash):
        store.publish_batches(tables, 2)
    after = Warehouse(spark, str(tmp_path))
    assert [batches(after, t) for t in tables] == [[1], [1]], "half a source system is never seen"
    assert after.recover() == [2]
    assert [batches(after, t) for t in tables] == [[1, 2], [1, 2]]
    assert after.recover() == []


def test_an_error_between_moves_takes_everything_back(spark, tmp_path, monkeypatch):
    store = Warehouse(spark, str(tmp_path))
    tables = staged(spark, store, 1)
    real = store.folders.move

    def move(source, target):
        if "FONDS_STAMMDATEN/batch_id=" in target:
            raise OSError("no space")
        real(source, target)

    monkeypatch.setattr(store.folders, "move", move)
    with pytest.raises(OSError, match="no space"):
        store.publish_batches(tables, 1)
    assert [batches(store, t) for t in tables] == [[], []] and store.recover() == []
    monkeypatch.setattr(store.folders, "move", real)

    # an undo that is cut off is finished at the next start
    tables = staged(spark, store, 2)
    monkeypatch.setattr(store.folders, "move", move)
    monkeypatch.setattr(store, "_take_back", lambda note: (_ for _ in ()).throw(Crash()))
    with pytest.raises(Crash):
        store.publish_batches(tables, 2)
    after = Warehouse(spark, str(tmp_path))
    assert [batches(after, t) for t in tables] == [[], []] and after.recover() == [2]
    assert [batches(after, t) for t in tables] == [[], []] and after._open_notes() == []


# ---------------------------------------------------------------- logs


def log_rows(store):
    return sorted((r.log_id, r.ereignis_nr, r.status) for r in store.read("STG_LADELOG").collect())


def event(n):
    return {"log_id": n, "batch_id": 1, "quellsystem": "Q", "tabelle": "T", "ladestart": datetime(2024, 1, 1), "status": "GESTARTET",
            "erstellt_am": datetime(2024, 1, n % 28 + 1)}


def test_logs_are_merged_and_their_files_stay_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "EVENT_FILES", 5)
    store = Warehouse(spark, str(tmp_path))
    for n in range(1, 18):
        store.append_event("STG_LADELOG", event(n), 1)
    assert log_rows(store) == [(n, 1, "GESTARTET") for n in range(1, 18)]
    files = [f for f in tmp_path.rglob("STG_LADELOG/**/part-*")]
    assert len(files) < 17
    assert sorted(p.name for p in (tmp_path / "STG_LADELOG").iterdir()) == ["ab=2", "ab=3", "stand=2", "stand=3"]


def test_a_crash_while_merging_loses_nothing(spark, tmp_path, monkeypatch):
    store = Warehouse(spark, str(tmp_path))
    for n in range(1, 4):
        store.append_event("STG_LADELOG", event(n), 1)
    everything = log_rows(store)

    # cut off while the next generation is written: no success marker yet
    store.compact_log("STG_LADELOG")
    assert log_rows(store) == everything
    store.read("STG_LADELOG").write.parquet(f"{store.path('STG_LADELOG')}/stand=2")
    store.folders.drop(f"{store.path('STG_LADELOG')}/stand=2/_SUCCESS")
    store.append_event("STG_LADELOG", event(4), 1)
    assert len(log_rows(store)) == 4

    # cut off before the old one is dropped
    monkeypatch.setattr(store.folders, "drop", lambda path: (_ for _ in ()).throw(Crash()))
    with pytest.raises(Crash):
        store.compact_log("STG_LADELOG")
    after = Warehouse(spark, str(tmp_path))
    assert len(log_rows(after)) == 4
    after.append_event("STG_LADELOG", event(5), 1)
    after.compact_log("STG_LADELOG", lambda events: events.where("log_id > 2"))
    assert [n for n, _, _ in log_rows(after)] == [3, 4, 5]


# ---------------------------------------------------------------- resume


def installed(spark, path, clock, source=None, **options):
    control = Control(spark, str(path), source or sample_source(spark, DAY), clock=clock, **options)
    control.install(date(2024, 1, 1), date(2024, 1, 31))
    return control


def states(control, batch, phase):
    log = control.step_log().where((F.col("batch_id") == batch) & (F.col("phase") == phase)).orderBy("schritt_id").collect()
    return [(r.tabelle, r.status) for r in log]


def test_a_load_that_stopped_goes_on_where_it_was(spark, tmp_path, clock, monkeypatch):
    """The load ends after two facts; the second run redoes the third and the rest only."""
    control = installed(spark, tmp_path, clock)
    real, seen = control.load_fact, []

    def load_fact(load, batch_id, keys):
        seen.append(load.target)
        if len(seen) == 3:
            raise Crash
        return real(load, batch_id, keys)

    monkeypatch.setattr(control, "load_fact", load_fact)
    with pytest.raises(Crash):
        control.run_daily_etl(DAY)

    again = Control(spark, str(tmp_path), None, clock=clock)  # no source: nothing is staged again
    order, real_again = [], again.load_fact
    monkeypatch.setattr(again, "load_fact", lambda load, b, k: (order.append(load.target), real_again(load, b, k))[1])
    assert again.resume() == 1
    assert order == [load.target for load in FACT_LOADS[2:]]
    done = [s for s in states(again, 1, "ZIELBELADUNG")[-8:]]
    assert done == [(t, "UEBERSPRUNGEN") for t in ("DIM_WERTPAPIER", "DIM_FONDS", "DIM_DEPOT", "FAKT_WECHSELKURS", "FAKT_KURS")] + [
        (t, "ERFOLGREICH") for t in ("FAKT_BESTAND", "FAKT_TRANSAKTION", "FAKT_FONDSBEWEGUNG")]
    newest = again.process_log().orderBy(F.col("prozess_id").desc()).limit(4).collect()
    assert {(r.phase, r.status) for r in newest} == {
        ("GESAMT", "ERFOLGREICH"), ("STAGING", "UEBERSPRUNGEN"), ("TRANSFORMATION", "UEBERSPRUNGEN"), ("ZIELBELADUNG", "ERFOLGREICH")}
    assert {name: again.store.read(name).count() for name in ("FAKT_BESTAND", "FAKT_KURS", "FAKT_WECHSELKURS", "FAKT_TRANSAKTION", "FAKT_FONDSBEWEGUNG")} == {
        "FAKT_BESTAND": 2, "FAKT_KURS": 2, "FAKT_WECHSELKURS": 5, "FAKT_TRANSAKTION": 1, "FAKT_FONDSBEWEGUNG": 1}
    status = again.last_batch_status().first()
    assert (status.status_staging, status.status_zielladen, status.status_gesamt) == ("UEBERSPRUNGEN", "ERFOLGREICH", "ERFOLGREICH")
    assert again.resume() is None


class Broken:
    def __init__(self, inner, table):
        self.inner, self.table = inner, table

    def read(self, table):
        if table == self.table:
            raise RuntimeError("Quelle nicht erreichbar")
        return self.inner.read(table)


def test_a_source_system_that_failed_is_loaded_again_alone(spark, tmp_path, clock):
    source = sample_source(spark, DAY)
    control = installed(spark, tmp_path, clock, Broken(source, "STG_KV_WECHSELKURS"))
    with pytest.raises(RuntimeError):
        control.run_daily_etl(DAY)
    names = {s.name for s in SOURCE_SYSTEMS}
    assert dict(states(control, 1, "STAGING")) == {n: "FEHLER" if n == "KURSVERSORGUNG" else "ERFOLGREICH" for n in names}
    assert control.store.read("STG_KV_KURS").count() == 0 and control.store.read("STG_FB_BESTAND").count() == 2
    control.source = source
    assert control.resume() == 1
    assert dict(states(control, 1, "STAGING")[3:]) == {n: "ERFOLGREICH" if n == "KURSVERSORGUNG" else "UEBERSPRUNGEN" for n in names}
    assert control.store.read("STG_KV_KURS").count() == 2 and control.store.read("STG_FB_BESTAND").count() == 2
    assert control.store.read("FAKT_KURS").count() == 2


def test_source_systems_load_side_by_side(spark, tmp_path, clock):
    """Each first read waits for the two other systems: one after another would never end."""
    inner, meeting = sample_source(spark, DAY), threading.Barrier(3)

    class Meeting:
        def read(self, table):
            if table in ("STG_WP_STAMMDATEN", "STG_KV_KURS", "STG_FB_BESTAND"):
                meeting.wait(60)
            return inner.read(table)

    control = installed(spark, tmp_path, clock, Meeting())
    batch = control.run_staging_only(DAY)
    assert [r.tabelle for r in control.load_log().orderBy("log_id").collect()] == [t for s in SOURCE_SYSTEMS for t, _ in s.loads]
    assert control.store.read("STG_FB_BESTAND", batch_id=batch).count() == 2


# ---------------------------------------------------------------- delta


def test_delta_with_late_and_repeated_rows(spark, tmp_path, clock, monkeypatch):
    when = datetime(2024, 1, 10, 12, 0, 0)

    def source(*changes):
        delivered = sample_source(spark, DAY)
        frame = delivered.read("STG_WP_STAMMDATEN")
        data = [(f"DE00051400{n:02d}", w) for n, w in changes]
        times = spark.createDataFrame(data, "isin string, Geaendert_Am timestamp")
        frame = frame.where("isin = 'DE0005140008'").drop("isin").crossJoin(times)  # fixture only
        delivered.frames = {**delivered.frames, "STG_WP_STAMMDATEN": frame}
        return delivered

    def staged(batch):
        return sorted((r.isin[-2:], r.src_geaendert_am) for r in control.store.read("STG_WP_STAMMDATEN", batch_id=batch).collect())

    at = [when + timedelta(minutes=m) for m in range(0, 400, 10)]
    control = installed(spark, tmp_path, clock, source((1, at[0]), (2, at[20])),
                        delta={"STG_WP_STAMMDATEN": Delta("geaendert_am", ("isin",), timedelta(minutes=60))})
    first = control.run_staging_only(DAY)
    assert staged(first) == [("01", at[0]), ("02", at[20])] and control.store.watermark("STG_WP_STAMMDATEN") == at[20]

    # everything again, a late row inside the overlap, one beyond it, a changed one, and one without a time
    control.source = source((1, at[0]), (2, at[20]), (3, at[17]), (4, at[3]), (1, at[25]), (5, None))
    second = control.run_staging_only(DAY)
    assert Counter(staged(second)) == Counter([("03", at[17]), ("01", at[25]), ("05", None)])
    assert control.store.watermark("STG_WP_STAMMDATEN") == at[25]

    # published, but the process ended before the watermark moved: no row twice
    control.source = source((1, at[25]), (6, at[30]))
    monkeypatch.setattr(control.store, "advance_watermark", lambda table, until: (_ for _ in ()).throw(Crash()))
    with pytest.raises(Crash):
        control.load_source(SOURCE_SYSTEMS[0], 3, DAY)
    monkeypatch.undo()
    assert staged(3) == [("06", at[30])] and control.store.watermark("STG_WP_STAMMDATEN") == at[25]
    control.load_source(SOURCE_SYSTEMS[0], 4, DAY)
    assert staged(4) == []

    # a failed load leaves the watermark where it was; a time ahead of the clock does not move it past now
    control.source = Broken(source((7, at[32])), "STG_WP_FONDS_STAMMDATEN")
    with pytest.raises(RuntimeError):
        control.load_source(SOURCE_SYSTEMS[0], 5, DAY)
    assert control.store.watermark("STG_WP_STAMMDATEN") == at[25]
    control.source = source((7, at[32]), (8, datetime(2030, 1, 1)))
    control.load_source(SOURCE_SYSTEMS[0], 6, DAY)
    assert [n for n, _ in staged(6)] == ["07", "08"] and control.store.watermark("STG_WP_STAMMDATEN") <= clock.now
    with pytest.raises(ValueError, match="keeps no change time"):
        Control(spark, str(tmp_path), delta={"STG_KV_KURS": Delta("x", ("isin",))})


# ---------------------------------------------------------------- quality


def test_the_report_of_a_stored_batch_reads_no_table(spark, tmp_path, clock, monkeypatch):
    def spoil(rows):
        rows["STG_KV_KURS"][0]["isin"] = "DE1"
        rows["STG_KV_KURS"][1]["waehrung"] = "XXX"
        rows["STG_FB_TRANSAKTION"].clear()

    control = installed(spark, tmp_path, clock, sample_source(spark, DAY, spoil))
    batch = control.run_staging_only(DAY)
    for _ in range(2):
        control.run_transform_only(batch)
    names = [*monitor.REPORT_TABLES, "VOR_WECHSELKURS"]
    scanned = monitor.quality_report({n: control.store.read(n, batch_id=batch) for n in names}, with_fx=True)
    want = {tuple(r) for r in scanned.collect()}
    asked, real = [], control.store.read
    monkeypatch.setattr(control.store, "read", lambda table, **options: (asked.append(table), real(table, **options))[1])
    report = control.check_data_quality(batch, with_fx=True)
    got = {(r.batch_id, r.tabelle, r.bezeichnung, r.anzahl, r.ungueltig, r.ohne_eur_kurs) for r in report.collect()}
    assert set(asked) == {"ETL_SCHRITTLOG"}
    assert {r for r in got if r[3]} == want and {r[1] for r in got if not r[3]} == {"VOR_TRANSAKTION"}
    assert {(r[1], r[4], r[5]) for r in got if r[4] or r[5]} == {("VOR_KURS", 1, 1)}
    assert {r.ergebnis for r in report.collect()} == {"WARNUNG"}

    # a batch whose counts are missing is scanned
    monkeypatch.undo()
    control.store.folders.drop(control.store.path("ETL_SCHRITTLOG"))
    assert rows(control.check_data_quality(batch, with_fx=True)) == rows(report)
