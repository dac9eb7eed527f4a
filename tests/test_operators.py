"""Operators against brute force on small fixtures, including skewed and NULL keys."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from depotwerk.operators import integrity, merge
from depotwerk.operators.calendar import calendar
from depotwerk.operators.dedupe import latest
from depotwerk.operators.fx import eur_rates, rate_requests, with_eur_rate
from depotwerk.operators.joins import PIECES, anti, fits_tasks, lookup, small_enough, split_hot_join
from depotwerk.operators.keys import KeyTable
from depotwerk.operators.numbering import arrival_ids, number_rows, with_arrival
from depotwerk.operators.retention import retain
from depotwerk.operators.scd2 import point_in_time, scd2, version_at
from depotwerk.operators.weights import with_portfolio_weight
from depotwerk.plans.transforms import weighted_positions
from depotwerk.schemas import TABLES, nullable
from depotwerk.sources import seeds
from depotwerk.sources.store import Warehouse

TS = datetime(2024, 1, 1)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_drops_null_keys_and_survives_a_hot_key(spark):
    data = [("hot", i, i % 7) for i in range(3000)] + [("a", 1, 0), ("b", 5, 1), ("b", 9, 2), (None, 99, 0)]
    df = latest(spark.createDataFrame(data, "k string, stg_id bigint, v int"), ["k"])
    text = plan(df)
    assert text.count("WindowGroupLimit") == 2, "one row per key and input task before the shuffle"
    assert rows(df) == Counter([("hot", 2999, 2999 % 7), ("a", 1, 0), ("b", 9, 2)])


def test_hot_keys_are_split_without_changing_the_join(spark):
    data = [("hot", i) for i in range(900)] + [(None, i) for i in range(900, 1200)] + [(f"k{i}", i) for i in range(1200, 1500)]
    table = [("hot", 1), *[(f"k{i}", i) for i in range(1200, 1400)], ("unused", 7)]
    left = spark.createDataFrame(data, "k string, n int").repartition(3)
    right = spark.createDataFrame(table, "k string, x int")
    for how in ("left", "inner"):
        split = split_hot_join(left, right, ["k"], spread_by=["n"], how=how)
        assert rows(split) == rows(left.join(right, "k", how))
    forced = lookup(left, right, ["k"], spread_by=["n"], max_rows=0)
    assert "SortMergeJoin" in plan(forced) or "AdaptiveSparkPlan" in plan(forced)
    assert rows(forced) == rows(lookup(left, right, ["k"], spread_by=["n"]))
    # the hot key really lands in several pieces
    pieces = left.where("k = 'hot'").select(F.pmod(F.xxhash64("n"), F.lit(PIECES)).alias("p")).distinct().count()
    assert pieces == PIECES


def test_copies_of_a_split_table_are_never_broadcast(spark, tmp_path):
    # F1 to F6: the file is far below Spark's own bound of a broadcast, its sixteen copies are not
    for name, n in (("rows", 3000), ("table", 1000)):
        spark.range(n).selectExpr("cast(id AS string) AS k", f"id AS {name}").write.parquet(str(tmp_path / name))
    left, right = (spark.read.parquet(str(tmp_path / name)) for name in ("rows", "table"))
    joined = lookup(left, right, ["k"], spread_by=["rows"], max_rows=10)
    assert joined.count() == 3000 and joined.where("table IS NOT NULL").count() == 1000
    text = plan(joined)
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_a_chain_of_lookups_reads_its_rows_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([(None if i % 7 == 0 else i % 3, i) for i in range(200)], "k int, n int").write.parquet(path)
    table = spark.createDataFrame([(0, 10), (2, 12)], "k int, x int")
    chained = small = spark.read.parquet(path)
    for step in range(1, 6):
        named = table.withColumnRenamed("x", f"x{step}")
        chained = lookup(chained, named, ["k"], spread_by=["n"], max_rows=0)
        small = lookup(small, named, ["k"], spread_by=["n"])
        assert chained._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert rows(chained) == rows(small)


def test_broadcasts_are_bounded_by_bytes(spark):
    texts = spark.createDataFrame([("a", "b")], "k string, t string")
    assert small_enough(texts, rows=1000) and not small_enough(texts, rows=2_000_000, max_rows=10**9)


def test_anti_both_ways(spark):
    left = spark.createDataFrame([(i % 5, i) for i in range(50)], "k int, n int")
    have = spark.createDataFrame([(k,) for k in (1, 3, 3, 9)], "k int")
    expected = Counter({(i % 5, i): 1 for i in range(50) if i % 5 not in (1, 3)})
    assert rows(anti(left, have, ["k"])) == expected
    assert rows(anti(left, have, ["k"], max_rows=0)) == expected


def brute_rate(quotes, batch, ccy, day, lookback=5):
    if ccy == "EUR":
        return Decimal(1)
    fit = [q for q in quotes if q["von"] == ccy and q["nach"] == "EUR" and day is not None
           and day - timedelta(days=lookback) <= q["datum"] <= day]
    if not fit:
        return None
    best = max(fit, key=lambda q: (q["datum"] == day and q["batch"] == batch, q["datum"], q["typ"] == "EZB",
                                   q["batch"], q["id"]))
    return best["kurs"]


def asked_rates(ask, fx, currency="ccy", **options):
    return eur_rates(rate_requests(ask, F.col(currency), "d"), fx, **options)


@pytest.mark.parametrize(("max_rows", "lookback", "piece_days"), [(1_000_000, 5, 64), (0, 5, 7), (1_000_000, 400, 3), (0, 0, 1)])
def test_fx_asof_against_brute_force(spark, max_rows, lookback, piece_days):
    rnd = random.Random(lookback)
    start, span = date(2024, 1, 1), 60 if lookback < 100 else 900
    quotes = [dict(id=i, batch=rnd.randint(1, 4), von=rnd.choice(["USD", "GBP", "JPY"]),
                   nach=rnd.choice(["EUR", "EUR", "EUR", "CHF"]), datum=start + timedelta(days=rnd.randint(0, span)),
                   typ=rnd.choice(["EZB", "GELD"]), kurs=Decimal(rnd.randint(1, 10**6)) / 10**4) for i in range(80 if span == 60 else 12)]
    fx = spark.createDataFrame(
        [(q["id"], q["batch"], f" {q['von'].lower()}", q["nach"], q["datum"], q["typ"], q["kurs"]) for q in quotes],
        "stg_id bigint, batch_id bigint, waehrung_von string, waehrung_nach string, kursdatum date, kurstyp string, "
        "kurs decimal(20,8)")
    wanted = [(n, b, c, start + timedelta(days=d)) for n, (b, c, d) in enumerate(
        (b, c, d) for b in (1, 2, 3, 4, None) for c in ("USD", "GBP", "JPY", "EUR", "SEK", None) for d in range(-2, span + 10, 1 if span == 60 else 29))]
    wanted += [(9999, 1, "USD", None), *[(10000 + i, 1, "USD", start + timedelta(days=9)) for i in range(50)]]
    df = spark.createDataFrame(wanted, "n int, batch_id bigint, ccy string, d date")
    table = asked_rates(df, fx, lookback=lookback, piece_days=piece_days)
    got = with_eur_rate(df, table, currency=F.col("ccy"), on_date="d", spread_by=["n"], max_rows=max_rows)
    expected = {n: brute_rate(quotes, b, c, d, lookback) for n, b, c, d in wanted}
    assert {r.n: r.wechselkurs_eur for r in got.collect()} == expected and any(v and v != 1 for v in expected.values())


def test_fx_rates_are_one_sort_whatever_the_look_back(spark):
    fx = spark.createDataFrame([(1, 1, "USD", "EUR", date(2024, 1, 1), "EZB", Decimal("0.8"))],
                               "stg_id bigint, batch_id bigint, waehrung_von string, waehrung_nach string, "
                               "kursdatum date, kurstyp string, kurs decimal(20,8)")
    ask = spark.createDataFrame([(1, "USD", date(2024, 1, 3))], "batch_id bigint, ccy string, d date")
    texts = [plan(asked_rates(ask, fx, lookback=n)) for n in (5, 400)]
    assert texts[0].count("Exchange") == texts[1].count("Exchange")
    assert all("Generate" not in t and "SortAggregate" not in t and "NestedLoop" not in t for t in texts)


def test_fx_inverse_is_opt_in(spark):
    fx = spark.createDataFrame([(1, 1, "EUR", "GBP", date(2024, 1, 1), "EZB", Decimal("0.8"))],
                               "stg_id bigint, batch_id bigint, waehrung_von string, waehrung_nach string, "
                               "kursdatum date, kurstyp string, kurs decimal(20,8)")
    ask = spark.createDataFrame([(1, "GBP", date(2024, 1, 3))], "batch_id bigint, ccy string, d date")
    for allowed, rate in ((False, None), (True, Decimal("1.25"))):
        got = with_eur_rate(ask, asked_rates(ask, fx, allow_inverse=allowed), currency=F.col("ccy"), on_date="d", spread_by=["ccy"])
        assert got.first().wechselkurs_eur == rate


@pytest.mark.parametrize("portfolios", [10, 10**9])
def test_weights(spark, portfolios):
    rnd = random.Random(3)
    data = [(f"F{i % 3}", f"I{i}", Decimal(rnd.randint(1, 10**7)) / 100, "J" if i % 4 else "N") for i in range(200)]
    data += [("Z", "a", Decimal("5"), "J"), ("Z", "b", Decimal("-5"), "J"), ("N", "a", None, "J"), ("M", "a", None, "J"),
             ("M", "b", Decimal("4"), "J")]
    df = spark.createDataFrame([(f, i, date(2024, 1, 1), 1, v, j) for f, i, v, j in data],
                               "fonds_id string, isin string, bewertungsdatum date, batch_id bigint, "
                               "marktwert_fondswaehrung decimal(20,2), ist_gueltig string")
    got = {(r.fonds_id, r.isin): r.portfoliogewicht for r in with_portfolio_weight(df, portfolios=portfolios).collect()}
    totals = defaultdict(Decimal)
    for f, _, v, j in data:
        if j == "J" and v is not None:
            totals[f] += v
    for f, i, v, j in data:
        if j == "N" or f == "Z":
            expected = 0
        elif v is None:
            expected = None
        else:
            expected = (v / totals[f] * 100).quantize(Decimal("0.000001"), ROUND_HALF_UP)
        assert got[f, i] == expected, (f, i)
    for f in ("F0", "F1", "F2"):
        assert abs(sum(got[x, i] for x, i, _, _ in data if x == f) - 100) < Decimal("0.0002")


def test_small_portfolios_move_once_and_large_ones_are_joined(spark, tmp_path):
    # F7 to F9: the totals were copied sixteen times, and the rows shuffled twice and stored
    rnd = random.Random(8)
    data = [(i, rnd.choice([1, 2, None]), rnd.choice(["F1", "F2", "F3", None]), rnd.choice(["DE0000000011", "DE0000000029", "x", None]),
             rnd.choice([date(2024, 1, 31), date(2024, 2, 29), None]), rnd.choice([None, *(Decimal(rnd.randint(-500, 500)) / 4 for _ in range(9))]))
            for i in range(600)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(data, "stg_id bigint, batch_id bigint, fonds_id string, isin string, bewertungsdatum date, marktwert decimal(20,2)") \
        .withColumn("marktwert_fondswaehrung", F.col("marktwert")).write.parquet(path)
    stg, stored = spark.read.parquet(path), []

    def keep(df):
        stored.append(df)
        return df

    once = weighted_positions(stg, stored=keep)
    assert not stored and plan(once).count("Exchange") == 1 and "Join" not in plan(once)
    joined = weighted_positions(stg, stored=keep, rows_per_task=5)
    assert len(stored) == 1 and "Join" in plan(joined)
    assert rows(once) == rows(joined.select(once.columns)) and once.count() > 20
    # a missing key part equals nothing, also where the caller has not left such rows out
    odd = stg.withColumn("ist_gueltig", F.lit("J"))
    assert rows(with_portfolio_weight(odd, small_groups=True)) == rows(with_portfolio_weight(odd).select(*odd.columns, "portfoliogewicht"))


def test_largest_key_decides_whether_keys_fit_tasks(spark):
    df = spark.createDataFrame([(None,)] * 4 + [(1,)] * 3, "k int")
    assert fits_tasks(df, ["k"], 4) and not fits_tasks(df, ["k"], 3)


def test_numbering(spark):
    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "k int").repartition(5)
    got = {r.k: r.sk for r in number_rows(df, ["k"], "sk", start=11, partitions=4).collect()}
    assert got == {k: k + 11 for k in range(101)}
    assert number_rows(df.where("k < 0"), ["k"], "sk").count() == 0


def test_arrival_follows_file_and_position(spark, tmp_path):
    """Spark packs the largest files first; numbers follow the file names."""
    spark.range(100, 110).coalesce(1).write.parquet(str(tmp_path / "d/1_first"))
    spark.range(0, 5000).coalesce(1).write.parquet(str(tmp_path / "d/2_larger"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "4k"):  # one task, and files cut into parts
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = with_arrival(spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "d")))
            taken = []
            got = arrival_ids(df, "nr", lambda n: taken.append(n) or 2**62).orderBy("nr").collect()
            assert taken == [5010]
            assert [r.id for r in got] == [*range(100, 110), *range(5000)]
            assert [r.nr for r in got] == list(range(2**62, 2**62 + 5010))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    empty = arrival_ids(df.where("id < 0"), "nr", lambda n: 1)
    assert empty.count() == 0 and "nr" in empty.columns


def test_calendar(spark):
    days = {r.datum: r for r in calendar(spark, date(2020, 12, 28), date(2021, 3, 31)).collect()}
    d = days[date(2021, 1, 1)]
    assert (d.zeit_id, d.wochentag_nr, d.wochentag_name, d.wochentag_kuerzel, d.ist_wochenende, d.woche_im_jahr, d.jahr,
            d.quartal_name) == (20210101, 5, "Freitag", "Fr", "N", 53, 2021, "Q1/2021")
    d = days[date(2021, 3, 7)]
    assert (d.monat_name, d.monat_kuerzel, d.wochentag_nr, d.ist_wochenende, d.ist_bankarbeitstag, d.ist_feiertag) == (
        "März", "Mär", 7, "J", "J", "N")
    known = calendar(spark, date(2021, 1, 1), date(2021, 1, 10))
    assert calendar(spark, date(2021, 1, 5), date(2021, 1, 12), known).count() == 2
    full = calendar(spark)
    assert full.count() == 14976 and nullable(full.schema) == TABLES["DIM_ZEIT"].schema


DIM = ("sk bigint, gueltig_von date, gueltig_bis date, ist_aktuell string, dwh_version bigint, k string, a string, b string, "
       "erstellt_am timestamp, geaendert_am timestamp, batch_id_erstellt bigint, batch_id_geaendert bigint")
OPEN = date(9999, 12, 31)


def test_scd2(spark):
    def row(sk, k, a, b, version=1, current="J"):
        return (sk, date(2023, 1, 1), OPEN if current == "J" else date(2023, 6, 1), current, version, k, a, b, TS, TS, 1, 1)

    dim = spark.createDataFrame(
        [row(1, "same", "x", "1"), row(2, "changed", "x", "1", 2), row(3, "changed", "w", "1", 1, "N"), row(4, "gone", "x", "1"),
         row(5, "null", None, "1"), row(6, "closed", "x", "1", 4, "N"), row(7, "twice", "x", "1"), row(8, "twice", "y", "1", 2)], DIM)
    batch = spark.createDataFrame(
        [("same", "x", "other"), ("changed", "y", "1"), ("null", None, "1"), ("new", "n", "1"), ("closed", "x", "1"),
         ("twice", "y", "1")], "k string, a string, b string")
    for max_rows in (1000, 0):
        r = scd2(dim, batch, key="k", sk="sk", tracked=["a"], run_date=date(2024, 2, 1), run_ts=TS, batch_id=9, max_rows=max_rows)
        assert {(x.sk, x.gueltig_bis, x.ist_aktuell, x.batch_id_geaendert) for x in r.closed.collect()} == {
            (2, date(2024, 1, 31), "N", 9), (7, date(2024, 1, 31), "N", 9)}
        assert {(x.k, x.dwh_version, x.gueltig_von, x.gueltig_bis, x.sk) for x in r.inserted.collect()} == {
            ("changed", 3, date(2024, 2, 1), OPEN, None), ("new", 1, date(2024, 2, 1), OPEN, None),
            ("closed", 5, date(2024, 2, 1), OPEN, None)}
        assert r.snapshot().count() == 11
    again = scd2(r.snapshot(), batch, key="k", sk="sk", tracked=["a"], run_date=date(2024, 2, 2), run_ts=TS, batch_id=10)
    assert again.closed.count() == again.inserted.count() == 0
    same_day = scd2(r.snapshot(), batch.withColumn("a", F.lit("z")), key="k", sk="sk", tracked=["a"],
                    run_date=date(2024, 2, 1), run_ts=TS, batch_id=10).snapshot()
    assert {x.k for x in integrity.interval_violations(same_day, "k").collect()} == {"changed", "new", "closed"}
    assert same_day.where("k = 'new'").transform(version_at, date(2024, 2, 1)).count() == 1


def test_point_in_time(spark):
    dim = spark.createDataFrame([("a", date(2024, 1, 1), date(2024, 1, 31), 1), ("a", date(2024, 2, 1), date(2024, 1, 31), 2),
                                 ("a", date(2024, 2, 1), OPEN, 3)], "k string, gueltig_von date, gueltig_bis date, v int")
    ask = spark.createDataFrame([("a", date(2023, 12, 31)), ("a", date(2024, 1, 31)), ("a", date(2024, 2, 1)), ("b", date(2024, 2, 1))],
                                "k string, d date")
    for max_rows in (1000, 0):
        got = point_in_time(ask, dim, key="k", on_date="d", take=["v"], max_rows=max_rows)
        assert [r.v for r in got.orderBy("k", "d").collect()] == [None, 1, 3, None]


def test_upsert_matches_null_key_parts(spark):
    t = spark.createDataFrame([(1, "a", None, 10, "alt"), (2, "b", "x", 20, "alt")], "id bigint, k string, o string, v int, fix string")
    s = spark.createDataFrame([("a", None, 11, "neu"), ("b", None, 21, "neu"), ("c", "x", 30, "neu")], "k string, o string, v int, fix string")
    got = merge.upsert(t, s, ["k", "o"], ["v"])
    assert rows(got) == Counter([(1, "a", None, 11, "alt"), (2, "b", "x", 20, "alt"), (None, "b", None, 21, "neu"),
                                 (None, "c", "x", 30, "neu")])
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    assert rows(merge.upsert(t, s.limit(0), ["k", "o"], ["v"])) == rows(t)


def test_one_per_key_and_unresolved(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", "x", 3)], "k string, o string, vor_id bigint")
    with pytest.raises(merge.DuplicateKeyError):
        merge.one_per_key(df, ["k", "o"])
    assert rows(merge.one_per_key(df, ["k", "o"], on_duplicate="latest")) == Counter([("a", None, 2), ("b", "x", 3)])
    good, bad = merge.resolved(df, ["o"], "reject")
    assert good.count() == 1 and {r.fehlende_schluessel for r in bad.collect()} == {"o"}
    with pytest.raises(merge.UnresolvedKeyError):
        merge.resolved(df, ["o"])
    assert rows(merge.insert_if_absent(df.where("k='b'"), df, ["k"])) == Counter([("a", None, 1), ("a", None, 2)])


def test_sector_lookup_prefers_gics(spark):
    dim = seeds.sectors(spark, TS).unionByName(
        seeds.sectors(spark, TS).limit(1).withColumns({"branche_id": F.lit(99).cast("bigint"), "branche_intern_code": F.lit("40"),
                                                       "gics_sektor_code": F.lit("77")}))
    codes = {r.code: r.id for r in KeyTable.sectors(dim).table.collect()}
    assert codes["40"] == 7 and codes["FINANZ"] == 7 and codes["IT"] == 8 and codes["77"] == 99


def test_integrity(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 2), ("b", 3)], "k string, n int")
    assert rows(integrity.unique_violations(df, ["k"])) == Counter([("a", 2), (None, 2)])
    parent = spark.createDataFrame([("a",)], "p string")
    for max_rows in (1000, 0):
        assert rows(integrity.fk_violations(df, "k", parent, "p", max_rows)) == Counter([("b", 1)])
    assert integrity.allowed_violations(df, "k", ["a"]).count() == 1
    funds = spark.createDataFrame([("F", None, "X"), ("F", "n", "J")], "fonds_id string, fondsname string, ucits_konform string")
    got = {(r.spalte, r.regel, r.anzahl) for r in integrity.column_violations(funds, TABLES["STG_WP_FONDS_STAMMDATEN"]).collect()}
    assert got == {("fondsname", "NOT NULL", 1), ("ucits_konform", "VALUES", 1)}


def test_retention_boundary(spark):
    now = datetime(2024, 4, 1)
    df = spark.createDataFrame([(1, now - timedelta(days=90)), (2, now - timedelta(days=90, seconds=1)), (3, None)], "n int, ts timestamp")
    assert {r.n for r in retain(df, "ts", now).collect()} == {1, 3}


def test_store_replace_batch(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    layout = TABLES["VOR_WECHSELKURS"]
    empty = spark.createDataFrame([], layout.schema)

    def batch(b, n):
        return spark.range(n).selectExpr("id AS vor_id", f"cast({b} AS bigint) AS batch_id", "'USD' AS waehrung_von")

    assert store.read(layout.name).count() == 0
    assert store.replace_batch(layout.name, batch(1, 3), 1) == 3
    assert store.replace_batch(layout.name, batch(2, 2), 2) == 2
    assert store.replace_batch(layout.name, batch(1, 1), 1) == 1
    assert Counter(r.batch_id for r in store.read(layout.name).collect()) == {1: 1, 2: 2}
    assert store.replace_batch(layout.name, empty, 2) == 0
    assert store.read(layout.name).count() == 1
    one = store.read(layout.name, batch_id=1)
    assert "PartitionFilters: [isnotnull(batch_id" in plan(one)


def test_rates_up_to_the_own_batch(spark, tmp_path):
    """A late batch delivers a newer rate; only 'all' lets an older batch see it."""
    from depotwerk.plans.control import Control

    control = Control(spark, str(tmp_path))
    for number, day, kurs in ((1, 1, "0.5"), (2, 3, "0.7")):
        fx = spark.createDataFrame([(number, number, TS, "USD", "EUR", date(2024, 1, day), "EZB", Decimal(kurs))],
                                   "stg_id bigint, batch_id bigint, ladezeit timestamp, waehrung_von string, "
                                   "waehrung_nach string, kursdatum date, kurstyp string, kurs decimal(20,8)")
        control.store.stage_batch("STG_KV_WECHSELKURS", fx, number)
        control.store.publish_batches(["STG_KV_WECHSELKURS"], number)
    ask = spark.createDataFrame([(1, date(2024, 1, 4))], "batch_id bigint, d date")
    asking = spark.createDataFrame([(1, 1, TS, "X", date(2024, 1, 4), "USD")],
                                   "stg_id bigint, batch_id bigint, ladezeit timestamp, isin string, kursdatum date, waehrung string")
    control.store.stage_batch("STG_KV_KURS", asking, 1)
    control.store.publish_batches(["STG_KV_KURS"], 1)
    for policy, rate in (("all", "0.7"), ("up_to_batch", "0.5")):
        control.fx_batches = policy
        got = with_eur_rate(ask, control.rates(1), currency=F.lit("USD"), on_date="d", spread_by=["d"])
        assert got.first().wechselkurs_eur == Decimal(rate)


def test_numbers_are_set_aside_once(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    assert [store.reserve("STG_KV_KURS", n) for n in (5, 0, 3)] == [1, 6, 6]
    assert store.reserve("FAKT_KURS", 1) == 1 and Warehouse(spark, str(tmp_path)).reserve("STG_KV_KURS", 1) == 9


def test_rejects_of_a_rerun_replace_the_first(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    bad = spark.createDataFrame([(1, "x", 7), (2, "y", 7)], "n int, fehlende_schluessel string, batch_id bigint")
    for rows_of_batch, batch in ((bad, 7), (bad, 7), (bad.limit(1), 8)):
        store.replace_rejects("FAKT_KURS", rows_of_batch, batch)
    assert rows(spark.read.parquet(store.path("FAKT_KURS_ABGELEHNT")).groupBy("batch_id").count()) == Counter([(7, 2), (8, 1)])


def test_references_and_rows_that_break_a_rule(spark):
    layout = TABLES["FAKT_KURS"]
    facts = spark.createDataFrame([(20240101, 1, None)] * 3 + [(19990101, 2, 9)], "zeit_id bigint, wertpapier_sk bigint, waehrung_id bigint")
    parents = {"DIM_ZEIT": spark.range(20240101, 20240102).toDF("zeit_id"), "DIM_WERTPAPIER": spark.range(2).toDF("wertpapier_sk"),
               "DIM_WAEHRUNG": spark.range(5).toDF("waehrung_id")}
    for max_rows in (1000, 0):
        got = integrity.reference_violations(facts, layout, parents.__getitem__, max_rows)
        assert rows(got) == Counter([("zeit_id", "19990101", 1), ("wertpapier_sk", "2", 1), ("waehrung_id", "9", 1)])
    funds = spark.createDataFrame([("F", None, "X"), ("G", "n", "J")], "fonds_id string, fondsname string, ucits_konform string")
    got = integrity.row_violations(funds, TABLES["STG_WP_FONDS_STAMMDATEN"]).collect()
    assert [(r.fonds_id, r.regeln) for r in got] == [("F", "fondsname NOT NULL, ucits_konform VALUES")]


def test_rates_with_large_arrival_numbers_and_many_batches(spark):
    """Ranks compare as they are: no bits are packed, no list per day is gathered."""
    day = date(2024, 1, 15)
    quotes = [(2**62 + i, b, "USD", "EUR", day, kind, kurs) for i, (b, kind, kurs) in enumerate(
        [(1, "EZB", "0.90"), (1, "EZB", "0.91"), (1, "GELD", "0.99"), *[(b, "GELD", "0.50") for b in range(2, 300)]])]
    fx = spark.createDataFrame([(*q[:6], Decimal(q[6])) for q in quotes],
                               "stg_id bigint, batch_id bigint, waehrung_von string, waehrung_nach string, kursdatum date, kurstyp string, kurs decimal(20,8)")
    ask = spark.createDataFrame([(1, "USD", day), (7, "USD", day), (900, "USD", day), (1, "USD", date(2024, 1, 20)), (1, "USD", date(2024, 1, 21))],
                                "batch_id bigint, ccy string, d date")
    table = asked_rates(ask, fx)
    assert "collect_list" not in plan(table)
    got = with_eur_rate(ask, table, currency=F.col("ccy"), on_date="d", spread_by=["d"])
    assert Counter((r.batch_id, r.d.day, r.wechselkurs_eur and str(round(r.wechselkurs_eur, 2))) for r in got.collect()) == Counter(
        [(1, 15, "0.91"), (7, 15, "0.50"), (900, 15, "0.91"), (1, 20, "0.91"), (1, 21, None)])
