"""Work done slice by slice: whole results, and no more on disk than one slice shuffles."""

import random
import time
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from depotwerk.operators import slices
from depotwerk.testbed import queries


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size())
            if files.apply(i).getName().startswith("shuffle_")}


def left_over(spark, before):
    """Shuffle files that are still there after a while; they are removed in the background."""
    for _ in range(50):
        new = shuffle_files(spark) - before
        if not new:
            break
        time.sleep(0.1)
    return new


def test_slices_hold_every_row_once_and_keys_together(spark):
    data = [(f"f{i % 9}" if i % 10 else None, i % 5 if i % 7 else None, i) for i in range(700)]
    df = spark.createDataFrame(data, "a string, b int, n int")
    parts = [part.collect() for part in slices.cut(df, ["a", "b"], 4)]
    assert Counter(r.n for part in parts for r in part) == Counter(range(700))
    keys = [{(r.a, r.b) for r in part} for part in parts]
    assert sum(map(len, keys)) == len(set().union(*keys)), "a key lies in one slice"
    assert slices.slice_count(df) == 1
    assert slices.slice_count(df, rows_per_slice=300) == 3
    assert slices.slice_count(df, rows_per_slice=10) == slices.MOST_SLICES
    assert slices.slice_count(df.limit(0)) == 1


def test_a_slice_leaves_its_result_only(spark, tmp_path):
    df = spark.range(4000).selectExpr("id % 50 AS k", "id AS n")
    before, seen, dropped, setting = shuffle_files(spark), [], [], spark.conf.get(slices._CLEANUP, None)

    def build(part, stored):
        seen.append(left_over(spark, before))
        kept = stored(part.groupBy("k").agg(F.sum("n").alias("s")))
        return kept.join(part.hint("merge"), "k")

    got = slices.slice_by_slice(slices.cut(df, ["k"], 3), build, str(tmp_path), dropped.append)
    assert seen == [set(), set(), set()] and not left_over(spark, before)
    assert dropped == [f"{tmp_path}/arbeit"] * 3
    assert rows(got) == rows(df.groupBy("k").agg(F.sum("n").alias("s")).join(df, "k"))
    assert spark.conf.get(slices._CLEANUP, None) == setting


def test_the_setting_comes_back_after_an_error(spark):
    before = spark.conf.get(slices._CLEANUP, None)
    spark.conf.set(slices._CLEANUP, "false")
    try:
        with pytest.raises(ZeroDivisionError), slices.shuffles_dropped(spark):
            assert spark.conf.get(slices._CLEANUP) == "true"
            raise ZeroDivisionError
        assert spark.conf.get(slices._CLEANUP) == "false"
    finally:
        spark.conf.unset(slices._CLEANUP) if before is None else spark.conf.set(slices._CLEANUP, before)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Deliveries in which half of the positions come in both batches, some repeated, some with missing parts."""
    rnd, folder, start = random.Random(4), str(tmp_path_factory.mktemp("tables")), datetime(1998, 1, 1)
    lines = []
    for i in range(900):
        part, supplier, day = rnd.randrange(40), rnd.choice([*range(12), None]), start + timedelta(days=rnd.randrange(90))
        for status in rnd.choice(["F", "O", "FO", "FO", "FFO"]):
            lines.append((i, rnd.choice([part] * 20 + [None]), supplier, len(lines) % 7, float(rnd.randint(1, 50)),
                          rnd.randint(100, 99999) / 100, rnd.randint(0, 10) / 100, rnd.randint(0, 8) / 100, "A", status,
                          rnd.choice([day] * 20 + [None])))
    made = {
        "lineitem": (lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                            "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                            "l_linestatus string, l_shipdate timestamp_ntz"),
        "supplier": ([(i, f"s{i}", i % 25, 1.0) for i in range(12)],
                     "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(i, "p", "b", "t", i % 9, 1.0) for i in range(38)],
                 "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(i, i % 8, "FO"[i % 2], 1.0, start + timedelta(days=i % 90), "5-LOW") for i in range(600)],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                   "o_orderdate timestamp_ntz, o_orderpriority string"),
        "events": ([(i, start, i % 30, "view", 1.0, "{}") for i in range(60)],
                   "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"),
    }
    for name, (data, schema) in made.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("large_portfolios", [False, True])
def test_upsert_holding_is_the_same_in_slices(spark, tables, monkeypatch, large_portfolios):
    # all shuffles of the load and of the upsert lay on disk at once, ten times the input
    run = queries.QUERIES["upsert_holding"]
    whole = rows(run(spark, tables))
    if large_portfolios:
        monkeypatch.setattr(queries, "fits_tasks", lambda *a: False)
    monkeypatch.setattr(queries, "slice_count", lambda *a: 3, raising=False)
    before = shuffle_files(spark)
    sliced = run(spark, tables)
    assert not left_over(spark, before), "what the load shuffled is still on disk"
    assert rows(sliced) == whole and len(whole) > 300
    assert not left_over(spark, before), "the result is read, not shuffled again"
