"""Registered queries against their SQL on the smallest tables, held-out accuracy, and the pipeline against a brute-force version."""

import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from test_llm_operators import TOKENIZER, plain_best_fit, plain_near, plain_secrets, words
from tokenizers import Tokenizer

import corpus_pipeline
from depotwerk.llm import oracle, queries
from depotwerk.llm.common import ship

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("test tables not there")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", list(oracle.ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    relation = duck.sql(oracle.ORACLE[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    want = Counter(tuple(r[i] for i in order) for r in relation.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == want and want


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in oracle.ORACLE])
def test_query_covers_its_table(spark, duck, name):
    ids = {r.doc_id for r in queries.QUERIES[name](spark, SF).select("doc_id").collect()}
    assert ids == {r[0] for r in duck.sql("SELECT doc_id FROM documents").fetchall()}


def test_language_of_held_out_rows(spark, duck):
    lang = dict(duck.sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = [r for r in queries.op4_language(spark, SF).collect() if r.lang_pred != "und"]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(12)
    texts = ["123 456", None, "", "!!! ???", "under"]
    for _ in range(15):
        base = words(rng, rng.randrange(20, 90))
        texts += [" ".join(base), "  ".join(base)]
        texts.append(" ".join([*base[:-1], "changed"]))
        texts.append(" ".join(words(rng, 30)) + " password=hunter22x deadbeefdeadbeefdeadbeef00")
    rng.shuffle(texts)
    docs = spark.createDataFrame([(i, t, "xx", "s", len(t or "")) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id].append(r)

    kept = {i: t for i, t in enumerate(texts) if re.search(r"[^\W\d_]", t or "")}
    first = {}
    for i, t in sorted(kept.items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", t), i)
    kept = {i: kept[i] for i in sorted(first.values())}
    ids = list(kept)
    near = plain_near([kept[i] for i in ids], 5, 80)
    kept = {ids[k]: kept[ids[k]] for k, (_, c) in near.items() if c == k}
    masked = {}
    for i, t in kept.items():
        out, at = [], 0
        for start, _, end in plain_secrets(t):
            if start >= at:
                out += [t[at:start], "[SECRET]"]
            at = max(at, end)
        masked[i] = "".join([*out, t[at:]])
    assert set(got) == set(masked) and any("[SECRET]" in t for t in masked.values())
    tokenizer = Tokenizer.from_file(TOKENIZER)
    for i, t in masked.items():
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        assert [(r.piece, r.length, r.ids_crc32) for r in got[i]] == [(0, len(ids), zlib.crc32(ids.tobytes()))]
    sequences = {r.sequence_id for rows in got.values() for r in rows}
    assert len(sequences) == len(plain_best_fit([r.length for rows in got.values() for r in rows], 2048))


def test_stages_keep_the_columns_of_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, "").columns == empty.columns, name
    assert stage(spark, empty, "").count() == 0
