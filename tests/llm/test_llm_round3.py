"""Centroid clustering, benchmark decontamination and fill-in-the-middle against brute force, and on odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from depotwerk.llm import centroids, common, decontamination, fill_middle, langid, passages, suffix_dedup
from depotwerk.llm.common import ship

ODD = [None, "", " ", "\n", "\n\n\n", "a", "a\n", "ÄÖ ß\nüü", "日本\n語", "𝔘𝔫\n𝔦", "\r\n x\r", "x" * 3000 + "\n" + "é" * 200, "$1 \\ $0\n{3}+\n"]
CLASH = ["digest", "n", "form", "output", "h", "v", "cluster", "distance", "hash", "fp", "set", "class", "window", "size", "words", "spans", "items"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def table(spark, texts, ids=None, id_column="doc_id"):
    rows = list(zip(ids if ids is not None else range(len(texts)), texts, strict=True))
    df = spark.createDataFrame(rows, f"{id_column} long, text string").repartition(3)
    return df.withColumns({c: F.lit(None).cast("string") for c in CLASH})


# ---------------------------------------------------------------- fill in the middle


def plain_fill(doc_id, text, unit=fill_middle.LINE, seed=7, rate=100, spm_rate=50, tokens=("<P>", "<S>", "<M>")):
    text, (p, s, m) = text or "", tokens
    units = [x.group() for x in re.finditer(unit, text)]
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(t in text for t in tokens) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm_rate:
        return len(units), "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle
    return len(units), "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle


def filled(df, **options):
    made = fill_middle.fill_middle(df, **options)
    tokens = options.get("tokens", fill_middle.TOKENS)
    return [(r.doc_id, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output), r.back)
            for r in made.withColumn("back", fill_middle.restored("form", "output", tokens)).collect()]


def test_fill_middle(spark):
    rng = random.Random(5)
    texts = [*ODD, "a <P> b\nc", "<S>", "x\n<M", "<\nP>\n", "<P\n><S\n>"]
    texts += ["".join(rng.choice(["a", "é", "𝔘", "<", ">", "P", "S", "M", "\n", "\n", " ", "$", "\\"]) for _ in range(rng.randrange(60))) for _ in range(200)]
    got = filled(table(spark, texts))
    assert Counter((i, made) for i, made, _ in got) == Counter((i, plain_fill(i, t)) for i, t in enumerate(texts))
    assert all(back == (texts[i] or "") for i, _, back in got)
    assert {made[1] for _, made, _ in got} == {"plain", "spm", "psm"}


def test_fill_middle_options(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab $\\\n") for _ in range(30)) for _ in range(60)]
    options = dict(unit=r"\S+\s*|\s+", seed=3, rate=60, spm_rate=20, tokens=("$p\\", "$s1", "$m]"))
    got = filled(table(spark, texts), **options)
    assert {i: made for i, made, _ in got} == {i: plain_fill(i, t, **options) for i, t in enumerate(texts)}
    assert all(back == texts[i] for i, _, back in got)
    with pytest.raises(ValueError):
        fill_middle.fill_middle(table(spark, []), tokens=("<P>", "><S", "<M>"))


def test_fill_middle_long_texts(spark):
    """A million lines, and lines of millions of characters: the engine must not recurse per unit or character."""
    texts = ["x\n" * 1_000_000, "\n" * 1_500_000, "é" * 3_000_000, ("y" * 1_000_000 + "\n") * 3 + "z" * 2_000_000]
    got = filled(table(spark, texts))
    assert {i: made for i, made, _ in got} == {i: plain_fill(i, t) for i, t in enumerate(texts)}
    assert all(back == texts[i] for i, _, back in got)


def test_fill_middle_repeated_and_null_ids(spark):
    assert filled(table(spark, [])) == []
    rows = [(3, "a\nb\nc"), (3, "d\ne"), (3, "d\ne"), (None, "f\ng")]
    got = Counter((i, made) for i, made, _ in filled(table(spark, [t for _, t in rows], [i for i, _ in rows])))
    assert got == Counter((i, plain_fill(i, t)) for i, t in rows)


# ---------------------------------------------------------------- clustering


def plain_clusters(rows, k, rounds, scale=64, dimensions=8):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centers = [v for _, v in named[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        centers = [[sum(x) // len(x) for x in zip(*[v for (_, v), o in zip(kept, own, strict=True) if o == n], strict=True)] if n in own else c
                   for n, c in enumerate(centers)]
    found = [(i, *nearest(v)) for i, v in kept]
    per = Counter()
    for _, d, n in found:
        per[n] += d
    return Counter((i, n, d, per[n], sum(per.values()), hashlib.sha256(",".join(map(str, centers[n])).encode()).hexdigest()) for i, d, n in found)


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return df.withColumns({c: F.lit(None).cast("string") for c in CLASH})


BAD = [(900, None), (901, [float("nan")] * 8), (902, [None] + [0.0] * 7), (903, [float("-inf")] * 8), (904, [0.5] * 3), (905, []), (906, [1.0] * 9)]


@pytest.mark.parametrize("block", [1, 2, 3, 8])
def test_clusters(spark, block, monkeypatch):
    monkeypatch.setattr(centroids, "CHUNK", 50)
    rng = np.random.default_rng(block)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(0, 0.4, (300, 8)).astype(np.float32))]
    rows += [(300 + i, rows[7][1]) for i in range(120)] + [(5, rows[9][1]), (5, rows[9][1]), (None, rows[3][1]), (None, [1e5] * 8)] + BAD
    got = centroids.cluster(vectors(spark, rows), clusters=6, rounds=4, dimensions=8, block=block).collect()
    assert Counter(tuple(r) for r in got) == plain_clusters(rows, 6, 4)


def test_clusters_that_stay_empty_and_few_vectors(spark):
    same = [(i, [0.5] * 8) for i in range(20)]
    got = centroids.cluster(vectors(spark, same), clusters=4, dimensions=8).collect()
    assert Counter(tuple(r) for r in got) == plain_clusters(same, 4, 3) and {r.cluster for r in got} == {0}
    few = [(1, [0.1] * 8), (2, [-0.1] * 8)]
    assert Counter(tuple(r) for r in centroids.cluster(vectors(spark, few), dimensions=8).collect()) == plain_clusters(few, 16, 3)
    for rows in ([], BAD):
        empty = centroids.cluster(vectors(spark, rows), dimensions=8)
        assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and empty.collect() == []
    with pytest.raises(PySparkException):
        centroids.cluster(vectors(spark, [(1, [1e30] * 8)]), dimensions=8)


def test_dictionaries_lose_nothing():
    rng = np.random.default_rng(4)
    chunk = rng.integers(-(1 << 24), 1 << 24, (500, 7))
    chunk[::3] = chunk[0]
    entries, codes = centroids.encode_chunk(chunk, 3)
    parts, again = centroids.decode_row([len(e) for e in entries], b"".join(e.astype(np.int32).tobytes() for e in entries), codes.tobytes(), 7, 3)
    assert np.array_equal(np.concatenate([p[c] for p, c in zip(parts, again, strict=True)], axis=1), chunk)
    assert all(len(np.unique(e, axis=0)) == len(e) for e in entries)


# ---------------------------------------------------------------- decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_contaminated(docs, items, window=10, shingle=3, share=1.0):
    asked = {}
    for item, text in items:
        w = plain_words(text)
        for at in range(max(1, len(w) - window + 1) if w else 0):
            asked.setdefault(tuple(w[at : at + window]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for part, names in asked.items():
            n, s = len(part), min(shingle, len(part))
            for at in range(len(w) - n + 1):
                same = sum(tuple(w[at + i : at + i + s]) == part[i : i + s] for i in range(n - s + 1))
                if same >= -(-(n - s + 1) * share // 1):
                    hit |= set(range(at, at + n))
                    found |= names
        spans = [(i, next(j for j in range(i, len(w) + 1) if j not in hit)) for i in sorted(hit) if i - 1 not in hit]
        out.append((doc_id, len(w), len(hit), tuple(sorted(str(n) for n in found if n is not None)), bool(hit), spans))
    return out


def checked(spark, docs, items, **options):
    found = decontamination.contaminated(
        table(spark, [t for _, t in docs], [i for i, _ in docs]), table(spark, [t for _, t in items], [i for i, _ in items], "item_id"), **options)
    got = [(r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated, [tuple(x) for x in r.spans]) for r in found.collect()]
    want = plain_contaminated(docs, items, **options)
    assert sorted(got, key=str) == sorted(want, key=str)
    return got


def prose(rng, n, vocabulary=60):
    return [rng.choice(["Ab", "ÄB", "x9", "日本", "it"]) + str(rng.randrange(vocabulary)) for _ in range(n)]


@pytest.mark.parametrize("share", [1.0, 0.6])
def test_decontamination(spark, share):
    rng = random.Random(8)
    items = [(i, " ".join(prose(rng, n))) for i, n in enumerate([30, 12, 10, 9, 2, 1, 25, 25, 0])]
    items += [(9, items[0][1]), (9, items[1][1].upper()), (None, items[6][1]), (10, None), (11, "-- !!"), (4, items[4][1])]
    docs = [(i, t) for i, t in enumerate([*ODD, *(" ".join(prose(rng, rng.randrange(80))) for _ in range(60))])]
    for i in range(60):
        own = plain_words(items[rng.randrange(9)][1])
        a = rng.randrange(len(own) + 1)
        own = own[a:] if rng.random() < 0.4 else own
        if own and rng.random() < 0.5:
            own[rng.randrange(len(own))] = "other"
        docs.append((100 + i, " ".join(prose(rng, rng.randrange(20))) + ". " + " -\n".join(own) + "! " + " ".join(prose(rng, rng.randrange(20)))))
    docs += [(7, items[0][1]), (7, items[0][1]), (None, items[1][1]), (None, "nothing here")]
    got = checked(spark, docs, items, share=share)
    assert sum(c for *_, c, _ in got) > 40


def test_decontamination_with_a_shared_passage_and_shuffled_join(spark, monkeypatch):
    """One passage in most documents and most items; prefixes joined by shuffle, shingles passed by a small bit table."""
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(common, "BITS", 64 * 4)
    rng = random.Random(9)
    line = " ".join(prose(rng, 14))
    items = [(i, " ".join(prose(rng, 6)) + " " + line) for i in range(40)]
    docs = [(i, " ".join(prose(rng, 15)) + " " + line + " " + " ".join(prose(rng, 15))) for i in range(120)]
    got = checked(spark, docs, items)
    assert all(len(names) == 40 for _, _, _, names, _, _ in got)


def test_decontamination_empty_tables_and_short_windows(spark):
    docs, items = [(1, "a b c"), (2, None)], [(1, "b c"), (2, "c")]
    assert checked(spark, docs, [])[0][4] is False
    assert checked(spark, [], items) == []
    assert checked(spark, docs, items, window=2, shingle=1)
    with pytest.raises(ValueError):
        decontamination.contaminated(table(spark, []), table(spark, [], id_column="item_id"), share=0)


def test_decontamination_long_texts(spark):
    """Words and texts beyond the sizes at which hashing goes by parts."""
    rng = random.Random(10)
    long = "q" * 70_000
    items = [(1, " ".join([*prose(rng, 6), long, *prose(rng, 8)]))]
    docs = [(1, items[0][1]), (2, long), (3, " ".join([*prose(rng, 3000), items[0][1], *prose(rng, 3000)])), (4, items[0][1].replace("qq", "qr", 1))]
    assert [c for *_, c, _ in sorted(checked(spark, docs, items))] == [True, False, True, False]


def test_hashes_do_not_depend_on_how_many_words_go_at_once(monkeypatch):
    words = decontamination.Words(pa.array(["Ab, cd\u00c4 e", None, "", "ab x", "-"]))
    whole = words.hashes()
    assert whole[0] == whole[3] and len(set(whole.tolist())) == 4
    monkeypatch.setattr(decontamination, "_WORDS_AT_ONCE", 2)
    assert np.array_equal(words.hashes(), whole)


# ---------------------------------------------------------------- parts of earlier operators


def test_multikey_quicksort_orders_and_groups():
    rng = np.random.default_rng(1)
    for _ in range(300):
        rows = rng.integers(0, rng.integers(1, 7), (int(rng.integers(0, 60)), 5)).astype(np.uint64)
        deepest = int(rng.integers(1, 6))
        order, begin = suffix_dedup.multikey_quicksort(rows, deepest)
        got = [tuple(r) for r in rows[order][:, :deepest].tolist()]
        assert got == sorted(map(tuple, rows[:, :deepest].tolist()))
        assert begin.tolist() == [i for i in range(len(got)) if i == 0 or got[i] != got[i - 1]]


def test_groups_verified_at_once_give_what_one_gives():
    rng = np.random.default_rng(2)
    wide, hits = passages._WIDE, 0

    def members(n):
        base = rng.integers(1, 1 << 31, (3, wide)).astype(np.uint32) | 1
        out = base[rng.integers(0, 3, n)].copy()
        for row in out:
            row[rng.integers(0, wide, rng.integers(0, 14))] = rng.integers(1, 1 << 31) | 1
            if rng.random() < 0.3:
                row[rng.integers(0, wide):] = 0
            if rng.random() < 0.3:
                row[:] = np.roll(row, rng.integers(-2, 3))
        return out

    for size in range(2, 8):
        groups = np.stack([members(size) for _ in range(40)])
        together = {x for leader, *found in passages.verify_groups(groups) for x in zip(*(c.tolist() for c in found), [leader] * len(found[0]), strict=True)}
        alone = {(g, f, lo, hi, leader) for g in range(40) for leader, *found in passages.verify_group(groups[g])
                 for f, lo, hi in zip(*(c.tolist() for c in found), strict=True)}
        assert together == alone
        hits += len(alone)
    assert hits > 200


def test_language_of_a_long_text_by_stretches():
    """Word scores by stretches equal those of the whole, and paths of the bounded form those of plain Viterbi."""
    rng = np.random.default_rng(3)
    text = " ".join("".join(rng.choice(list("abcdeäöß日 -1"), 9)) for _ in range(3000))
    words = langid.words_of([text, "", "x " + text])
    whole = [sorted(zip(*(c.tolist() for c in langid.gram_buckets(words)), strict=True))]
    by_part = []
    for a, b, part in langid.parts(words, 500):
        grams, owner = langid.gram_buckets(part)
        by_part += zip(grams.tolist(), (owner + a).tolist(), strict=True)
        assert part.start[0] == 1 and b - a == len(part.start)
    assert [sorted(by_part)] == whole
    for _ in range(300):
        scores = rng.normal(0, rng.choice([0.5, 3, 8]), (int(rng.integers(1, 30)), int(rng.integers(1, 4))))
        got = langid.viterbi(scores, 5.0)
        best = np.zeros(scores.shape[1])
        for i, row in enumerate(scores):
            best = row + (np.maximum(best, best.max() - 5.0) if i else best)
        worth = scores[np.arange(len(got)), got].sum() - 5.0 * np.count_nonzero(np.diff(got))
        assert worth == pytest.approx(best.max())
