"""Benchmark decontamination by a prefix-filtered join of word shingles.

A benchmark item is cut into windows of some consecutive words, a window into
shingles of a few words.  Shingles are ordered by rarity: how often each
occurs in all documents.  A window that must be contained whole needs only its
rarest shingle looked up (its prefix); if ``share`` of its shingles is enough,
one more for each that may be missing.  A document's hit on a prefix shingle
fixes where the window would begin, so the window must fit between the first
and the last word (positional and length bounds), and is then compared word by
word.

Documents are read twice: once to count the shingles that the benchmark has,
once for the hits on prefix shingles with the words around them.  A bit table
of fixed size keeps other shingles from leaving the task; it lets a few pass
wrongly and more of them for a large benchmark, and the joins that follow are
exact.  Hot shingles: the prefix table is broadcast if its measured size
allows, and otherwise every key is joined in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup, split_hot_join
from .common import LOWER, Passing, Prefixes, as_bytes, bit_table, blocks, mix, word_bounds, written

WINDOW = 10  # words of an item that stand together
SHINGLE = 3  # words
BROADCAST_BYTES = 64 << 20  # of the prefix table, measured

_BETWEEN = np.zeros(256, bool)  # bytes outside words: ASCII other than digits and letters
_BETWEEN[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
_BLOCK = 2 << 20
_ROWS = 4096  # of a batch that holds words
_WORDS_AT_ONCE = 1 << 18
_LONG_WORD = 1 << 16


# ---------------------------------------------------------------- words and shingles


def runs_of(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` consecutive words, from the hashes of the words."""
    n = max(0, len(words) - size + 1)
    runs = np.full(n, size, np.uint64)
    for j in range(size):
        runs += mix(words[j : j + n] + np.uint64(0x9E3779B97F4A7C15 * (j + 1) % (1 << 64)))
    return mix(runs)


class Words:
    """The words of a block of texts, lower-cased, one after another."""

    def __init__(self, values: pa.Array):
        data, at = as_bytes(values)
        self.data = LOWER[data]
        self.start, self.end, self.first = word_bounds(self.data, at, _BETWEEN)
        self.counts = np.diff(self.first)

    def ranges(self) -> list[tuple[int, int]]:
        """First word and end of each text."""
        return list(zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word; memory depends on some words at once, not on the text."""
        out = np.empty(len(self.start), np.uint64)
        long = np.flatnonzero(self.end - self.start > _LONG_WORD)
        edges = np.unique(np.r_[0, long, long + 1, np.arange(0, len(out), _WORDS_AT_ONCE), len(out)])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            low, high = int(self.start[a]), int(self.end[b - 1])
            if b == a + 1 and high - low > _LONG_WORD:
                out[a] = xxhash.xxh64_intdigest(self.data[low:high].tobytes())
            else:
                out[a:b] = Prefixes(self.data[low:high]).of(self.start[a:b] - low, self.end[a:b] - low)
        return out

    def shingles(self, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``size`` words from each word on, and whether they lie in one text."""
        text = np.repeat(np.arange(len(self.counts)), self.counts)
        runs = runs_of(words, size)
        return runs, text[: len(runs)] == text[size - 1 : size - 1 + len(runs)]

    def spoken(self, a: int, b: int) -> str:
        """The words from ``a`` to ``b`` with single spaces."""
        return b" ".join([self.data[s:e].tobytes() for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist(), strict=True)]).decode(errors="replace")


# ---------------------------------------------------------------- benchmark


def _spoken(items: DataFrame) -> DataFrame:
    """(item_id, words): the item's words with single spaces; items without words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", _BLOCK):
            words = Words(block.column("text"))
            spoken = [words.spoken(a, b) for a, b in words.ranges()]
            yield pa.RecordBatch.from_arrays([block.column("item_id"), pa.array(spoken, pa.string())], names=["item_id", "words"])

    return items.mapInArrow(run, "item_id string, words string").where("words <> ''")


def _windows(classes: DataFrame, window: int, shingle: int) -> DataFrame:
    """(class, window, size, shingle, hashes): every window of every class, with the hashes of its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", _BLOCK):
            words = Words(block.column("text"))
            hashed = words.hashes()
            for name, (a, b) in zip(block.column("class").to_pylist(), words.ranges(), strict=True):
                size = min(window, b - a)
                own = min(shingle, size)
                runs = runs_of(hashed[a:b], own).view(np.int64)
                for at in range(a, b - size + 1, _ROWS):
                    some = range(at, min(at + _ROWS, b - size + 1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(some)), pa.array([words.spoken(i, i + size) for i in some]),
                         pa.array([size] * len(some), pa.int32()), pa.array([own] * len(some), pa.int32()),
                         pa.array([runs[i - a : i - a + size - own + 1] for i in some], pa.list_(pa.int64()))],
                        names=["class", "window", "size", "shingle", "hashes"])

    return classes.mapInArrow(run, "class string, window string, size int, shingle int, hashes array<long>")


# ---------------------------------------------------------------- documents


def _counted(sizes: list[int], passing: Broadcast):
    """(hash, n) of the shingles that the table lets pass, added up per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = Passing(passing.value)
        for block in blocks(batches, "text", _BLOCK):
            words = Words(block.column("text"))
            hashed = words.hashes()
            for size in sizes:
                runs, inside = words.shingles(hashed, size)
                met, n = np.unique(runs[inside & may(runs)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(met.view(np.int64)), pa.array(n)], names=["hash", "n"])

    return run


_HITS = "doc_id long, fp long, n_words long, hash long, at long, begin long, context string"


def _found(sizes: list[int], passing: Broadcast, reach: int):
    """A row per document without hash, and one per hit of a prefix shingle with up to ``reach`` words around its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = Passing(passing.value)
        for block in blocks(batches, "text", _BLOCK):
            words = Words(block.column("text"))
            yield _rows(block, words.counts, np.arange(block.num_rows), None, None, None, None)
            hashed = words.hashes()
            for size in sizes:
                runs, inside = words.shingles(hashed, size)
                hits = np.flatnonzero(inside & may(runs))
                for i in range(0, len(hits), _ROWS):
                    some = hits[i : i + _ROWS]
                    text = np.searchsorted(words.first, some, side="right") - 1
                    low = np.maximum(words.first[text], some - reach + 1)
                    high = np.minimum(words.first[text + 1], some + reach)
                    context = [words.spoken(a, b) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                    yield _rows(block, words.counts, text, runs[some].view(np.int64), some - words.first[text], low - words.first[text], context)

    return run


def _rows(block: pa.RecordBatch, counts: np.ndarray, text: np.ndarray, *values) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = [pa.nulls(len(text), k) if v is None else pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(
        [block.column("doc_id").take(pa.array(text)), block.column("fp").take(pa.array(text)), pa.array(counts[text], pa.int64()), *columns],
        names=["doc_id", "fp", "n_words", "hash", "at", "begin", "context"])


# ---------------------------------------------------------------- the join


def _prefixes(windows: DataFrame, counts: DataFrame, share: float) -> DataFrame:
    """Per window its rarest shingles, as many as must be looked up; shingles no document has cannot be hit."""
    many = F.col("size") - F.col("shingle") + 1
    need = F.ceil(many * F.lit(share)).cast("int")
    shingles = windows.select("window", "size", "shingle", "set", need.alias("need"), (many - need + 1).alias("prefix"),
                              F.posexplode("hashes").alias("offset", "hash"))
    ranked = lookup(shingles, counts, ["hash"], spread_by=["window", "offset"]).withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = Window.partitionBy("window").orderBy("n", "hash", "offset")
    return ranked.withColumn("rank", F.row_number().over(rarest)).where("rank <= prefix and n > 0").select(
        "hash", "offset", "window", "size", "shingle", "need", "set")


def _verified(hits: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(doc_id, fp, start, size, set): windows that stand in a document."""
    width = prefixes.agg(F.sum(F.octet_length("window") + 128)).first()[0] or 0
    if width <= BROADCAST_BYTES:
        met = hits.join(F.broadcast(prefixes), "hash")
    else:
        met = split_hot_join(hits, prefixes, ["hash"], spread_by=["doc_id", "fp", "at"], how="inner")
    placed = met.withColumn("start", F.col("at") - F.col("offset")).where("start >= 0 and start + size <= n_words")
    compared = placed.withColumns({
        "there": F.slice(F.split("context", " "), (F.col("start") - F.col("begin") + 1).cast("int"), F.col("size")),
        "asked": F.split("window", " ")})

    def same(i: Column) -> Column:
        return F.slice("there", i + 1, F.col("shingle")) == F.slice("asked", i + 1, F.col("shingle"))

    equal = F.size(F.filter(F.sequence(F.lit(0), F.col("size") - F.col("shingle")), same))
    return compared.where(equal >= F.col("need")).select("doc_id", "fp", "start", "size", "set")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, shingle: int = SHINGLE, share: float = 1.0,
    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, items, spans, contaminated: one row per document.

    Words are runs of digits, letters and all characters beyond ASCII, with
    A-Z lower-cased.  A window is ``window`` consecutive words of an item, or
    all words of an item with fewer; a place in a document counts as an
    occurrence if at least ``share`` of the window's shingles stand there, in
    their places (1.0: the window itself).  ``items`` are the ids, as sorted
    strings, of items with a window that occurs; ``spans`` the runs of words
    (start, end) inside occurrences; ``n_hit`` their words.

    Null texts have no words.  Rows that repeat an id are kept, each with the
    result of its own text; null ids too.  An item id that is repeated counts
    once, a null item id is left out of ``items`` though its windows count.
    Only the columns named are read.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0, at most 1")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("fp"))
    items = benchmark.select(F.col(item_column).cast("string").alias("item_id"), F.col(item_text_column).cast("string").alias("text"))

    # items with the same words are one class, windows with the same classes one set
    spoken = written(_spoken(items).withColumn("class", F.sha2("words", 256)))
    classes = spoken.select("class", F.col("words").alias("text")).dropDuplicates(["class"])
    windows = written(
        _windows(classes, window, shingle).groupBy("window", "size", "shingle", "hashes")
        .agg(F.sort_array(F.collect_set("class")).alias("classes"))
        .withColumn("set", F.sha2(F.array_join("classes", ","), 256)))
    sizes = sorted(r.shingle for r in windows.select("shingle").distinct().collect())  # ``shingle`` numbers at most

    asked = spark.sparkContext.broadcast(bit_table(windows.select(F.explode("hashes").alias("hash"))))
    counts = written(docs.mapInArrow(_counted(sizes, asked), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")))
    prefixes = written(_prefixes(windows, counts, share))
    looked_up = spark.sparkContext.broadcast(bit_table(prefixes.select("hash")))
    rows = written(docs.select("doc_id", "fp", "text").mapInArrow(_found(sizes, looked_up, window), _HITS))

    # one shuffle by document serves the distinct places, the runs and the sums
    places = _verified(rows.where("hash is not null"), prefixes).repartition("doc_id", "fp").dropDuplicates()
    by_place = Window.partitionBy("doc_id", "fp").orderBy("start", "size", "set")
    before = by_place.rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        places.withColumn("end", F.col("start") + F.col("size"))
        .withColumn("new", F.when(F.col("start") > F.coalesce(F.max("end").over(before), F.lit(-1)), 1).otherwise(0))
        .withColumn("run", F.sum("new").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "fp", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.collect_set("set").alias("sets"))
    )
    found = written(
        runs.groupBy("doc_id", "fp")
        .agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"),
             F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"),
             F.array_sort(F.array_distinct(F.flatten(F.collect_list("sets")))).alias("sets"))
        .withColumn("signature", F.sha2(F.array_join("sets", ","), 256)))

    # documents with the same sets share one list of items
    listed = (
        found.select("signature", "sets").dropDuplicates(["signature"])
        .select("signature", F.explode("sets").alias("set"))
        .join(windows.select("set", "classes").dropDuplicates(["set"]), "set")
        .select("signature", F.explode("classes").alias("class")).distinct()
        .join(spoken.select("class", "item_id").distinct(), "class")
        .groupBy("signature").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    heads = rows.where("hash is null").select("doc_id", "fp", "n_words").alias("d")
    results = found.join(listed, "signature", "left").alias("f")
    none = F.array().cast("array<string>")
    return heads.join(results, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.fp") == F.col("f.fp")), "left").select(
        "d.doc_id", "d.n_words", F.coalesce("f.n_hit", F.lit(0)).alias("n_hit"), F.coalesce("f.items", none).alias("items"),
        F.coalesce("f.spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
        F.col("f.n_hit").isNotNull().alias("contaminated"))
