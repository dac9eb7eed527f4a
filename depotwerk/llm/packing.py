"""Best-fit-decreasing packing of token sequences.

The order of best-fit decreasing depends on lengths only, and there are at most
``capacity`` different ones.  So the plan is made for lengths with their counts:
longest first, each into the tightest open sequence that takes it, which a
segment tree over the remaining capacities finds in logarithmic time.  Equal
sequences are kept as intervals of sequence numbers, so the plan's size depends
on the capacity and not on the number of documents.  Each document then
computes its own place from its rank among the documents of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, as_bytes, blocks, shuffle_partitions, word_bounds, written

CAPACITY = 2048
CACHED_WORDS = 500_000  # words of a generation; a worker keeps two

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bucket int"


# ---------------------------------------------------------------- tokens


_CUTS = np.zeros(256, bool)  # bytes that words are cut at
_CUTS[[0x20, 0x09, 0x0A, 0x0D]] = True


_MARKS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"  # ASCII marks other than those of contractions and special tokens


def _ends_in_letter(word: bytes) -> bool:
    """Whether the last character is a Latin letter that stays one letter in lower case (that of İ ends in a mark)."""
    if word[-1:].isalpha():  # ASCII
        return True
    last = word[-4:].decode(errors="ignore")[-1:]
    return last.isalpha() and last < "\u0250" and len(last.lower()) == 1


def _lowered(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The texts with A-Z in lower case, where the tokenizer's own steps then give the same.

    Not in texts with characters from U+0300 on, whose marks compose with
    small letters that have no capital, or with the beginning of a special token.
    """
    odd = data >= 0xCC
    odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    low = LOWER[data]
    for text in np.unique(np.searchsorted(at, np.flatnonzero(odd), side="right") - 1).tolist():
        low[at[text] : at[text + 1]] = data[at[text] : at[text + 1]]
    return low


class WordTokens:
    """Ids of texts by a tokenizer that never joins across white space, with the ids of words remembered.

    Words are cut at the four commonest white-space characters only; whatever
    else the tokenizer treats as a boundary stays inside a word and is left to
    it, special tokens named in the text included.  Words are remembered in two generations: when the younger is full it
    becomes the older, and words met again move to the younger.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cached = cached
        self.known: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}

    def ids(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Per text its ids as little-endian 32-bit numbers."""
        data, at = as_bytes(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        data = _lowered(data, at)
        start, end, first = word_bounds(data, at, _CUTS)
        ends = np.r_[0, np.cumsum(end - start)]
        words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data[~_CUTS[data]])])
        coded = words.dictionary_encode()  # each word of the texts is looked up once
        parts = self._of_words(coded.dictionary.to_pylist())
        size = np.array([len(p) // 4 for p in parts], np.int64)
        flat, begin, index = np.frombuffer(b"".join(parts), "<u4"), np.cumsum(size) - size, coded.indices.to_numpy()
        n = size[index]
        edge = np.r_[0, np.cumsum(n)]
        found = flat[np.repeat(begin[index] - edge[:-1], n) + np.arange(edge[-1])]
        bounds = edge[first].tolist()
        return [found[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def _of_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of different words."""
        known, older = self.known, self.older
        missing = [word for word in words if word not in known]
        if len(known) + len(missing) > self.cached:
            older, known, missing = known, {b"": b""}, [word for word in words if word]
            self.older, self.known = older, known
        new, ended = set(), []
        for word in missing:
            ids = older.get(word)
            if ids is not None:
                known[word] = ids
                continue
            if word[-1] in _MARKS and b"'" not in word:
                # marks after a letter are a part of their own (contractions left aside)
                stem = word.rstrip(_MARKS)
                if _ends_in_letter(stem):
                    marks = word[len(stem):]
                    ended.append((word, stem, marks))
                    new.update(part for part in (stem, marks) if part not in known)
                    continue
            new.add(word)
        self._learn(list(new))
        for word, stem, marks in ended:
            known[word] = known[stem] + known[marks]
        return [known[word] for word in words]

    def _learn(self, words: list[bytes], at_once: int = 2000) -> None:
        for i in range(0, len(words), at_once):
            some = words[i : i + at_once]
            coded = self.tokenizer.encode([w.decode() for w in some], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(coded.ids, "<u4")
            owner = np.array([-1 if w is None else w for w in coded.word_ids], np.int64)
            bounds = np.searchsorted(owner, np.arange(len(some) + 1)).tolist()
            raw = ids.tobytes()
            for j, word in enumerate(some):
                self.known[word] = raw[4 * bounds[j] : 4 * bounds[j + 1]]


@cache
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0,
    *, id_column: str = "doc_id", text_column: str = "text", buckets: int = 1,
) -> DataFrame:
    """The ids of each document and ``end_id``, cut after every ``capacity`` ids: one row per piece.

    A null or empty text is ``end_id`` alone.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"),
        F.pmod(F.xxhash64(id_column, F.crc32(F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary"))), F.lit(buckets)).cast("int").alias("bucket"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer_path)
        for block in blocks(batches, "text"):
            out = []
            ids, where = block.column("doc_id").to_pylist(), block.column("bucket").to_pylist()
            texts = tokens.ids(block.column("text"))
            for doc, bucket, raw in zip(ids, where, texts, strict=True):
                raw += end
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    out.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part), bucket))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "bucket"])

    return rows.mapInArrow(run, _PIECES)


# ---------------------------------------------------------------- plan


class _Tightest:
    """Segment tree over remaining capacities: the smallest one >= x that open sequences have."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, level: int, there: bool) -> None:
        node = level + self.leaves
        self.any[node] = there
        node //= 2
        while node:
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]
            node //= 2

    def at_least(self, level: int) -> int | None:
        node = level + self.leaves
        if self.any[node]:
            return level
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where the documents of each length go: (length, first rank, documents, first sequence, per sequence, offset).

    Document ``rank`` of the length goes to sequence ``first + (rank - first
    rank) // per`` at ``offset + length * ((rank - first rank) % per)``.
    """
    tree, open_at, plan, next_sequence = _Tightest(capacity), {}, [], 0

    def put(level: int, first: int, n: int) -> None:
        if n and level:
            open_at.setdefault(level, []).append((first, n))
            tree.set(level, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            level = tree.at_least(length)
            if level is None:  # new sequences
                per = capacity // length
                n = -(-left // per)
                put(capacity, next_sequence, n)
                next_sequence += n
                continue
            first, n = open_at[level].pop()
            if not open_at[level]:
                tree.set(level, False)
            per = level // length  # after one document the same sequence is the tightest again, while it fits
            whole = min(n, left // per)
            if whole:
                plan.append((length, rank, whole * per, first, per, capacity - level))
                put(level - per * length, first, whole)
                rank, left = rank + whole * per, left - whole * per
            if whole < n and left and left < per:
                plan.append((length, rank, left, first + whole, left, capacity - level))
                put(level - left * length, first + whole, 1)
                rank, left, whole = rank + left, 0, whole + 1
            put(level, first + whole, n - whole)
    return plan


# ---------------------------------------------------------------- placing


def pack(pieces: DataFrame, capacity: int = CAPACITY, *, buckets: int | None = None) -> DataFrame:
    """``pieces`` with sequence_id and offset; needs doc_id, piece, length, ids_crc32 and bucket.

    Counts per length (at most ``capacity`` rows) are all that reaches the
    driver.  Ranks are computed per (length, bucket) and shifted by the sizes of
    the buckets before, so documents of one common length do not meet in a task.
    """
    counts = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = sorted((-length, rank, n, first, per, offset) for length, rank, n, first, per, offset in best_fit_plan(totals, capacity))
    steps = np.array(plan, np.int64).reshape(-1, 6)

    before = counts.select(
        "length", "bucket",
        (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        pieces.withColumn("place", F.row_number().over(own) - 1)
        .join(before, ["length", "bucket"])
        .select(*[c for c in pieces.columns if c != "bucket"], (F.col("before") + F.col("place")).alias("place")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # plan rows are ordered by (-length, first rank): one number per row finds the last at or below
        keys = steps[:, 0] * (1 << 40) + steps[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("place").to_numpy()
            step = steps[np.searchsorted(keys, -length * (1 << 40) + rank, side="right") - 1]
            i = rank - step[:, 1]
            keep = [n for n in batch.schema.names if n != "place"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in keep], pa.array(step[:, 3] + i // step[:, 4]), pa.array(step[:, 5] + length * (i % step[:, 4]))],
                names=[*keep, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "place")
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, **names: str) -> DataFrame:
    """Tokenise and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    buckets = shuffle_partitions(docs.sparkSession)
    pieces = written(token_pieces(docs, tokenizer_path, capacity, buckets=buckets, **names))
    return pack(pieces, capacity)
