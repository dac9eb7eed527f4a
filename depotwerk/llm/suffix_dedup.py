"""Removal of repeated substrings through a sparse suffix array, sorted deep and shallow.

A window is a string of ``LENGTH`` bytes.  A byte goes if a window covering it
also starts earlier (smaller document, or same document and earlier start).

Sorting every suffix of a corpus would move a hundred times its size.  Equal
windows hold the same smallest GRAM-byte hash, so neighbouring windows that
share it (a run) are handled together:

1. Runs are grouped by that hash and compared as a whole.  Of runs with equal
   content all but the first repeat in full.  Runs whose hash nobody shares
   are unique and done.  What is left are the first runs of each content that
   share a hash with other content: the edges of repeated passages.
2. Their windows are the suffixes that are sorted.  They are cut into pieces
   by the distance to the smallest hash and grouped by the bytes all windows
   of a piece have in common; pieces that are alone are unique.  In each group
   multikey quicksort by eight-byte characters orders suffixes to a shallow
   depth, and blind tries order the groups with a longer common prefix.
   Neighbours that agree in all LENGTH bytes are equal; all but the first repeat.

Content that repeats within a block of a task is resolved there, so a passage
in a third of all documents reaches a reducer once per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from .common import Prefixes, as_bytes, blocks, leftmost_anchor, mix, window_anchors, window_extremes, written

LENGTH = 100
GRAM = 40
SLICE = 16  # windows of a piece
SHALLOW = 4  # eight-byte characters the multikey sort looks at
_REACH = LENGTH - GRAM + 1  # hashes in a window
_BLOCK = 2 << 20
_SUFFIXES = 1 << 16  # sorted at once, if groups allow

_FOUND = "tag int, key long, u long, uid long, p long, n int"
_MARKS = "tag int, uid long, p long, n int"
MARK, RUN, REST = 0, 1, 2


# ---------------------------------------------------------------- runs of windows


class Runs:
    """Runs of windows with one smallest hash in a block of texts."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at = data, at
        self.prefix = Prefixes(data)
        n = len(data) - GRAM + 1
        if len(data) < LENGTH:
            self.hashes = self.low = np.zeros(0, np.uint64)
            self.start = self.stop = self.doc = np.zeros(0, np.int64)
            self.tied = np.zeros(0, bool)
            return
        place = np.arange(n)
        self.hashes = self.prefix.of(place, place + GRAM)
        self.low = low = window_extremes(self.hashes, _REACH)
        doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
        inside = place[: len(low)] + LENGTH <= at[1:][doc[: len(low)]]
        other = np.ones(len(low), bool)
        other[1:] = (low[1:] != low[:-1]) | (doc[1 : len(low)] != doc[: len(low) - 1]) | ~inside[:-1]
        self.start = np.flatnonzero(inside & other)
        last = inside.copy()
        last[:-1] &= other[1:] | ~inside[1:]
        self.stop = np.flatnonzero(last) + 1
        self.doc = doc[self.start]
        self.tied = self._tied()

    def _tied(self) -> np.ndarray:
        """Whether the smallest hash of a run stands in it more than once: then its own windows may be equal."""
        self.anchors = window_anchors(self.hashes, self.low, _REACH)
        lo = np.searchsorted(self.anchors, self.start)
        hi = np.searchsorted(self.anchors, self.stop - 1 + _REACH)
        size = hi - lo
        owner = np.repeat(np.arange(len(lo)), size)
        index = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + lo[owner]
        same = self.hashes[self.anchors[index]] == self.low[self.start[owner]]
        return np.bincount(owner[same], minlength=len(lo)) > 1

    def content(self) -> np.ndarray:
        return self.prefix.of(self.start, self.stop - 1 + LENGTH)


def _firsts(key: np.ndarray, u: np.ndarray, uid: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that come first among those with the same (key, u), and all other rows."""
    order = np.lexsort((p, uid, u, key))
    first = np.ones(len(order), bool)
    first[1:] = (key[order][1:] != key[order][:-1]) | (u[order][1:] != u[order][:-1])
    return order[first], order[~first]


def _joined(uid: np.ndarray, p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks with adjacent ones of a document made one."""
    if not len(uid):
        return uid, p, n
    order = np.lexsort((p, uid))
    uid, p, n = uid[order], p[order], n[order]
    new = np.ones(len(uid), bool)
    new[1:] = (uid[1:] != uid[:-1]) | (p[1:] > p[:-1] + n[:-1])
    begin = np.flatnonzero(new)
    return uid[begin], p[begin], np.maximum.reduceat(p + n, begin) - p[begin]


def _batch(tag: int, uid, p, n, key=None, u=None, data: list[bytes] | None = None) -> pa.RecordBatch:
    columns = {"tag": pa.array(np.full(len(uid), tag, np.int32))}
    if key is not None:
        columns |= {"key": pa.array(key.view(np.int64)), "u": pa.array(u.view(np.int64))}
    columns |= {"uid": pa.array(np.asarray(uid, np.int64)), "p": pa.array(np.asarray(p, np.int64)), "n": pa.array(np.asarray(n, np.int32))}
    if data is not None:
        columns["data"] = pa.array(data, pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def _spread(uid: np.ndarray, p: np.ndarray) -> np.ndarray:
    return mix(uid.astype(np.uint64) * np.uint64(31) + p.astype(np.uint64))


def _find_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text", _BLOCK):
        data, at = as_bytes(block.column("text"))
        runs = Runs(data, at)
        if not len(runs.start):
            continue
        key, u = runs.low[runs.start], runs.content()
        uid, p = block.column("uid").to_numpy()[runs.doc], runs.start - at[runs.doc]
        n = runs.stop - runs.start
        first, again = _firsts(key, u, uid, p)
        m_uid, m_p, m_n = _joined(uid[again], p[again], n[again])
        yield _batch(MARK, m_uid, m_p, m_n, _spread(m_uid, m_p), np.zeros(len(m_uid), np.uint64))
        yield _batch(RUN, uid[first], p[first], np.where(runs.tied[first], -n[first], n[first]), key[first], u[first])


def _compare_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, u, uid, p): marks of repeated runs, and first runs of content that shares its key.

    Holds the last row and the first run of the current key, whatever the size of a group.
    """
    last_key = last_u = None
    waiting: tuple | None = None  # first run of the key, until another content shows up
    for batch in batches:
        tag = batch.column("tag").to_numpy()
        mark = batch.filter(pa.array(tag == MARK))
        if mark.num_rows:
            yield mark.select(["tag", "uid", "p", "n"])
        rows = batch.filter(pa.array(tag == RUN))
        if not rows.num_rows:
            continue
        key, u, uid, p, n = (rows.column(c).to_numpy() for c in ("key", "u", "uid", "p", "n"))
        tied, n = n < 0, np.abs(n)
        new_key, new_u = np.ones(len(key), bool), np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        new_u[1:] = new_key[1:] | (u[1:] != u[:-1])
        if last_key is not None:
            new_key[0] = key[0] != last_key
            new_u[0] = new_key[0] or u[0] != last_u
        last_key, last_u = key[-1], u[-1]
        again = np.flatnonzero(~new_u)
        if len(again):
            yield _batch(MARK, *_joined(uid[again], p[again], n[again]))
        content = np.flatnonzero(new_u)
        if not len(content):
            continue
        opens = new_key[content]
        follows = np.zeros(len(content), bool)  # the next content has the same key
        follows[:-1] = ~opens[1:]
        emit = ~opens | follows | tied[content]
        if waiting is not None and not opens[0]:
            yield _batch(REST, *waiting)
        if opens.any() or waiting is not None and not opens[0]:
            waiting = None
        end = content[-1]
        if opens[-1] and not emit[-1]:
            waiting = (uid[[end]], p[[end]], n[[end]])
        chosen = content[emit]
        if len(chosen):
            yield _batch(REST, uid[chosen], p[chosen], n[chosen])


# ---------------------------------------------------------------- pieces and suffixes


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with the runs that are left: their windows in pieces, keyed by the bytes they have in common."""
    for block in blocks(batches, "text", _BLOCK):
        data, at = as_bytes(block.column("text"))
        runs = block.column("runs")
        size = np.diff(runs.offsets.to_numpy())
        flat = runs.flatten()
        doc = np.repeat(np.arange(block.num_rows), size)
        start = flat.field("p").to_numpy() + at[doc]
        count = flat.field("n").to_numpy().astype(np.int64)
        every = Runs(data, at)
        window = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
        window = np.unique(window)
        anchor = leftmost_anchor(every.hashes, every.anchors, every.low, window)
        part = (anchor - window) // SLICE
        new = np.ones(len(window), bool)
        new[1:] = (window[1:] != window[:-1] + 1) | (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])
        begin = np.flatnonzero(new)
        n = np.diff(np.r_[begin, len(window)])
        first = window[begin]
        core = anchor[begin] - part[begin] * SLICE
        key = every.prefix.of(core, core - SLICE + 1 + LENGTH)
        u = every.prefix.of(first, first + n - 1 + LENGTH)
        owner = np.searchsorted(at, first, side="right") - 1
        uid, p = block.column("uid").to_numpy()[owner], first - at[owner]
        keep, again = _firsts(key, u, uid, p)
        m_uid, m_p, m_n = _joined(uid[again], p[again], n[again])
        yield _batch(MARK, m_uid, m_p, m_n, _spread(m_uid, m_p), np.zeros(len(m_uid), np.uint64), [b""] * len(m_uid))
        raw = data.tobytes()
        text = [raw[a:b] for a, b in zip(first[keep].tolist(), (first + n - 1 + LENGTH)[keep].tolist(), strict=True)]
        yield _batch(RUN, uid[keep], p[keep], n[keep], key[keep], u[keep], text)


class BlindTrie:
    """Orders strings of one length by the positions of their first differing bits only.

    A string goes down the trie by the bits the nodes name, without looking at
    the bits between, to some leaf; the first bit in which it differs from that
    leaf's string says where it belongs.  Strings are whole numbers here, so that bit is
    the highest one of their exclusive or.
    """

    def __init__(self):
        self.root: list | None = None  # [bit, zero, one], or [-1, number, members]

    def insert(self, number: int, member: int) -> None:
        if self.root is None:
            self.root = [-1, number, [member]]
            return
        node = self.root
        while node[0] >= 0:
            node = node[2] if number >> node[0] & 1 else node[1]
        differ = number ^ node[1]
        if not differ:
            node[2].append(member)
            return
        bit = differ.bit_length() - 1
        parent, side, node = None, 0, self.root
        while node[0] > bit:
            side = 2 if number >> node[0] & 1 else 1
            parent, node = node, node[side]
        leaf = [-1, number, [member]]
        branch = [bit, node, leaf] if number >> bit & 1 else [bit, leaf, node]
        if parent is None:
            self.root = branch
        else:
            parent[side] = branch

    def groups(self) -> Iterator[list[int]]:
        """Members of equal strings, in the order of the strings."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] < 0:
                yield node[2]
            else:
                stack += [node[2], node[1]]


def multikey_quicksort(character: np.ndarray, deepest: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by their first ``deepest`` characters, and where each group of rows that agree in them begins.

    Every group of more than one row is parted in three by its pivot, the
    median of its first, middle and last row's character: smaller and greater
    rows stay at that character, equal ones go on to the next.  All groups are
    parted at once, each in its own place.
    """
    n = len(character)
    order, begin, depth = np.arange(n), np.zeros(min(n, 1), np.int64), np.zeros(min(n, 1), np.int64)
    while True:
        size = np.diff(np.r_[begin, n])
        open_ones = (size > 1) & (depth < deepest)
        first, length, at = begin[open_ones], size[open_ones], depth[open_ones]
        if not len(first):
            return order, begin
        owner = np.repeat(np.arange(len(first)), length)
        place = np.repeat(first - np.cumsum(length) + length, length) + np.arange(len(owner))
        a, b, c = (character[order[i], at] for i in (first, first + length // 2, first + length - 1))
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[owner]
        value = character[order[place], at[owner]]
        part = 3 * owner + (value >= pivot) + (value > pivot)
        order[place] = order[place[np.argsort(part, kind="stable")]]
        sizes = np.bincount(part, minlength=3 * len(first)).reshape(-1, 3)
        starts = first[:, None] + np.cumsum(sizes, axis=1) - sizes
        begin = np.r_[begin[~open_ones], starts[sizes > 0]]
        depth = np.r_[depth[~open_ones], (at[:, None] + np.array([0, 1, 0]))[sizes > 0]]
        placed = np.argsort(begin)
        begin, depth = begin[placed], depth[placed]


def sorted_groups(strings: np.ndarray) -> Iterator[np.ndarray]:
    """Indices of equal strings (rows of bytes), in the order of the strings: deep-shallow sorting."""
    n, width = strings.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = strings
    character = padded.view(">u8").astype(np.uint64)
    order, begin = multikey_quicksort(character, min(SHALLOW, character.shape[1]))
    end = np.r_[begin[1:], n]
    raw, width8 = padded.tobytes(), padded.shape[1]
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        if b - a == 1:
            yield order[a:b]
            continue
        trie = BlindTrie()
        for i in order[a:b].tolist():
            trie.insert(int.from_bytes(raw[i * width8 : (i + 1) * width8], "big"), i)
        for members in trie.groups():
            yield np.array(members)


def _sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by key: marks of all windows but the first of each content."""
    held: list[pa.RecordBatch] = []

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        key = rows.column("key").to_numpy()
        new = np.r_[True, key[1:] != key[:-1]]
        size = np.bincount(np.cumsum(new) - 1)
        shared = np.flatnonzero(np.repeat(size, size) > 1)  # a piece that is alone has no equal
        if not len(shared):
            return
        rows = rows.take(pa.array(shared))
        uid, p, n = (rows.column(c).to_numpy() for c in ("uid", "p", "n"))
        data, at = as_bytes(rows.column("data").combine_chunks())
        window = np.repeat(at[:-1] - np.cumsum(n) + n, n) + np.arange(n.sum())
        owner = np.repeat(np.arange(len(n)), n)
        w_uid, w_p = uid[owner], p[owner] + window - at[owner]
        again = []
        for members in sorted_groups(np.lib.stride_tricks.sliding_window_view(data, LENGTH)[window]):
            if len(members) > 1:
                first = members[np.lexsort((w_p[members], w_uid[members]))[0]]
                again.append(members[members != first])
        if again:
            index = np.concatenate(again)
            yield _batch(MARK, *_joined(w_uid[index], w_p[index], np.ones(len(index), np.int64)))

    for batch in batches:
        tag = batch.column("tag").to_numpy()
        mark = batch.filter(pa.array(tag == MARK))
        if mark.num_rows:
            yield mark.select(["tag", "uid", "p", "n"])
        rows = batch.filter(pa.array(tag == RUN))
        if not rows.num_rows:
            continue
        held.append(rows)
        together = pa.Table.from_batches(held)
        if together.num_rows * SLICE < _SUFFIXES:
            continue
        key = together.column("key").to_numpy()
        whole = int(np.searchsorted(key, key[-1]))  # the last group may go on in the next batch
        if whole:
            yield from work(together.slice(0, whole))
            held = together.slice(whole).combine_chunks().to_batches()
    if held:
        yield from work(pa.Table.from_batches(held))


# ---------------------------------------------------------------- documents


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of removed bytes, and what is left."""
    for block in blocks(batches, "text", _BLOCK):
        out = []
        marks = block.column("marks").to_pylist()
        for uid, text, found in zip(block.column("uid").to_pylist(), block.column("text").to_pylist(), marks, strict=True):
            raw = text or b""
            spans: list[list[int]] = []
            for m in sorted(found or [], key=lambda m: m["p"]):
                a, b = m["p"], m["p"] + m["n"] - 1 + LENGTH
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], b)
                else:
                    spans.append([a, b])
            kept, at = [], 0
            for a, b in spans:
                kept.append(raw[at:a])
                at = b
            left = b"".join([*kept, raw[at:]])
            out.append((uid, len(raw), len(raw) - len(left), [{"start": a, "end": b} for a, b in spans], hashlib.sha256(left).hexdigest()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
            names=["uid", "n_bytes", "n_removed", "spans", "kept_sha256"])


def repeated_substrings(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (start, end in bytes), kept_sha256; one row per input row.

    Null and empty texts have no bytes.  Rows that repeat an id, and rows with
    a null id (which come last), are documents of their own, in the order of
    their texts; only then does a numbering pass over the table precede.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary").alias("text"))
    unclear = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
    plain = unclear.isEmpty()
    if plain:
        rows = rows.withColumnRenamed("doc_id", "uid")
    else:
        rows = number_rows(rows.withColumn("order", F.coalesce("doc_id", F.lit((1 << 63) - 1))), ["order", "text"], "uid").drop("order")
        rows = written(rows)
    texts = rows.select("uid", "text")

    runs = texts.mapInArrow(_find_runs, _FOUND).repartition(F.col("key")).sortWithinPartitions("key", "u", "uid", "p")
    first = written(runs.mapInArrow(_compare_runs, _MARKS))
    rest = first.where(f"tag = {REST}").groupBy("uid").agg(F.collect_list(F.struct("p", "n")).alias("runs"))
    pieces = texts.join(rest, "uid").select("uid", "text", "runs").mapInArrow(_cut_pieces, f"{_FOUND}, data binary")
    second = pieces.repartition(F.col("key")).sortWithinPartitions("key").mapInArrow(_sort_suffixes, _MARKS)
    marks = first.where(f"tag = {MARK}").unionByName(second).groupBy("uid").agg(F.collect_list(F.struct("p", "n")).alias("marks"))
    removed = texts.join(marks, "uid", "left").select("uid", "text", "marks").mapInArrow(
        _remove, "uid long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string")
    if plain:
        return removed.withColumnRenamed("uid", "doc_id")
    return removed.join(rows.select("uid", "doc_id"), "uid").select("doc_id", "n_bytes", "n_removed", "spans", "kept_sha256")
