"""Near-duplicate documents by a chosen-path set similarity join.

Documents are sets of word shingles; documents with the same set are one
class from here on.  Independent trees branch the classes by minwise tokens:
at every level a class goes to the child named by its smallest shingle under
the hash of that tree and level, so similar sets stay together and others part.
A node with few classes is compared exhaustively on estimates from the tokens;
nodes of different trees with the same members are one.  It
gives the pairs that join what is similar in it: a spanning forest by
falling similarity, not all pairs.
Large nodes go on in several subtrees each.  A node that is still large
at the last level holds classes of high mutual similarity: its members are
compared with twelve pivots, and then with the twelve that were found most
similar to the pivots.

Links are confirmed on full sets, and components of links are the groups.  The
best pair of each class comes first.  All other similar pairs, those that a
small node did not give included, are confirmed only if their ends are not in one component
by then.  Members of a node that stays large that are still not in its largest
component are joined exactly with all members of such nodes, by prefixes: in one order
of all shingles, rare ones first, the first shingle that two linked sets share stands so
early in both that the rest can reach the threshold.  Shingles of no other member
find nothing, so what has too many of them to be linked meets nobody.  Members that
are all near one text have nearly all of its shingles in common, rare or not: a
sketch of each set bounds what two of them share, so most of those that differ
too much are no pair.

Classes meet first at the second level: two tokens part what is not similar
far better than one, so nodes and their number grow less with the corpus.
A pair of similarity s shares a node at depth d with probability s^d in each
tree; at 0.85, sixteen trees miss it with 10^-9 at depth two, and 48 subtrees
with 10^-8 at depth four, the last one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from .common import BITS, LOWER, Passing, Prefixes, as_bytes, bit_table, blocks, mix, word_bounds, written
from .graph import components

TREES, LEVELS = 16, 4
BRANCHES = 3  # subtrees of a large node
FIRST = 2  # level at which classes meet first: what is not similar seldom agrees in two tokens
PIVOTS = 12  # of a node that stays large
SMALL_NODE = 24  # classes compared exhaustively
MARGIN = 0.09  # an estimate from 256 tokens is off by more in 1 of 20,000 pairs
BINS = 1 << 20  # of shingles that are counted together, to know the rare ones
SLICE = 1 << 14  # bins whose counts are summed in one place
PIECE = 1 << 9  # of them in a row at most, so that a batch of rows stays small
SIZE_CLASSES = 64  # of sets, for a factor of e in size
SKETCH = 128  # counters of a set's sketch
STEPS = 4  # that a counter of a sketch goes up to

_TOKENS = 256
# which token a level of a subtree looks at; the first level of a tree has its own
_LOOKS_AT = np.random.default_rng(11).integers(TREES, _TOKENS, (TREES, BRANCHES, LEVELS))
_FACTORS = np.random.default_rng(9).integers(1, 1 << 32, _TOKENS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_BLOCK = 2 << 20
_ROWS = 1 << 10  # classes that meet their pivots at once
_SETS = 1 << 7  # whose prefixes go out together
_WORDS = [f"w{i}" for i in range(SKETCH * STEPS // 64)]


def shingles(block: pa.RecordBatch, words: int) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its runs of ``words`` words (A-Z lower-cased).

    A text with fewer words has the run of all of them; without words the set is empty.
    """
    data, at = as_bytes(block.column("text"))
    data = LOWER[data]
    start, end, first = word_bounds(data, at)
    word = Prefixes(data).of(start, end)
    n = len(word)
    runs = np.zeros(n, np.uint64)
    for j in range(words):
        runs[: n - j] += mix(word[j:] + np.uint64(0x632BE59BD9B4E019 * (j + 1) % (1 << 64)))
    runs = mix(runs + np.uint64(words))
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            sets.append(np.unique(runs[a : b - words + 1]))
        elif b > a:
            own = word[a:b]
            sets.append(mix(np.array([(mix(own + np.arange(1, b - a + 1, dtype=np.uint64)).sum()) + np.uint64(b - a)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _documents(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def _signatures(words: int):
    """Size, two hashes of the whole set, and the smallest shingle under each hash function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", _BLOCK):
            sets = shingles(block, words)
            size = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(size)
            token = np.zeros((len(sets), _TOKENS), np.uint32)
            key = np.zeros((len(sets), 2), np.uint64)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                begin = np.r_[0, np.cumsum(size[full])[:-1]]
                key[full, 0] = np.add.reduceat(mix(flat), begin)
                key[full, 1] = np.add.reduceat(mix(flat ^ np.uint64(0x5851F42D4C957F2D)), begin)
                short = (flat >> np.uint64(32)).astype(np.uint32)
                for k, factor in enumerate(_FACTORS):
                    token[full, k] = np.minimum.reduceat(short * factor, begin)
            tokens = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * _TOKENS), len(sets), [None, pa.py_buffer(token.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [block.column("uid"), block.column("doc_id"), pa.array(size), pa.array(key[:, 0].view(np.int64)),
                 pa.array(key[:, 1].view(np.int64)), tokens.cast(pa.binary())], names=["uid", "doc_id", "n", "k1", "k2", "tokens"])

    return run


def _node_keys(levels: tuple[int, ...]):
    """(rep, tree, branch, level, node) of every class, from its tokens; all trees or branches unless the input names them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            token = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint32).reshape(-1, _TOKENS).astype(np.uint64)
            rep, n = batch.column("rep").to_numpy(), batch.num_rows
            named = batch.schema.names
            if "branch" in named:
                row, tree, branch = np.arange(n), batch.column("tree").to_numpy(), batch.column("branch").to_numpy()
            elif "tree" in named:
                row, tree, branch = np.repeat(np.arange(n), BRANCHES), np.repeat(batch.column("tree").to_numpy(), BRANCHES), np.tile(np.arange(BRANCHES), n)
            else:
                row, tree, branch = np.repeat(np.arange(n), TREES), np.tile(np.arange(TREES), n), np.zeros(n * TREES, np.int64)
            node = mix(mix(tree.astype(np.uint64) + np.uint64(1)) + token[row, tree])
            for level in range(1, max(levels) + 1):
                if level == FIRST + 1:
                    node = mix(node + branch.astype(np.uint64))
                if level > 1:
                    looks = _LOOKS_AT[tree, branch if level > FIRST else 0, level - 1]
                    node = mix(node + token[row, looks] + np.uint64(level))
                if level in levels:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rep[row]), pa.array(tree.astype(np.int32)), pa.array(branch.astype(np.int32)),
                         pa.array(np.full(len(row), level, np.int32)), pa.array(node.view(np.int64))],
                        names=["rep", "tree", "branch", "level", "node"])

    return run


def joining_pairs(similarity: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a small node: a spanning forest of the similar ones, by falling similarity."""
    a, b = np.triu_indices(len(similarity), 1)
    value = similarity[a, b]
    good = np.flatnonzero(value >= least)
    good = good[np.argsort(-value[good], kind="stable")]
    group, chosen = list(range(len(similarity))), []
    for k in good.tolist():
        old, new = group[b[k]], group[a[k]]
        if old != new:
            group = [new if g == old else g for g in group]
            chosen.append(k)
    return a[chosen], b[chosen]


def _leaf_pairs(least: float):
    """Joining pairs (a, b) of each small node, and per node the places in ``reps`` of its other similar pairs."""

    def run(nodes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in nodes:
            left, right, value, others, at = [], [], [], [], 0
            sizes = np.diff(batch.column("reps").offsets.to_numpy()) if batch.num_rows else []
            reps = batch.column("reps").flatten().to_numpy()
            bits = batch.column("bits").flatten().to_pylist()
            for node, n in zip(batch.column("node").to_pylist(), sizes, strict=True):
                own = np.frombuffer(b"".join(bits[at : at + n]), np.uint8).reshape(n, -1)
                similarity = (own[:, None, :] == own[None, :, :]).mean(axis=2)
                if (similarity >= least).sum() > n:
                    a, b = joining_pairs(similarity, least)
                    left.append(reps[at + a])
                    right.append(reps[at + b])
                    value.append(similarity[a, b])
                    other = np.triu(similarity >= least, 1)
                    other[a, b] = False
                    if other.any():
                        x, y = np.nonzero(other)
                        others.append((node, reps[at : at + n].tolist(), x.astype(np.uint8).tobytes(), y.astype(np.uint8).tobytes()))
                at += n
            if left:
                a, b = np.concatenate(left), np.concatenate(right)
                yield _found(a=np.minimum(a, b), b=np.maximum(a, b), s=np.concatenate(value))
            if others:
                yield _found(**dict(zip(("node", "reps", "x", "y"), zip(*others, strict=True), strict=True)))

    return run


_FOUND = {"a": pa.int64(), "b": pa.int64(), "s": pa.float64(), "node": pa.int64(), "reps": pa.list_(pa.int64()), "x": pa.binary(), "y": pa.binary()}


def _found(**columns) -> pa.RecordBatch:
    return _filled(_FOUND, **columns)


def _filled(form: dict[str, pa.DataType], **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], kind) if c in columns else pa.nulls(n, kind) for c, kind in form.items()], names=list(form))


def _parted(nodes: DataFrame, label: DataFrame) -> DataFrame:
    """The other similar pairs (a, b) of small nodes whose ends are in different components (rep, component)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for row in batch.select(["reps", "x", "y", "parts"]).to_pylist():
                reps, x, y = np.array(row["reps"]), np.frombuffer(row["x"], np.uint8), np.frombuffer(row["y"], np.uint8)
                part = np.zeros(len(reps), np.int64)
                for p in row["parts"]:
                    part[p["pos"]] = p["component"]
                apart = part[x] != part[y]
                left.append(reps[x[apart]])
                right.append(reps[y[apart]])
            if left:
                a, b = np.concatenate(left), np.concatenate(right)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    member = nodes.select("node", F.posexplode("reps").alias("pos", "rep")).join(label, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    parts = (member.groupBy("node").agg(F.collect_list(F.struct("pos", "component")).alias("parts"), F.min("component").alias("low"), F.max("component").alias("top"))
             .where("low <> top").select("node", "parts"))
    return nodes.join(parts, "node").select("reps", "x", "y", "parts").mapInArrow(run, "a long, b long").distinct()


def _estimated(pairs: DataFrame, bits: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) with their estimated similarity s, if high enough; each class is looked up once per pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                two = np.frombuffer(b"".join(batch.column("y").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                value = (one == two).mean(axis=1)
                scored = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(value)], names=["a", "b", "s"])
                yield scored.filter(pa.array(value >= least))

    return (pairs.join(bits.select(F.col("rep").alias("a"), F.col("bits").alias("x")), "a")
            .join(bits.select(F.col("rep").alias("b"), F.col("bits").alias("y")), "b")
            .select("a", "b", "x", "y").mapInArrow(run, "a long, b long, s double"))


def _sets(words: int, passing: Broadcast):
    """Full sets (rep, elements) of the rows whose hash passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = Passing(passing.value)
        chosen = (b.filter(pa.array(may(b.column("hash").to_numpy().view(np.uint64)))) for b in batches if b.num_rows)
        for block in blocks(chosen, "text", _BLOCK):
            sets = shingles(block, words)
            yield pa.RecordBatch.from_arrays(
                [block.column("uid"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["rep", "elements"])

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int = 100) -> DataFrame:
    """Pairs (a, b) with denominator * |A and B| >= numerator * |A or B| on the full sets (rep, elements)."""
    with_a = pairs.join(sets.select(F.col("rep").alias("a"), F.col("elements").alias("x")), "a")
    with_b = with_a.join(sets.select(F.col("rep").alias("b"), F.col("elements").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return (with_b.select("a", "b", shared.alias("i"), (F.size("x") + F.size("y")).alias("n"))
            .where(F.lit(denominator) * F.col("i") >= F.lit(numerator) * (F.col("n") - F.col("i"))).select("a", "b"))


def _bin(elements: np.ndarray) -> np.ndarray:
    return (elements.view(np.uint64) & np.uint64(BINS - 1)).astype(np.int64)


def _packed(total: np.ndarray) -> pa.RecordBatch:
    """Rows (slice, at, count) of the bins that are not empty: one or a few for each slice of bins, at most ``PIECE`` bins each."""
    at = np.flatnonzero(total)
    part = at // SLICE
    rank = np.arange(len(at)) - np.searchsorted(part, part)
    begin = np.flatnonzero(rank % PIECE == 0)
    offsets = pa.array(np.r_[begin, len(at)].astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(part[begin].astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(at.astype(np.int32))),
         pa.ListArray.from_arrays(offsets, pa.array(total[at]))], names=["slice", "at", "count"])


def _frequencies(sets: DataFrame) -> np.ndarray:
    """How many shingles of the sets fall into each bin: at most ``BINS`` numbers reach the driver.

    A task counts all its sets first.  Its counts are sent as rows of many bins, and
    the tasks' counts are summed slice by slice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            at, count = np.unique(_bin(batch.column("elements").flatten().to_numpy()), return_counts=True)
            total[at] += count
        yield _packed(total)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            np.add.at(total, batch.column("at").flatten().to_numpy(), batch.column("count").flatten().to_numpy())
        yield _packed(total)

    form = "slice int, at array<int>, count array<long>"
    filled = sets.select("elements").mapInArrow(run, form).repartition("slice").mapInArrow(summed, form).toArrow()
    frequency = np.zeros(BINS, np.int64)
    for batch in filled.to_batches():
        frequency[batch.column("at").flatten().to_numpy()] = batch.column("count").flatten().to_numpy()
    return frequency


def _size_class(n: int) -> int:
    return int(np.log(n) * SIZE_CLASSES)


def _sketch(elements: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers of shingles by part of their hash, each in unary as bits of the words, and how many found no bit.

    Two sets share at most as many as the bits that both have, and the smaller of the two rests.
    """
    held = np.bincount((elements.view(np.uint64) >> np.uint64(40) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
    bits = held[:, None] > np.arange(STEPS)
    return np.packbits(bits).view(np.int64), int(held.sum() - bits.sum())


def _shared(one: str, two: str) -> Column:
    """At most so many shingles are in both of two sets, by their sketches."""
    both = [F.bit_count(F.col(f"{one}{w}").bitwiseAND(F.col(f"{two}{w}"))) for w in _WORDS]
    return reduce(add, both) + F.least(f"{one}over", f"{two}over")


def _prefixes(frequency: Broadcast, numerator: int, denominator: int):
    """(e, size, rep, component, n, at, probe, over, words): the shingles by which a set can be met first, where they stand in it, and its sketch.

    Every set is found under its own class of size.  Those that probe look into each class of size in which
    a set could be similar, with the shingles after which the rest still suffices there.  The sketch leaves out
    shingles that are in no other set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, _SETS) for b in batches for k in range(0, b.num_rows, _SETS)):
            out = []
            offsets = batch.column("elements").offsets.to_numpy()
            elements = batch.column("elements").values.to_numpy()
            for k, (rep, component, probe) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("rep", "component", "probe")), strict=True)):
                own = elements[offsets[k] : offsets[k + 1]]
                n, count = len(own), frequency.value[_bin(own)]
                words, over = _sketch(own[count > 1])  # one that is alone in its bin is in no other set
                head = np.lexsort((own, count))[: n - -(-numerator * n // denominator) + 1]
                at = np.flatnonzero(count[head] > 1)
                own = own[head][at]
                out.append((own, np.full(len(at), _size_class(n)), rep, component, n, at, False, over, words))
                if probe and len(at):
                    size = np.arange(_size_class(max(1, numerator * n // denominator)), _size_class(denominator * n // numerator + 1) + 1)
                    low, high = np.floor(np.exp(size / SIZE_CLASSES)), np.ceil(np.exp((size + 1) / SIZE_CLASSES))
                    other = np.clip((n - at)[None, :], low[:, None], high[:, None])  # the size that suits best
                    shared = np.minimum(other, (n - at)[None, :])
                    x, y = np.nonzero(denominator * shared >= numerator * (n + other - shared))
                    out.append((own[y], size[x], rep, component, n, at[y], True, over, words))
            many = [len(row[0]) for row in out]
            if sum(many):
                first = [np.concatenate([row[c] for row in out]) for c in (0, 1, 5)]
                same = [np.repeat(np.array([row[c] for row in out]), many, axis=0) for c in (2, 3, 4, 6, 7, 8)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first[0]), pa.array(first[1].astype(np.int32)), pa.array(same[0]), pa.array(same[1]),
                     pa.array(same[2].astype(np.int32)), pa.array(first[2].astype(np.int32)), pa.array(same[3]),
                     pa.array(same[4].astype(np.int32)), *(pa.array(np.ascontiguousarray(word)) for word in same[5].T)],
                    names=["e", "size", "rep", "component", "n", "at", "probe", "over", *_WORDS])

    return run


def meeting_pairs(sets: DataFrame, numerator: int, denominator: int = 100) -> DataFrame:
    """Pairs (a, b) of sets (rep, component, probe, elements) of different components, at least one of which probes, that may be linked.

    No linked pair is left out: the join is on full sets, by prefixes, and sketches bound what two sets share from above.
    """
    frequency = sets.sparkSession.sparkContext.broadcast(_frequencies(sets))
    found = written(sets.select("rep", "component", "probe", "elements").mapInArrow(
        _prefixes(frequency, numerator, denominator),
        "e long, size int, rep long, component long, n int, at int, probe boolean, over int, " + ", ".join(f"{w} long" for w in _WORDS)))
    probes = found.where("probe").select(
        "e", "size", F.col("rep").alias("p"), F.col("component").alias("c"), F.col("n").alias("m"), F.col("at").alias("i"),
        *[F.col(w).alias(f"p_{w}") for w in ("over", *_WORDS)])
    shared = F.least(F.col("n") - F.col("at"), F.col("m") - F.col("i"), _shared("", "p_"))
    return (probes.join(found.where("not probe"), ["e", "size"])
            .where((F.col("c") != F.col("component")) & (F.lit(denominator) * shared >= F.lit(numerator) * (F.col("n") + F.col("m") - shared)))
            .select(F.least("rep", "p").alias("a"), F.greatest("rep", "p").alias("b")).distinct())


def _best_pairs(pairs: DataFrame) -> DataFrame:
    """For each class its most similar partner, as pairs (a, b)."""
    both = pairs.select(F.col("a").alias("rep"), F.struct("s", (-F.col("b")).alias("other")).alias("best")).union(
        pairs.select(F.col("b").alias("rep"), F.struct("s", (-F.col("a")).alias("other")).alias("best")))
    best = both.groupBy("rep").agg((-F.max("best")["other"]).alias("other"))
    return best.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def _labels(groups: DataFrame) -> DataFrame:
    """Class and component of those that have links."""
    return groups.select(F.col("id").alias("rep"), "component")


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs (a, b) whose ends are in different components (rep, component)."""
    for end in ("a", "b"):
        own = label.select(F.col("rep").alias(end), F.col("component").alias(f"of_{end}"))
        pairs = pairs.join(own, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    return pairs.where("of_a <> of_b").select("a", "b")


def _star(own: DataFrame, pivot: DataFrame, least: float) -> DataFrame:
    """Classes (rep, node, bits) and the pivots of their nodes: pairs (a, b) with an estimate s that is high enough.

    Other rows have the sum and the number of the estimates of an end (rep, total, many).
    A class meets all its pivots in one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(begin, _ROWS)
                row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("pivots").offsets.to_numpy()))
                rep, p = batch.column("rep").to_numpy()[row], batch.column("pivots").flatten().to_numpy()
                one = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                two = np.frombuffer(b"".join(batch.column("theirs").flatten().to_pylist()), np.uint8).reshape(len(p), -1)
                value = (one[row] == two).mean(axis=1)
                other = rep != p
                rep, p, value = rep[other], p[other], value[other]
                end, at = np.unique(np.r_[rep, p], return_inverse=True)
                yield _met(rep=end, total=np.bincount(at, np.r_[value, value], len(end)), many=np.bincount(at, minlength=len(end)))
                good = value >= least
                yield _met(a=np.minimum(rep, p)[good], b=np.maximum(rep, p)[good], s=value[good])

    chosen = pivot.select("node", F.explode(F.array(*[f"p{i}" for i in range(PIVOTS)])).alias("rep")).distinct()
    theirs = written(chosen.join(own.select("rep", "bits"), "rep").groupBy("node").agg(
        F.collect_list("rep").alias("pivots"), F.collect_list("bits").alias("theirs")))
    return own.join(theirs, "node").select("rep", "bits", "pivots", "theirs").mapInArrow(run, "a long, b long, s double, rep long, total double, many long")


_MET = {"a": pa.int64(), "b": pa.int64(), "s": pa.float64(), "rep": pa.int64(), "total": pa.float64(), "many": pa.int64()}


def _met(**columns) -> pa.RecordBatch:
    return _filled(_MET, **columns)


def near_dedup(
    docs: DataFrame, words: int = 3, numerator: int = 85, *, id_column: str = "doc_id", text_column: str = "text",
    small_node: int = SMALL_NODE,
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable), kept; one row per input row.

    Documents are linked if 100 * |intersection| >= ``numerator`` * |union|.
    Null and empty texts, and texts without words, have an empty set and are
    linked with nothing.  Rows with a null id are not linked and are kept.
    Rows that repeat an id are documents of their own, each linked by its own
    text; only then does a numbering pass over the table precede.
    """
    least = numerator / 100 - MARGIN
    rows = _documents(docs, id_column, text_column)
    plain = rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
    if plain:
        rows = rows.withColumn("uid", F.col("doc_id"))
    else:  # numbers rise with the ids, so the smallest number of a component is that of its smallest id
        ordered = rows.withColumn("order", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
        rows = written(number_rows(ordered, ["order", "text"], "uid").drop("order"))
    texts = rows.select("uid", "text")
    signed = written(rows.select(F.when(F.col("doc_id").isNotNull(), F.col("uid")).alias("uid"), "doc_id", "text").mapInArrow(
        _signatures(words), "uid long, doc_id long, n long, k1 long, k2 long, tokens binary"))
    linkable = signed.where("n > 0 and uid is not null")
    classes = linkable.groupBy("k1", "k2", "n").agg(F.min("uid").alias("rep"))
    reps = written(
        linkable.join(classes.select(F.col("rep").alias("uid"), "k1", "k2"), ["uid", "k1", "k2"], "left_semi")
        .select(F.col("uid").alias("rep"), "tokens"))

    # branch: a class ends in the first small node on its path; a node on its own has no pairs
    def sized(nodes: DataFrame) -> DataFrame:
        sizes = nodes.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        return nodes.join(sizes, "node")

    form = "rep long, tree int, branch int, level int, node long"
    top = written(sized(reps.mapInArrow(_node_keys((FIRST,)), form)))
    leaf = top.where(F.col("size") <= small_node).select("node", "rep")
    large, stuck = top.where(F.col("size") > small_node).select("rep", "tree"), None
    if not large.isEmpty():
        # several levels at once: the path of a class is known
        below = sized(large.join(reps, "rep").mapInArrow(_node_keys(tuple(range(FIRST + 1, LEVELS + 1))), form))
        below = written(below.select("rep", "tree", "branch", "level", "node", (F.col("size") > small_node).alias("large")))
        path = ["rep", "tree", "branch"]
        deepest = below.where("large").groupBy(*path).agg(F.max("level").alias("last"))
        ends = below.where("not large").join(deepest, path, "left").where(F.col("level") == F.coalesce("last", F.lit(FIRST)) + 1)
        leaf = leaf.unionByName(ends.select("node", "rep"))
        stuck = below.where((F.col("level") == LEVELS) & F.col("large")).select("node", "rep")

    # one byte per token is enough for an estimate; it goes once to each different set of members
    bits = reps.mapInArrow(_bits, "rep long, bits binary")
    members = leaf.groupBy("node").agg(F.sort_array(F.collect_list("rep")).alias("reps"))
    members = members.groupBy("reps").agg(F.min("node").alias("node"))
    grouped = (members.select("node", F.explode("reps").alias("rep")).join(bits, "rep")
               .groupBy("node").agg(F.collect_list("rep").alias("reps"), F.collect_list("bits").alias("bits")))
    found = written(grouped.select("node", "reps", "bits").mapInArrow(
        _leaf_pairs(least), "a long, b long, s double, node long, reps array<long>, x binary, y binary"))
    pairs = found.where("a is not null").select("a", "b", "s")
    others = found.where("node is not null").select("node", "reps", "x", "y")
    if stuck is not None:
        # one node of each class; its pivots, chosen by hash, are mostly those of the other nodes too
        own = written(stuck.groupBy("rep").agg(F.min("node").alias("node")).join(bits, "rep"))
        pivot = stuck.groupBy("node").agg(*[F.min_by("rep", F.xxhash64("rep", F.lit(i))).alias(f"p{i}") for i in range(PIVOTS)])
        star = written(_star(own, pivot, least))
        # the second ones have the highest mean estimate of those with the same remainder
        mean = star.where("rep is not null").groupBy("rep").agg((F.sum("total") / F.sum("many")).alias("mean"))
        part = F.pmod(F.xxhash64("rep"), F.lit(PIVOTS))
        hub = own.join(mean, "rep").groupBy("node").agg(*[F.max_by("rep", F.when(part == i, F.struct("mean", "rep"))).alias(f"p{i}") for i in range(PIVOTS)])
        near = star.unionByName(_star(own, hub, least)).where("a is not null").select("a", "b", "s")
        pairs = pairs.unionByName(near)
    pairs = written(pairs.groupBy("a", "b").agg(F.max("s").alias("s")))

    # full sets of all classes that may take part in a comparison
    ids = pairs.select(F.col("a").alias("uid")).union(pairs.select("b"))
    if stuck is not None:
        ids = ids.union(stuck.select("rep"))
    # texts stay where they are: a table of bits lets those of the classes pass, and a few others
    ids = written(ids.distinct())
    passing = rows.sparkSession.sparkContext.broadcast(bit_table(ids.select(F.xxhash64("uid").alias("hash"))))
    sets = texts.withColumn("hash", F.xxhash64("uid")).mapInArrow(_sets(words, passing), "rep long, elements array<long>")
    if ids.count() > BITS // 16:  # so many that others pass as well
        sets = sets.join(ids.withColumnRenamed("uid", "rep"), "rep", "left_semi")
    sets = written(sets)
    best = written(_best_pairs(pairs))
    links = written(confirmed(best, sets, numerator))
    groups = written(components(links))
    rest = written(_apart(pairs, _labels(groups)).unionByName(_parted(others, _labels(groups))).distinct().join(best, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        links = written(links.unionByName(confirmed(rest, sets, numerator)))
        groups = written(components(links))
    if stuck is not None:
        member = written(stuck.join(_labels(groups), "rep", "left").withColumn("component", F.coalesce("component", "rep")))
        largest = F.max_by("component", F.struct("count", "component"))
        home = member.groupBy("node", "component").count().groupBy("node").agg(largest.alias("home"))
        outside = written(member.join(home, "node").where("component <> home").select("rep", F.lit(True).alias("outside")).distinct())
        if not outside.isEmpty():
            inside = member.select("rep", "component").distinct().join(outside, "rep", "left")
            probing = sets.join(inside, "rep").withColumn("probe", F.coalesce("outside", F.lit(False)))
            across = meeting_pairs(probing, numerator).join(best.union(rest), ["a", "b"], "left_anti")
            last = written(_estimated(across, own, least).select("a", "b"))
            if not last.isEmpty():
                groups = components(links.unionByName(confirmed(last, sets, numerator)))

    named = (classes.join(groups.select(F.col("id").alias("rep"), "component"), "rep", "left")
             .select("k1", "k2", "n", F.coalesce("component", "rep").alias("found")))
    if not plain:
        lowest = signed.select(F.col("uid").alias("found"), F.col("doc_id").alias("lowest")).where("found is not null")
        named = named.join(lowest, "found").select("k1", "k2", "n", F.col("lowest").alias("found"))
    return (
        signed.drop("tokens").join(named, ["k1", "k2", "n"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"),
                F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("found")).otherwise(F.col("doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        low = [np.frombuffer(t, np.uint8)[::4].tobytes() for t in batch.column("tokens").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(low, pa.binary())], names=["rep", "bits"])
