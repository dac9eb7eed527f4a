"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels mark documents, a chain needs labelled tokens.  Words that toxic
documents use far more often than clean ones become toxic tokens in toxic
documents; every other token is clean.  The chain (states clean and toxic)
scores a token by hashed features of the word, its beginning and its
neighbours.  Marginals of the forward-backward pass give spans, and a logistic
rule over their sum and maximum, fitted to the document labels, gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks
from .langid import Words, words_of

FEATURES = 1 << 18
LENGTH = 64  # tokens of a chain; longer texts are several chains
TOXIC_DOCS, CLEAN_DOCS = 1500, 3000  # bound of the labelled sample, chosen by the hash of the id
TOXIC_CHARS, CLEAN_CHARS = 12 << 20, 12 << 20  # of the sample's texts; a text that does not fit is passed over
CHAINS = 6000
STEPS = 80
LEAST_DOCS, LEAST_ODDS = 4, 2.0  # a toxic word: so many toxic documents, so much more often (natural log)
_BLOCK = 1 << 20


@dataclass
class Crf:
    weight: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    bias: float = -6.0
    change: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))  # log weight of (previous, next) state
    rule: np.ndarray = field(default_factory=lambda: np.array([-3.0, 0.0, 0.0]))  # logistic: 1, log of the sum, maximum


def _hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word and of its first four letters."""
    n = len(words.codes)
    base = np.uint64(0x9E3779B97F4A7C15)
    power = np.full(n + 1, base, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    back = np.full(n + 1, np.uint64(pow(int(base), -1, 1 << 64)), np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((words.codes.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)) * power[:n], out=sums[1:])

    def of(end):
        h = (sums[end] - sums[words.start]) * back[words.start]
        return (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)

    return of(words.end), of(np.minimum(words.end, words.start + 4)) + np.uint64(7)


def features(words: Words) -> np.ndarray:
    """Hashed features [words, 4]: word, beginning, word before, word after (within the text)."""
    word, begin = _hashes(words)
    before, after = np.zeros_like(word), np.zeros_like(word)
    before[1:], after[:-1] = word[:-1], word[1:]
    first = words.first[:-1][words.first[:-1] < words.first[1:]]
    last = words.first[1:][words.first[:-1] < words.first[1:]] - 1
    before[first] = 0
    after[last] = 0
    salted = [word, begin, before * np.uint64(3) + np.uint64(1), after * np.uint64(5) + np.uint64(2)]
    return np.stack([((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64) for h in salted], axis=1)


def chains(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the words of each chain [chains, LENGTH] (-1: none), and the text of each chain."""
    n = np.diff(first)
    per = -(-n // LENGTH)
    text = np.repeat(np.arange(len(n)), per)
    number = np.arange(len(text)) - np.repeat(np.r_[0, np.cumsum(per)[:-1]], per)
    at = (first[:-1][text] + number * LENGTH)[:, None] + np.arange(LENGTH)
    return np.where(at < first[1:][text][:, None], at, -1), text


def marginals(emission: np.ndarray, there: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once.

    ``emission``: log weight of toxic against clean per place.  Returns the
    probability of toxic per place and of each pair of states at (t, t + 1).
    """
    s, t = emission.shape
    odds = np.exp(np.clip(emission, -30, 30))
    move = np.exp(change)
    fore, back = np.empty((t, s, 2)), np.empty((t, s, 2))
    state = np.full((s, 2), 0.5)
    for i in range(t):
        state = state @ move if i else state
        state = state * np.stack([np.ones(s), np.where(there[:, i], odds[:, i], 1.0)], axis=1)
        state /= state.sum(axis=1, keepdims=True)
        fore[i] = state
    rest = np.full((s, 2), 0.5)
    for i in range(t - 1, -1, -1):
        back[i] = rest
        seen = rest * np.stack([np.ones(s), np.where(there[:, i], odds[:, i], 1.0)], axis=1)
        rest = np.where(there[:, i : i + 1], seen @ move.T, rest)
        rest = rest / rest.sum(axis=1, keepdims=True)
    p = fore * back
    p /= p.sum(axis=2, keepdims=True)
    pair = np.zeros((2, 2))
    for i in range(t - 1):
        both = there[:, i + 1]
        right = back[i + 1][both] * np.stack([np.ones(both.sum()), odds[both, i + 1]], axis=1)
        joint = fore[i][both][:, :, None] * move * right[:, None, :]
        pair += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return p[:, :, 1].T, pair


def train_crf(feature: np.ndarray, label: np.ndarray, at: np.ndarray, steps: int = STEPS, rate: float = 0.15) -> Crf:
    """Maximum likelihood with a small L2 penalty by Adam over all chains."""
    there = at >= 0
    f, y = feature[np.maximum(at, 0)], np.where(there, label[np.maximum(at, 0)], 0)
    both = there[:, 1:]
    seen = np.array([[((y[:, :-1] == a) & (y[:, 1:] == b) & both).sum() for b in (0, 1)] for a in (0, 1)], float)
    used, local = np.unique(f[there], return_inverse=True)
    index = np.zeros(f.shape, np.int32)
    index[there] = local.reshape(-1, f.shape[2])
    x = np.zeros(len(used) + 5)
    x[-5] = -2.0
    m, v = np.zeros_like(x), np.zeros_like(x)
    n = max(1, int(there.sum()))
    for step in range(1, steps + 1):
        emission = np.where(there, x[:-5][index].sum(axis=2) + x[-5], 0.0)
        p, pair = marginals(emission, there, x[-4:].reshape(2, 2))
        error = np.where(there, p - y, 0.0)
        slope = np.empty_like(x)
        slope[:-5] = sum(np.bincount(index[:, :, k][there], error[there], len(used)) for k in range(f.shape[2]))
        slope[-5] = error.sum()
        slope[-4:] = (pair - seen).ravel()
        slope = slope / n * 50 + 1e-4 * x
        m = 0.9 * m + 0.1 * slope
        v = 0.99 * v + 0.01 * slope * slope
        x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model = Crf(bias=float(x[-5]), change=x[-4:].reshape(2, 2).copy())
    model.weight[used] = x[:-5]
    return model


def token_marginals(texts: list[str], model: Crf) -> tuple[Words, np.ndarray]:
    """Words of the texts and the probability of each to be toxic."""
    words = words_of(texts)
    at, _ = chains(words.first)
    p = np.zeros(len(words.start))
    if len(at):
        there = at >= 0
        emission = model.weight[features(words)].sum(axis=1) + model.bias
        prob, _ = marginals(np.where(there, emission[np.maximum(at, 0)], 0.0), there, model.change)
        p[at[there]] = prob[there]
    return words, p


def summaries(first: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Per text [1, log(1 + sum of marginals), maximum]."""
    n = len(first) - 1
    total = np.zeros(n)
    top = np.zeros(n)
    owner = np.repeat(np.arange(n), np.diff(first))
    np.add.at(total, owner, p)
    np.maximum.at(top, owner, p)
    return np.stack([np.ones(n), np.log1p(total), top], axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ w)
        slope = x.T @ (weight * (p - y)) + 1e-2 * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return w


def _features_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the words of many texts, and per text its first word, in blocks of bounded size."""
    parts, counts, block, size = [], [], [], 0
    for i, text in enumerate(texts):
        block.append(text)
        size += len(text)
        if size >= _BLOCK or i == len(texts) - 1:
            words = words_of(block)
            parts.append(features(words).astype(np.int32))
            counts.append(np.diff(words.first))
            block, size = [], 0
    return np.concatenate(parts), np.r_[0, np.cumsum(np.concatenate(counts))]


def within(texts: list[tuple[int, int, int]], limit: int) -> list[tuple[int, int]]:
    """The (id, hash) of those texts (id, hash, length) that fit into ``limit``, in order; the shortest if none does."""
    out, left = [], limit
    for doc_id, h, n in texts:
        if n <= left:
            out.append((doc_id, h))
            left -= n
    return out or [t[:2] for t in sorted(texts, key=lambda t: t[2])[:1]]


def fit(docs: DataFrame, labels: DataFrame, *, train: Column | None = None, id_column: str = "doc_id",
        text_column: str = "text", label_column: str = "toxic", toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS,
        toxic_chars: int = TOXIC_CHARS, clean_chars: int = CLEAN_CHARS) -> Crf:
    """Learn from about ``toxic_docs`` + ``clean_docs`` labelled documents, chosen by the hash of their id.

    Of these, texts are taken in the order of the hash up to ``toxic_chars``
    and ``clean_chars`` characters; one that does not fit is passed over, and
    if none of a class fits, its shortest is taken.
    ``train`` is a condition on the id column.  Ids whose labels contradict
    each other and null labels are not learned from; copies count once.
    Without both kinds the model gives every text a low score.
    """
    known = labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label_column).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    if train is not None:
        known = known.where(train)
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").drop("top")
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Crf()
    share = F.when(F.col("y") == 1, F.lit(min(1.0, toxic_docs / sizes[1]))).otherwise(F.lit(min(1.0, clean_docs / sizes[0])))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    # ids and lengths of the sample are bounded by the two numbers of documents, its texts by the numbers of characters
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).join(
        F.broadcast(chosen), "doc_id").where("text is not null").withColumn("h", F.xxhash64("text"))
    listed = texts.select("doc_id", "y", "h", F.length("text").alias("n"), F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("place")).distinct().toPandas()
    listed = listed.sort_values(["doc_id", "h"]).drop_duplicates("h").sort_values(["place", "doc_id", "h"])
    taken = []
    for kind, limit in ((1, toxic_chars), (0, clean_chars)):
        taken += within(listed[listed["y"] == kind][["doc_id", "h", "n"]].to_numpy().tolist(), limit)
    if not taken:
        return Crf()
    wanted = docs.sparkSession.createDataFrame(taken, "doc_id long, h long")
    sample = texts.join(F.broadcast(wanted), ["doc_id", "h"]).drop("h").toPandas()
    sample = sample.sort_values("doc_id").drop_duplicates("text")
    y = sample["y"].to_numpy()
    if not len(y) or y.min() == y.max():
        return Crf()

    feature, first = _features_of(sample["text"].tolist())
    owner = np.repeat(np.arange(len(y)), np.diff(first))
    once = np.unique(owner * FEATURES + feature[:, 0])  # word types per document
    word, doc = once % FEATURES, once // FEATURES
    toxic = np.bincount(word[y[doc] == 1], minlength=FEATURES)
    clean = np.bincount(word[y[doc] == 0], minlength=FEATURES)
    odds = np.log((toxic + 0.1) / y.sum()) - np.log((clean + 0.1) / (len(y) - y.sum()))
    bad = (toxic >= LEAST_DOCS) & (odds >= LEAST_ODDS)
    label = (bad[feature[:, 0]] & (y[owner] == 1)).astype(np.int64)

    at, _ = chains(first)
    marked = np.where(at >= 0, label[np.maximum(at, 0)], 0).any(axis=1)
    rng = np.random.default_rng(5)
    order = np.r_[rng.permutation(np.flatnonzero(marked))[: CHAINS // 3], rng.permutation(np.flatnonzero(~marked))]
    model = train_crf(feature, label, at[np.sort(order[:CHAINS])])

    probability = np.zeros(len(feature))
    for i in range(0, len(at), CHAINS):
        part = at[i : i + CHAINS]
        there = part >= 0
        emission = (model.weight[feature[np.maximum(part, 0)]].sum(axis=2) + model.bias) * there
        p, _ = marginals(emission, there, model.change)
        probability[part[there]] = p[there]
    weight = np.where(y == 1, sizes[1] / max(1, y.sum()), sizes[0] / max(1, len(y) - y.sum())) / (sizes[0] + sizes[1]) * len(y)
    model.rule = _logistic(summaries(first, probability), y, weight)
    return model


def score(docs: DataFrame, model: Crf, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, score, predicted, spans (start, end in code points, probability) for every document.

    Null and empty texts have the score of a text without toxic words.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", _BLOCK):
            words, p = token_marginals([t or "" for t in block.column("text").to_pylist()], model)
            total = _sigmoid(summaries(words.first, p) @ model.rule)
            hits = np.flatnonzero(p >= 0.5)
            spans: list[list[dict]] = [[] for _ in range(block.num_rows)]
            where = np.searchsorted(words.first, hits, side="right") - 1
            for i, d in zip(hits.tolist(), where.tolist(), strict=True):
                base = int(words.at[d])
                spans[d].append({"start": int(words.start[i]) - base, "end": int(words.end[i]) - base, "p": float(p[i])})
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(total), pa.array((total >= 0.5).astype(np.int32)), pa.array(spans, kind)],
                names=["doc_id", "score", "predicted", "spans"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, score double, predicted int, spans array<struct<start:long,end:long,p:double>>")
