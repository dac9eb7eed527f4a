"""Language identification of mixed-language texts.

The scripts of a word's letters narrow the languages it may be in; a score per
word and language is the sum of log-likelihoods of its character n-grams; a
Viterbi path over the words, with a penalty for each change of language, gives
spans.  The document's language is the one with most letters.

The Viterbi path is needed only where a change can pay: if for the best single
language no stretch of words favours any other language by more than the
penalty, the constant path is the Viterbi path.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks

BUCKETS = 1 << 16  # hashed n-grams
GRAMS = (1, 2, 3, 4)
DOCS_PER_LANGUAGE = 1500  # documents a language is learned from, chosen by the hash of the text
SWITCH = 8.0  # penalty of a change of language, in nats
WEIGHT = 0.35  # n-grams of a word overlap: their log-likelihoods are scaled down
_PART = 1 << 20  # code points whose n-grams are held at once
_ROWS = 1 << 14  # words of a path that are lists at once
_BLOCK = 1 << 18

# Script ranges (first code point, last, script).
SCRIPTS = [
    (0x0041, 0x024F, "latin"), (0x0370, 0x03FF, "greek"), (0x0400, 0x052F, "cyrillic"), (0x0530, 0x058F, "armenian"),
    (0x0590, 0x05FF, "hebrew"), (0x0600, 0x06FF, "arabic"), (0x0750, 0x077F, "arabic"), (0x0900, 0x097F, "devanagari"),
    (0x0980, 0x09FF, "bengali"), (0x0B80, 0x0BFF, "tamil"), (0x0E00, 0x0E7F, "thai"), (0x10A0, 0x10FF, "georgian"),
    (0x1100, 0x11FF, "hangul"), (0x1E00, 0x1EFF, "latin"), (0x1F00, 0x1FFF, "greek"), (0x3040, 0x309F, "hiragana"),
    (0x30A0, 0x30FF, "katakana"), (0x3400, 0x4DBF, "han"), (0x4E00, 0x9FFF, "han"), (0xAC00, 0xD7AF, "hangul"),
    (0xF900, 0xFAFF, "han"),
]
_NAMES = ["other", *dict.fromkeys(s for _, _, s in SCRIPTS)]


@cache
def _letters() -> np.ndarray:
    """Per code point the script number of a letter, -1 for anything else."""
    script = np.full(0x110000, -1, np.int8)
    alpha = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    script[alpha] = 0
    for first, last, name in SCRIPTS:
        part = script[first : last + 1]
        part[alpha[first : last + 1]] = _NAMES.index(name)
    return script


@dataclass
class Words:
    """Words (runs of letters) of a block of texts, as positions in one array of code points."""

    codes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    first: np.ndarray  # per text: its first word, with the total
    at: np.ndarray  # per text: its first code point


def words_of(texts: list[str]) -> Words:
    # one-to-one lower-casing keeps positions; the few longer forms keep their capital
    low = [t.lower() if len(t.lower()) == len(t) else "".join(c.lower() if len(c.lower()) == 1 else c for c in t) for t in texts]
    # a separator before and after every text: no n-gram or word crosses it
    codes = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.cumsum([1, *[len(t) + 1 for t in low]])[:-1]
    script = _letters()[codes]
    letter = script >= 0
    start = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    end = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    kind = np.maximum.reduceat(script, start).astype(np.int64) if len(start) else np.zeros(0, np.int64)
    return Words(codes, start, end, kind, np.searchsorted(start, [*at, len(codes)]), at)


def gram_buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of each word padded by one boundary mark: (buckets, index of the word)."""
    codes = words.codes.astype(np.uint64)
    letter = _letters()[words.codes] >= 0
    codes = np.where(letter, codes + np.uint64(1), np.uint64(0))
    owner = np.full(len(codes), -1, np.int64)
    lengths = words.end - words.start
    inside = np.repeat(words.start - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum()) if len(lengths) else np.zeros(0, np.int64)
    owner[inside] = np.repeat(np.arange(len(lengths)), lengths)
    grams, owners = [], []
    rolled = np.zeros(len(codes), np.uint64)
    ok = np.ones(len(codes), bool)
    for n in range(1, max(GRAMS) + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        rolled = rolled[:m] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(n)
        # a gap may only be the first or the last character of a gram
        if n == 1:
            ok = letter.copy()
            who = owner
        elif n == 2:
            ok = letter[1:] | letter[:-1]
            who = np.maximum(owner[:-1], owner[1:])
        else:
            ok = np.logical_and.reduce([letter[1 + i : 1 + i + m] for i in range(n - 2)])
            who = owner[1 : 1 + m]
        at = np.flatnonzero(ok)
        h = rolled[at] * np.uint64(0x9E3779B97F4A7C15)
        grams.append((h >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1))
        owners.append(who[at])
    return np.concatenate(grams), np.concatenate(owners)


def parts(words: Words, size: int = _PART) -> Iterator[tuple[int, int, Words]]:
    """First word, end and words of stretches of about ``size`` code points, with the boundary marks around them.

    What is computed for each n-gram then takes memory for a stretch, however long a text is.
    """
    a = 0
    while a < len(words.start):
        b = max(a + 1, int(np.searchsorted(words.end, words.start[a] + size, side="right")))
        low, high = int(words.start[a]) - 1, int(words.end[b - 1]) + 1
        yield a, b, Words(words.codes[low:high], words.start[a:b] - low, words.end[a:b] - low, words.script[a:b],
                          np.array([0, b - a]), np.array([1]))
        a = b


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # float32 [BUCKETS, languages]: log-likelihood of an n-gram
    scripts: np.ndarray  # bool [scripts, languages]: whether the language uses the script


def fit(docs: DataFrame, *, language_column: str = "lang", text_column: str = "text", train: Column | None = None,
        docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Count n-grams and scripts per language over about ``docs_per_language`` documents of each.

    Rows with null language or text are not learned from.  A sample by the
    hash of the text needs no sort and no window, so a language with most of
    the rows does not meet in one task.
    """
    rows = docs.select(F.col(text_column).cast("string").alias("text"), F.col(language_column).cast("string").alias("lang"),
                       (train if train is not None else F.lit(True)).alias("train")).where("train and text is not null and lang is not null").drop("train")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(_NAMES), 0), bool))
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, docs_per_language / n))).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share * (1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS + len(_NAMES)), np.int64)
        for block in blocks(batches, "text", _BLOCK):
            langs, texts = block.column("lang").to_pylist(), block.column("text").to_pylist()
            for k in set(langs):
                words = words_of([t for t, lang in zip(texts, langs, strict=True) if lang == k])
                if not len(words.start):
                    continue
                grams, _ = gram_buckets(words)
                i = languages.index(k)
                total[i, :BUCKETS] += np.bincount(grams, minlength=BUCKETS)
                total[i, BUCKETS:] += np.bincount(words.script, minlength=len(_NAMES))
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bucket), pa.array(total[lang, bucket])], names=["l", "b", "n"])

    counted = sample.mapInArrow(count, "l long, b long, n long").groupBy("l", "b").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros((len(languages), BUCKETS + len(_NAMES)))
    total[counted["l"].to_numpy(np.int64), counted["b"].to_numpy(np.int64)] = counted["n"].to_numpy()
    grams = total[:, :BUCKETS] + 0.5
    table = WEIGHT * np.log(grams / grams.sum(axis=1, keepdims=True)).T
    used = total[:, BUCKETS:]
    scripts = (used >= 0.01 * np.maximum(1, used.sum(axis=1, keepdims=True))).T
    return Model(languages, (table - table.max(axis=1, keepdims=True)).astype(np.float32), scripts)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """float64 [words, languages]; languages that do not use the word's script lose 50 nats, unless none does."""
    scores = np.empty((len(words.start), len(model.languages)))
    for a, b, part in parts(words):
        grams, owner = gram_buckets(part)
        for k in range(len(model.languages)):
            scores[a:b, k] = np.bincount(owner, model.table[grams, k], b - a)
    allowed = model.scripts[words.script]
    allowed |= ~allowed.any(axis=1, keepdims=True)
    scores[~allowed] -= 50
    return scores


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language per word."""
    n, k = scores.shape
    if n == 0:
        return np.zeros(0, np.int64)
    best = int(scores.sum(axis=0).argmax())
    # a path with words of the best language pays a switch for every stretch of another one; a path without
    # them pays one less than it has stretches: its first and last stretch have to earn it
    prefix = suffix = 0.0
    for other in range(k):
        gain = np.cumsum(scores[:, other] - scores[:, best])
        before = np.r_[0.0, gain[:-1]]
        if not (gain - np.minimum.accumulate(before) <= switch).all():
            break
        prefix, suffix = max(prefix, gain.max()), max(suffix, (gain[-1] - before).max())
    else:
        if prefix + suffix <= switch:
            return np.full(n, best)
    value, back = scores[0].tolist(), np.empty((n, k), np.int16)
    for start in range(1, n, _ROWS):
        for at, row in enumerate(scores[start : start + _ROWS].tolist(), start):
            top = max(value)
            leader = value.index(top)
            top -= switch
            back[at] = [j if v >= top else leader for j, v in enumerate(value)]
            value = [(v if v >= top else top) + s for v, s in zip(value, row, strict=True)]
    path = np.empty(n, np.int64)
    last = path[-1] = value.index(max(value))
    for start in range(n - 1, 0, -_ROWS):
        some = back[max(1, start - _ROWS + 1) : start + 1].tolist()
        for at in range(start, start - len(some), -1):
            last = path[at - 1] = some[at - start + len(some) - 1][last]
    return path


def label_texts(texts: list[str], model: Model, switch: float = SWITCH):
    """Per text: (language or None, share of letters in it, spans as (start, end, language))."""
    words = words_of(texts)
    scores = word_scores(words, model)
    size = words.end - words.start
    for i, base in enumerate(words.at.tolist()):
        a, b = int(words.first[i]), int(words.first[i + 1])
        if a == b or not model.languages:
            yield None, 0.0, []
            continue
        path = viterbi(scores[a:b], switch)
        letters = np.bincount(path, size[a:b], len(model.languages))
        change = np.r_[0, np.flatnonzero(np.diff(path)) + 1, b - a]
        spans = [(int(words.start[a + s]) - base, int(words.end[a + e - 1]) - base, model.languages[path[s]])
                 for s, e in zip(change[:-1].tolist(), change[1:].tolist(), strict=True)]
        top = int(letters.argmax())
        yield model.languages[top], float(letters[top] / letters.sum()), spans


def identify(docs: DataFrame, model: Model, *, id_column: str = "doc_id", text_column: str = "text",
             switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score, spans (start, end in code points, language); one row per document.

    ``und`` with score 0 and no spans for null texts, texts without a letter,
    or a model that learned nothing.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", _BLOCK):
            found = list(label_texts([t or "" for t in block.column("text").to_pylist()], model, switch))
            yield pa.RecordBatch.from_arrays([
                block.column("doc_id"), pa.array([f[0] or "und" for f in found]), pa.array([f[1] for f in found], pa.float64()),
                pa.array([[{"start": s, "end": e, "lang": k} for s, e, k in f[2]] for f in found], kind)],
                names=["doc_id", "lang_pred", "score", "spans"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>")


def identified(docs: DataFrame, model: Model, least_share: float = 0.5, *, text_column: str = "text",
               switch: float = SWITCH) -> DataFrame:
    """The rows of ``docs`` in a language: with letters, at least ``least_share`` of them in one language."""
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_column, _BLOCK):
            texts = [t or "" for t in block.column(place).to_pylist()]
            good = [lang is not None and share >= least_share for lang, share, _ in label_texts(texts, model, switch)]
            yield block.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
