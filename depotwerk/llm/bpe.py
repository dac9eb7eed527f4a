"""Byte-level BPE encoding and decoding with a local rank file.

Texts are encoded by the tiktoken library.  Long texts are cut before the
library's regular expression sees them, only at places where no match can
span the cut, so memory and time stay in proportion and the ids are the same.
Long runs of white space, on which the expression's look-ahead would exhaust
its stack, are encoded as the one match that they are.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks

LONG = 1 << 16  # characters of a text beyond which it is cut

# A space or line break after a visible character starts a new match: only the
# leading space of a word and runs of white space contain white space at all.
_SAFE = re.compile(r"(?<=\S)[ \n]")

# The white space of the patterns.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN = re.compile(f"[{_WHITE}]{{4096,}}")
_LAST_BRANCHES = r"|\s+(?!\S)|\s+"

_IDS = "doc_id long, ids array<int>"


@cache
def encoding(path: str, pattern: str):
    """The encoding of a rank file: one base64 token and its rank per line."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@cache
def _runs_stand_alone(pattern: str) -> bool:
    """Whether white space is matched by the two last branches only, besides single leading blanks."""
    return pattern.endswith(_LAST_BRANCHES) and r"\s" not in pattern.removesuffix(_LAST_BRANCHES).replace(r"[^\s", "")


@cache
def _decimal(path: str, pattern: str) -> list[str]:
    return [str(i) for i in range(encoding(path, pattern).max_token_value + 1)]


def pieces(text: str, long: int = LONG) -> Iterator[str]:
    """The text in pieces of about ``long`` characters, cut at safe places only."""
    start = 0
    while len(text) - start > long:
        cut = _SAFE.search(text, start + long)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(text: str, path: str, pattern: str, long: int = LONG) -> list[int]:
    """The ids of a text, as the library gives them for the whole of it.

    A run of white space is one match up to its last character, which begins
    the next one if a visible character follows.  Patterns that treat white
    space otherwise are left to the library, long runs included.
    """
    coder = encoding(path, pattern)
    if len(text) <= long:
        return coder.encode_ordinary(text)
    ids, start = [], 0
    for run in _RUN.finditer(text) if _runs_stand_alone(pattern) else ():
        end = run.end() if run.end() == len(text) else run.end() - 1
        for piece in pieces(text[start : run.start()], long):
            ids += coder.encode_ordinary(piece)
        ids += encoding(path, r"\s+").encode_ordinary(text[run.start() : end])
        start = end
    for piece in pieces(text[start:], long):
        ids += coder.encode_ordinary(piece)
    return ids


def decode_ids(ids: list[int], path: str, pattern: str) -> bytes:
    """The bytes of a list of ids; they need not be valid UTF-8."""
    return encoding(path, pattern).decode_bytes(ids)


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def encode(docs: DataFrame, path: str, pattern: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, ids: one row per document in input order; null and empty texts have no ids.

    ``path`` is where every executor finds the rank file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            ids = [encode_text(t or "", path, pattern) for t in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return _rows(docs, id_column, text_column).mapInArrow(run, _IDS)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, bytes of the ids of ``encode``; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [decode_ids(ids or [], path, pattern) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(raw, pa.binary())], names=["doc_id", "bytes"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of the ids and of the bytes they decode to.

    Encodes and decodes in one pass, so the ids of a corpus need not be kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _decimal(path, pattern)
        for block in blocks(batches, "text"):
            n, of_ids, of_bytes = [], [], []
            for text in block.column("text").to_pylist():
                ids = encode_text(text or "", path, pattern)
                n.append(len(ids))
                of_ids.append(hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(decode_ids(ids, path, pattern)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs, id_column, text_column).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
