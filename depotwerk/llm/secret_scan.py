"""Secrets in texts: keyword prefilter, anchored expressions near hits, checksum validation.

One Aho-Corasick pass finds the keywords with which every kind of secret but
bare hex strings begins.  Expressions are tried only where a keyword stands.
Hex strings have no keyword; a run of n hex characters covers one in n places,
so only those probes are looked at.  Kinds with a checksum are reported when
it is right.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks

# The base patterns.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS_WORD = "AKIA"
ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
# Token prefixes whose last six characters are the CRC-32 of the thirty before, in base 62.
CHECKED_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

KINDS = ("assign", "access", "hex", "checked")

_SPANS = "doc_id long, spans array<struct<kind:string,start:long,end:long,value:string>>"


@cache
def _keywords():
    import ahocorasick

    machine = ahocorasick.Automaton()
    for word in (*ASSIGN_WORDS, ACCESS_WORD.lower(), *CHECKED_WORDS):
        machine.add_word(word, word)
    machine.make_automaton()
    return machine


def base62(value: int, width: int = 6) -> str:
    digits = ""
    for _ in range(width):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def _hex_runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs of hex characters of at least the wanted length, found by probing every such many places."""
    done = 0
    for probe in range(HEX_LEAST - 1, len(text), HEX_LEAST):
        if probe < done or text[probe] not in "0123456789abcdef":
            continue
        start = probe
        while start > done and text[start - 1] in "0123456789abcdef":
            start -= 1
        done = HEX.match(text, probe).end()
        if done - start >= HEX_LEAST:
            yield start, done


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """(start, index into KINDS, end) in code points, sorted; leftmost non-overlapping within a kind."""
    found = []
    free = {"assign": 0, "access": 0, "checked": 0}
    # lower-casing ASCII only keeps every position
    lowered = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    starts = sorted((end - len(word) + 1, word) for end, word in _keywords().iter(lowered))
    for start, word in starts:
        if word in ASSIGN_WORDS:
            kind, rule = "assign", ASSIGN
        elif word in CHECKED_WORDS:
            kind, rule = "checked", CHECKED
        else:
            kind, rule = "access", ACCESS
        if start < free[kind]:
            continue
        hit = rule.match(text, start)
        if not hit:
            continue
        free[kind] = hit.end()
        if kind == "assign":
            good = len(hit[1]) >= ASSIGN_LEAST
        elif kind == "access":
            good = hit.end() - start >= ACCESS_LEAST
        else:
            good = base62(zlib.crc32(hit[1].encode())) == hit[2]
        if good:
            found.append((start, KINDS.index(kind), hit.end()))
    found += [(start, KINDS.index("hex"), end) for start, end in _hex_runs(text)]
    return sorted(found)


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def secret_spans(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and all spans with their text; one row per document, null and empty texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
        for block in blocks(batches, "text"):
            spans = [[{"kind": KINDS[k], "start": s, "end": e, "value": t[s:e]} for s, k, e in find_secrets(t)] if t else []
                     for t in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"])

    return _rows(docs, id_column, text_column).mapInArrow(run, _SPANS)


def scan(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, counts per base kind, SHA-256 of the base spans, and all spans as text."""
    spans = secret_spans(docs, id_column=id_column, text_column=text_column)
    def listed(array):
        return F.concat_ws(",", F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans.select(
        "doc_id", *[number(k) for k in KINDS],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] != "checked")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]", *, text_column: str = "text") -> DataFrame:
    """``docs`` with every secret replaced by ``mask`` (overlapping spans by one); null stays null."""

    def clean(text: str) -> str:
        out, at = [], 0
        for start, _, end in find_secrets(text):
            if start >= at:
                out += [text[at:start], mask]
            at = max(at, end)
        return "".join([*out, text[at:]])

    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_column):
            texts = [clean(t) if t else t for t in block.column(place).to_pylist()]
            yield block.set_column(place, block.schema.field(place), pa.array(texts, block.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)
