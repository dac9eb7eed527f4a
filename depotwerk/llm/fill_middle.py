"""Fill-in-the-middle documents by one match of a counted regular expression.

A text is cut into units (lines by default).  ``regexp_count`` gives their
number n; the id's hash picks two cuts a <= b among the n + 1.  A pattern of
the row's own, ``(unit){a}`` then ``(unit){b - a}`` then the rest, captures
prefix, middle and suffix in one match, and the replacement puts them in
their new order.  Both counts are possessive: the engine then loops over the
units and never goes back, where an ordinary count of a group would recurse
once per unit and overflow its stack on long texts.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINE = r"[^\n]*\n|[^\n]+"
TOKENS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle


def _checked(tokens: Sequence[str]) -> tuple[str, str, str]:
    """Tokens that can be found again: none may begin inside another, or a piece could forge one at its edge."""
    if len(tokens) != 3 or len(set(tokens)) != 3 or not all(tokens):
        raise ValueError("three different tokens are needed")
    for one in tokens:
        for other in tokens:
            if one != other and other in one or any(other.startswith(one[i:]) for i in range(1, len(one))):
                raise ValueError(f"tokens {one!r} and {other!r} overlap")
    return tuple(tokens)


def _number(digest: str, group: int) -> Column:
    """The ``group``-th eight hexadecimal digits as an unsigned number."""
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def fill_middle(
    docs: DataFrame, *, unit: str = LINE, seed: int = 7, rate: int = 100, spm_rate: int = 50, tokens: Sequence[str] = TOKENS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: one row per document.

    ``unit`` is a regular expression without capturing groups whose matches
    cover every text without gaps.  ``rate`` and ``spm_rate`` are percentages:
    of documents that change, and of those that put the suffix first ('spm',
    the others 'psm').  Empty and null texts, and texts that hold a token,
    stay as they are ('plain', character counts null).  Rows with the same id
    use the same four numbers, each with its own text; a null id counts as the
    empty text.  Only the id and the text are read.
    """
    before_prefix, before_suffix, before_middle = _checked(tokens)
    written = [re.sub(r"([\\$])", r"\\\1", t) for t in tokens]
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    counted = rows.withColumns({
        "n": F.regexp_count("text", F.lit(unit)).cast("long"),
        "digest": F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)})
    cut = counted.withColumns({"x": _number("digest", 0) % (F.col("n") + 1), "y": _number("digest", 1) % (F.col("n") + 1)})
    plain = (F.col("text") == "") | (_number("digest", 2) % 100 >= rate)
    for token in tokens:
        plain = plain | F.col("text").contains(token)
    formed = cut.select(
        "doc_id", "text", "n", F.least("x", "y").cast("string").alias("a"), F.abs(F.col("x") - F.col("y")).cast("string").alias("m"),
        F.when(plain, "plain").when(_number("digest", 3) % 100 < spm_rate, "spm").otherwise("psm").alias("form"))
    pattern = F.concat(F.lit(rf"\A((?:{unit}){{"), "a", F.lit(rf"}}+)((?:{unit}){{"), "m", F.lit(r"}+)((?s:.*))\z"))
    order = F.when(F.col("form") == "spm", f"{written[1]}$3{written[0]}$1{written[2]}$2").otherwise(
        f"{written[0]}$1{written[1]}$3{written[2]}$2")
    made = formed.select(
        "doc_id", "n", "form",
        F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order)).alias("output"))
    # the tokens occur once each, so they tell how long the pieces are
    placed = made.withColumns({"p": F.instr("output", before_prefix), "s": F.instr("output", before_suffix), "m": F.instr("output", before_middle)})
    prefix_end = F.when(F.col("form") == "spm", F.col("m")).otherwise(F.col("s"))
    changed = F.col("form") != "plain"
    return placed.select(
        "doc_id", "n", "form",
        F.when(changed, prefix_end - F.col("p") - len(before_prefix)).cast("long").alias("prefix_chars"),
        F.when(changed, F.length("output") - F.col("m") + 1 - len(before_middle)).cast("long").alias("middle_chars"),
        "output")


def restored(form: str, output: str, tokens: Sequence[str] = TOKENS) -> Column:
    """The document's text, from its form and output alone."""
    before_prefix, before_suffix, before_middle = _checked(tokens)
    out = F.col(output)

    def between(left: str, right: str) -> Column:
        return F.substring_index(F.substring(out, F.instr(out, left) + len(left), F.length(out)), right, 1)

    middle = F.substring(out, F.instr(out, before_middle) + len(before_middle), F.length(out))
    spm = F.concat(between(before_prefix, before_middle), middle, between(before_suffix, before_prefix))
    psm = F.concat(between(before_prefix, before_suffix), middle, between(before_suffix, before_middle))
    return F.when(F.col(form) == "plain", out).when(F.col(form) == "spm", spm).otherwise(psm)
