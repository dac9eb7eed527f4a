"""Text helpers.  Blank text counts as missing, as the source systems treat it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def canonical(c: Column | str) -> Column:
    """Trimmed upper-case code."""
    return F.upper(clean(c))


def cut(c: Column | str, length: int) -> Column:
    return F.substring(_col(c), 1, length)


def concat_text(*parts: Column | str) -> Column:
    """Concatenation in which a NULL part counts as empty; all parts NULL gives NULL."""
    cols = [_col(p).cast("string") for p in parts]
    return F.nullif(F.concat(*[F.coalesce(c, F.lit("")) for c in cols]), F.lit(""))


def empty_to_null(df: DataFrame) -> DataFrame:
    """Turn ``''`` into NULL in every text column (applied once, on ingest)."""
    return df.selectExpr(
        *[
            f"nullif(`{f.name}`, '') AS `{f.name}`" if isinstance(f.dataType, T.StringType) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )
