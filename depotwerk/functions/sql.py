"""The validation and mapping rules as SQL functions.

They are registered as temporary SQL functions, so Catalyst inlines the body;
no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import codes, rules


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _mapping(groups: dict[str, list[str]], default: str) -> str:
    arms = " ".join(
        f"WHEN upper(trim(code)) IN ({', '.join(map(_literal, spellings))}) THEN {_literal(name)}"
        for name, spellings in groups.items()
    )
    return f"CASE {arms} ELSE {_literal(default)} END"


def register(spark: SparkSession) -> None:
    """Make ``isin_error``, ``trade_type`` and ``flow_type`` usable in ``spark.sql``."""
    bodies = {
        "isin_error": (
            f"CASE WHEN code IS NULL THEN {_literal(rules.ISIN_MISSING)} "
            f"WHEN length(code) <> {rules.ISIN_LENGTH} "
            f"THEN concat({_literal(rules.ISIN_BAD_LENGTH)}, length(code), ')') "
            f"WHEN NOT code RLIKE {_literal(rules.ISIN_PATTERN)} "
            f"THEN {_literal(rules.ISIN_BAD_FORMAT)} END"
        ),
        "trade_type": _mapping(codes.TRADE_TYPES, codes.TRADE_DEFAULT),
        "flow_type": _mapping(codes.FLOW_TYPES, codes.FLOW_DEFAULT),
    }
    for name, body in bodies.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(code STRING) RETURNS STRING RETURN {body}"
        )
