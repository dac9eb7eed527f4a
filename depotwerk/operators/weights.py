"""Share of a position in its portfolio."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import lookup

GROUP = ("fonds_id", "bewertungsdatum", "batch_id")


def portfolio_totals(positions: DataFrame, value: str, group: Sequence[str] = GROUP) -> DataFrame:
    """Value of the valid positions per portfolio; partial sums run before the shuffle."""
    return (
        positions.where(F.col("ist_gueltig") == "J")
        .groupBy(*group)
        .agg(F.sum(value).cast("decimal(30,2)").alias("__summe"))
    )


def with_portfolio_weight(
    positions: DataFrame,
    *,
    value: str = "marktwert_fondswaehrung",
    group: Sequence[str] = GROUP,
    into: str = "portfoliogewicht",
    portfolios: int | None = None,
    spread_by: Sequence[str] = ("isin",),
    small_groups: bool = False,
) -> DataFrame:
    """Add ``round(value / portfolio total * 100, 6)`` for valid rows.

    A total of 0 gives 0, a portfolio without values gives NULL, and rejected
    rows keep 0.  The total is aggregated and joined back instead of computed
    in a window: a window would put a whole portfolio into one task.
    ``portfolios`` bounds the number of groups when the caller knows it.
    With ``small_groups`` the caller has found every portfolio small enough for
    one task (:func:`depotwerk.operators.joins.fits_tasks`): then it is a window,
    which needs no join, and no shuffle where the rows lie by portfolio already.
    """
    if small_groups:
        known = reduce(and_, [F.col(c).isNotNull() for c in group])  # NULL equals nothing
        total = F.sum(F.when(F.col("ist_gueltig") == "J", F.col(value))).over(Window.partitionBy(*group))
        joined = positions.withColumn("__summe", F.when(known, total).cast("decimal(30,2)"))
    else:
        totals = portfolio_totals(positions, value, group)
        joined = lookup(positions, totals, group, spread_by=spread_by, table_rows=portfolios)
    amount, total = F.col(value).cast("decimal(20,2)"), F.col("__summe")
    share = F.round(amount / F.nullif(total, F.lit(0).cast("decimal(30,2)")) * 100, 6)
    weight = (
        F.when(F.col("ist_gueltig") != "J", F.lit(0))
        .when(total == 0, F.lit(0))
        .otherwise(share)
    )
    return joined.withColumn(into, weight.cast("decimal(10,6)")).drop("__summe")
