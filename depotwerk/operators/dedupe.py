"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ("stg_id",)) -> DataFrame:
    """Keep the row with the greatest ``order_by`` values per key.

    Rows with a NULL key part are dropped: NULL equals nothing, so they are
    nobody's latest row.  ``order_by`` must be unique within a key.

    ``row_number() = 1`` lets Spark keep one row per key in every input task
    before the shuffle (WindowGroupLimit), so a key that holds a large share of
    the rows arrives at its reducer as one row per input task.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
    return (
        df.dropna(subset=list(keys))
        .withColumn("__rang", F.row_number().over(window))
        .where(F.col("__rang") == 1)
        .drop("__rang")
    )
