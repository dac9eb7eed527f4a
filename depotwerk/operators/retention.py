"""Age-based retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import moment

RETENTION_DAYS = 90


def retain(df: DataFrame, ts_column: str, run_ts: datetime, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows not older than ``days`` days; rows without a time stay, as a delete would leave them."""
    limit = moment(run_ts) - F.expr(f"interval {days} days")
    return df.where(F.col(ts_column).isNull() | (F.col(ts_column) >= limit))


def expired_batches(df: DataFrame, ts_column: str, run_ts: datetime, days: int = RETENTION_DAYS) -> DataFrame:
    """Batches whose newest row is past the limit: their partitions can be dropped whole."""
    limit = moment(run_ts) - F.expr(f"interval {days} days")
    return (
        df.groupBy("batch_id").agg(F.max(ts_column).alias("neueste"), F.count("*").alias("anzahl"))
        .where(F.col("neueste") < limit)
    )
