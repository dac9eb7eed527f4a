"""Date keys, German date formats and run times."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def zeit_id(d: Column | str) -> Column:
    """Calendar key YYYYMMDD of a date; NULL stays NULL."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def moment(ts: datetime) -> Column:
    """A point in time as literal, read in the session time zone."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp")


def de_date(d: Column | str) -> Column:
    return F.date_format(_col(d), "dd.MM.yyyy")


def de_timestamp(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "dd.MM.yyyy HH:mm:ss")


def run_time(start: Column | str, end: Column | str, unit_seconds: int) -> Column:
    """Elapsed time in units of ``unit_seconds``, two decimals; NULL while open."""
    micros = (F.unix_micros(_col(end)) - F.unix_micros(_col(start))).cast("decimal(20,0)")
    unit = F.lit(unit_seconds * 1_000_000).cast("decimal(12,0)")
    return F.round(micros / unit, 2).cast("decimal(18,2)")
