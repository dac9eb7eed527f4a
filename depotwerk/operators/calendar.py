"""Calendar rows with German names."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import zeit_id
from ..schemas import TABLES

# German names in calendar order, weeks start on Monday.
MONTHS = ["Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September",
          "Oktober", "November", "Dezember"]
WEEKDAYS = ["Montag", "Dienstag", "Mittwoch", "Donnerstag", "Freitag", "Samstag", "Sonntag"]

FIRST_DAY, LAST_DAY = date(2000, 1, 1), date(2040, 12, 31)


def _name(names: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), number)


def describe_days(days: DataFrame, day: str = "datum") -> DataFrame:
    """All calendar columns for a frame of distinct dates.

    The week is the ISO week while the year is the calendar year.  Bank-day and
    holiday flags are the constants J and N; fiscal and relative columns stay
    empty.
    """
    days = days.withColumnRenamed(day, "datum")
    d = F.col("datum")
    weekday = F.weekday(d) + 1
    month, quarter = F.month(d), F.quarter(d)
    values = {
        "zeit_id": zeit_id(d),
        "tag_nr": F.dayofmonth(d),
        "wochentag_nr": weekday,
        "wochentag_name": _name(WEEKDAYS, weekday),
        "wochentag_kuerzel": F.substring(_name(WEEKDAYS, weekday), 1, 2),
        "ist_wochenende": F.when(weekday >= 6, "J").otherwise("N"),
        "ist_bankarbeitstag": F.lit("J"),
        "ist_feiertag": F.lit("N"),
        "woche_im_jahr": F.weekofyear(d),
        "monat_nr": month,
        "monat_name": _name(MONTHS, month),
        "monat_kuerzel": F.substring(_name(MONTHS, month), 1, 3),
        "quartal_nr": quarter,
        "quartal_name": F.concat(F.lit("Q"), quarter, F.lit("/"), F.year(d)),
        "jahr": F.year(d),
    }
    table = TABLES["DIM_ZEIT"]
    return days.withColumns(values).to(table.schema)


def calendar(
    spark: SparkSession,
    first: date = FIRST_DAY,
    last: date = LAST_DAY,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Calendar rows from ``first`` to ``last``; days already in ``existing`` are left out."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("datum")
    )
    rows = describe_days(days)
    if existing is not None:
        rows = rows.join(F.broadcast(existing.select("zeit_id")), "zeit_id", "left_anti")
        rows = rows.select(*TABLES["DIM_ZEIT"].columns)
    return rows
