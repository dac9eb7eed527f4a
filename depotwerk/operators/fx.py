"""Exchange rates to EUR with a look-back.

The rate of a currency on a date is, in this order: 1 for EUR; the rate of the
same batch on exactly that date; the rate of any batch on the newest date not
older than ``lookback`` days; otherwise NULL.  Where several quotes compete,
type EZB wins, then the newest batch, then the newest arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import canonical
from .joins import BROADCAST_ROWS, lookup

HOME = "EUR"
PREFERRED_TYPE = "EZB"
LOOKBACK_DAYS = 5
RATE_TYPE = "decimal(15,8)"
PIECE_DAYS = 64  # of a currency that are sorted together


def _quotes(fx: DataFrame, allow_inverse: bool) -> DataFrame:
    """(waehrung, kursdatum, batch_id, kurs, klasse, stg_id) of every quote against EUR."""
    von, nach = canonical("waehrung_von"), canonical("waehrung_nach")
    preferred = F.when(canonical("kurstyp") == PREFERRED_TYPE, 1).otherwise(0)

    def pick(currency: Column, home: Column, kurs: Column, direct: int) -> DataFrame:
        klass = preferred + F.lit(2 * direct)
        return (
            fx.where((home == HOME) & F.col("kurs").isNotNull() & F.col("kursdatum").isNotNull())
            .select(
                currency.alias("waehrung"),
                "kursdatum",
                "batch_id",
                kurs.cast(RATE_TYPE).alias("kurs"),
                klass.alias("klasse"),
                "stg_id",
            )
            .where(F.col("waehrung").isNotNull())
        )

    quotes = pick(von, nach, F.col("kurs"), 1)
    if allow_inverse:
        inverse = 1 / F.nullif(F.col("kurs").cast("decimal(20,8)"), F.lit(0).cast("decimal(20,8)"))
        quotes = quotes.unionByName(pick(nach, von, inverse, 0).where("kurs is not null"))
    return quotes


def rate_requests(rows: DataFrame, currency: Column, on_date: str) -> DataFrame:
    """(waehrung, gilt_am, batch_id): the different rates the rows ask for."""
    return (
        rows.select(currency.alias("waehrung"), F.col(on_date).alias("gilt_am"), F.col("batch_id").cast("bigint").alias("batch_id"))
        .where((F.col("waehrung") != HOME) & F.col("gilt_am").isNotNull())
        .distinct()
    )


def eur_rates(
    requests: DataFrame, fx: DataFrame, *, lookback: int = LOOKBACK_DAYS, allow_inverse: bool = False,
    piece_days: int = PIECE_DAYS,
) -> DataFrame:
    """(waehrung, gilt_am, batch_id, kurs): the rate of each request that has one.

    Quotes and requests are sorted together by currency and day, and each
    request takes the last quote before it, so the look-back costs nothing:
    it only decides whether that quote is too old.  Both sides are reduced
    first, to one quote per currency, day and batch and to the different
    requests; what remains is cut into pieces of ``piece_days`` days, so a
    piece has a bounded number of rows per batch however many rows ask for
    it.  The last quote of the earlier pieces comes from a table with one
    row per currency and piece.
    """
    first = Window.partitionBy("waehrung", "kursdatum", "batch_id").orderBy(F.desc("klasse"), F.desc_nulls_last("stg_id"))
    quotes = (
        _quotes(fx, allow_inverse)
        .withColumn("rang", F.row_number().over(first)).where("rang = 1")
        .select("waehrung", F.col("kursdatum").alias("tag"), F.col("batch_id").cast("bigint").alias("batch_id"),
                "klasse", "stg_id", "kurs", F.lit(False).alias("gefragt"))
    )
    asked = requests.select("waehrung", F.col("gilt_am").alias("tag"), "batch_id").where(
        "waehrung IS NOT NULL AND tag IS NOT NULL").distinct()
    both = (
        quotes.unionByName(asked.withColumn("gefragt", F.lit(True)), allowMissingColumns=True)
        .withColumn("teil", F.floor(F.unix_date("tag") / piece_days))
        .repartition("waehrung", "teil")
    )
    day = Window.partitionBy("waehrung", "teil", "tag").orderBy(
        "gefragt", F.desc("klasse"), F.desc_nulls_last("batch_id"), F.desc_nulls_last("stg_id"))
    whole_day = day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own_batch = Window.partitionBy("waehrung", "teil", "tag", "batch_id")
    so_far = Window.partitionBy("waehrung", "teil").orderBy("tag").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    merged = both.withColumns({
        "tageskurs": F.first("kurs").over(whole_day),
        "eigener": F.max("kurs").over(own_batch),
    }).withColumn("letzter", F.last(_quote("tag", "tageskurs"), ignorenulls=True).over(so_far))

    ends = merged.groupBy("waehrung", "teil").agg(
        F.max(F.when(F.col("tageskurs").isNotNull(), F.col("tag"))).alias("tag"),
        F.max_by("tageskurs", F.when(F.col("tageskurs").isNotNull(), F.col("tag"))).alias("kurs"))
    before = Window.partitionBy("waehrung").orderBy("teil").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("waehrung", "teil", F.last(_quote("tag", "kurs"), ignorenulls=True).over(before).alias("vorher"))

    newest = F.coalesce("letzter", "vorher")
    fresh = F.when(F.date_diff(F.col("tag"), newest["tag"]) <= lookback, newest["kurs"])
    return (
        merged.where("gefragt").join(carried, ["waehrung", "teil"], "left")
        .select("waehrung", F.col("tag").alias("gilt_am"), "batch_id", F.coalesce("eigener", fresh).alias("kurs"))
        .where("kurs IS NOT NULL")
    )


def _quote(day: str, rate: str) -> Column:
    return F.when(F.col(rate).isNotNull(), F.struct(F.col(day).alias("tag"), F.col(rate).alias("kurs")))


def with_eur_rate(
    rows: DataFrame,
    rates: DataFrame,
    *,
    currency: Column,
    on_date: str,
    spread_by: list[str],
    rate_rows: int | None = None,
    into: str = "wechselkurs_eur",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add the EUR rate of ``currency`` on ``on_date`` for the row's own batch.

    ``rates`` comes from :func:`eur_rates` and holds what the rows ask for; it
    is one lookup.  A row without a batch has its rate under the NULL batch.
    """
    # a struct around a NULL batch equals another one
    asked = rows.withColumns({
        "waehrung__fx": currency, "gilt_am__fx": F.col(on_date), "batch__fx": F.struct(F.col("batch_id").cast("bigint").alias("b"))})
    table = rates.select(
        F.col("waehrung").alias("waehrung__fx"), F.col("gilt_am").alias("gilt_am__fx"),
        F.struct(F.col("batch_id").alias("b")).alias("batch__fx"), F.col("kurs").alias("kurs__fx"))
    joined = lookup(asked, table, ["waehrung__fx", "gilt_am__fx", "batch__fx"],
                    spread_by=spread_by, table_rows=rate_rows, max_rows=max_rows)
    rate = F.when(F.col("waehrung__fx") == HOME, F.lit(1).cast(RATE_TYPE)).otherwise(F.col("kurs__fx"))
    return joined.withColumn(into, rate.cast(RATE_TYPE)).drop("waehrung__fx", "gilt_am__fx", "batch__fx", "kurs__fx")


def in_eur(amount: Column, rate: str = "wechselkurs_eur", scale_type: str = "decimal(20,2)") -> Column:
    """Amount times rate, rounded half up to the column's own scale."""
    return (amount * F.col(rate)).cast(scale_type)
