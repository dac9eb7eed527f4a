"""One query per operator over the given tables."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import canonical, flow_sign, flow_type, isin_error, rules, trade_sign, trade_type, with_verdict
from ..functions import sql as sql_functions
from ..functions import zeit_id
from ..operators import integrity, merge
from ..operators.calendar import calendar, describe_days
from ..operators.dedupe import latest
from ..operators.fx import eur_rates, rate_requests, with_eur_rate
from ..operators.joins import PIECES, fits_tasks
from ..operators.keys import KeyTable, with_key
from ..operators.numbering import arrival_ids, number_rows
from ..operators.retention import expired_batches, retain
from ..operators.scd2 import point_in_time, version_at
from ..operators.slices import cut, shuffles_dropped, slice_by_slice, slice_count
from ..operators.weights import GROUP
from ..plans import dimensions, facts, monitor, transforms
from ..plans.control import Control
from ..schemas import TABLES, nullable
from ..session import ensure_checkpoint_dir
from ..sources import readers, seeds, staging
from ..sources.store import Folders, Warehouse
from . import mapping
from .mapping import ARRIVAL, Tables

RUN_TS = datetime(2024, 2, 10, 12, 0, 0)
FIRST_LOAD, SECOND_LOAD = date(2024, 1, 1), date(2024, 2, 1)
RUN_DAY = date(2000, 1, 31)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: comparable(build(Tables(spark, sf_dir)))
    return build


def comparable(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: decimals as double, dates as ISO text, counts as bigint."""
    def cast(f: T.StructField) -> str:
        if isinstance(f.dataType, T.DecimalType):
            return f"cast(`{f.name}` AS double) AS `{f.name}`"
        if isinstance(f.dataType, (T.DateType, T.TimestampType)):
            pattern = "yyyy-MM-dd" if isinstance(f.dataType, T.DateType) else "yyyy-MM-dd HH:mm:ss.SSSSSS"
            return f"date_format(`{f.name}`, '{pattern}') AS `{f.name}`"
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return f"cast(`{f.name}` AS bigint) AS `{f.name}`"
        return f"`{f.name}`"

    return df.selectExpr(*[cast(f) for f in df.schema.fields])


# --- shared inputs --------------------------------------------------------

def rates(t: Tables, *staged: str) -> transforms.Rates:
    """The EUR rates that the rows of some staged tables ask for, stored as a load stores them."""
    table = _stored(eur_rates(transforms.requested_rates({n: t.stg(n) for n in staged}), t.stg("STG_KV_WECHSELKURS")))
    return transforms.Rates(table, table.count())


def reference_keys(t: Tables) -> tuple[KeyTable, KeyTable, KeyTable]:
    return (KeyTable.build(seeds.countries(t.spark, RUN_TS), "iso3_code", "land_id"),
            KeyTable.sectors(seeds.sectors(t.spark, RUN_TS)),
            KeyTable.build(seeds.currencies(t.spark, RUN_TS), "iso_code", "waehrung_id"))


def depots(t: Tables) -> DataFrame:
    """Accounts of the events, every second one delivered twice."""
    n = t.raw("events").select((F.col("user_id") % 13).alias("n")).distinct()
    return n.selectExpr(
        "explode(sequence(cast(0 AS bigint), (n + 1) % 2)) AS kopie", "n",
        "'DEPOT' || cast(n AS string) AS depot_nr", "'J' AS ist_aktuell",
    ).selectExpr("n * 2 + 1 + kopie AS depot_sk", "depot_nr", "ist_aktuell",
                 "'BANK' || cast(kopie AS string) AS depotstelle")


def securities(t: Tables) -> DataFrame:
    """Security versions: every seventh part also has a closed one."""
    return t.raw("part").selectExpr(
        f"{mapping.security_number('p_partkey')} AS isin",
        "explode(CASE WHEN p_partkey % 7 = 0 THEN array(0, 1) ELSE array(1) END) AS stand", "p_partkey",
    ).selectExpr("isin", "p_partkey * 2 + stand AS wertpapier_sk",
                 "CASE stand WHEN 1 THEN 'J' ELSE 'N' END AS ist_aktuell")


def funds(t: Tables) -> DataFrame:
    return t.raw("supplier").selectExpr(
        f"{mapping.fund_number('s_suppkey')} AS fonds_id", "s_suppkey + 1 AS fonds_sk", "'J' AS ist_aktuell")


def keys(t: Tables) -> facts.Keys:
    return facts.Keys.build(securities(t), funds(t), seeds.currencies(t.spark, RUN_TS), depots(t))


def with_row_id(df: DataFrame) -> DataFrame:
    """A row id for the validated rows, which get theirs on write otherwise."""
    return df.withColumn("vor_id", F.xxhash64(*df.columns))


def _stored(rows: DataFrame) -> DataFrame:
    """Rows written once, as a load does, before they are used twice."""
    path = f"{ensure_checkpoint_dir(rows.sparkSession)}/arbeit-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(nullable(rows.schema)).parquet(path)


def _delivered(rows: DataFrame, table: str) -> DataFrame:
    """A full delivery: what the test tables have no value for is delivered as NULL."""
    fields = readers.delivery_schema(table).fields
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in rows.columns})


# --- sources and calendar -------------------------------------------------

@query
def calendar_days(t: Tables) -> DataFrame:
    days = (
        t.raw("lineitem").selectExpr("cast(l_shipdate AS date) AS datum").distinct()
        .unionByName(t.raw("orders").selectExpr("cast(o_orderdate AS date) AS datum").distinct())
        .unionByName(t.raw("events").selectExpr("cast(ts AS date) AS datum").distinct())
        .distinct()
    )
    return describe_days(days).drop("feiertag_name", "gj_monat_nr", "gj_quartal_nr", "gj_jahr",
                                    "tage_bis_heute", "monate_bis_heute")


@query
def calendar_fill(t: Tables) -> DataFrame:
    """Days of the price range that the calendar made from the order dates lacks."""
    low, high = t.raw("lineitem").selectExpr("min(cast(l_shipdate AS date))", "max(cast(l_shipdate AS date))").first()
    existing = describe_days(
        t.raw("orders").where("o_orderstatus = 'F'").selectExpr("cast(o_orderdate AS date) AS datum").distinct())
    return calendar(t.spark, low, high, existing).select("zeit_id", "datum", "wochentag_nr")


@query
def stage_holdings(t: Tables) -> DataFrame:
    delivery = t.stg("STG_FB_BESTAND").drop("marktwert_fondswaehrung")
    return staging.stage_bestand(_delivered(delivery, "STG_FB_BESTAND"), None, RUN_TS).select(
        "fonds_id", "isin", "bewertungsdatum", "marktwert", "wechselkurs", "marktwert_fondswaehrung",
        "depot_nr", "depotstelle")


@query
def stage_trades(t: Tables) -> DataFrame:
    delivery = t.stg("STG_FB_TRANSAKTION").withColumn("wechselkurs", F.lit("0.92").cast("decimal(15,8)"))
    return staging.stage_transaktion(_delivered(delivery, "STG_FB_TRANSAKTION"), None, RUN_TS).select(
        "transaktions_id", "fonds_id", "gesamtbetrag", "gesamtbetrag_fondswaehrung", "src_transaktions_nr",
        "src_status")


@query
def stage_flows(t: Tables) -> DataFrame:
    return staging.stage_fondsbewegung(_delivered(t.stg("STG_FB_FONDSBEWEGUNG"), "STG_FB_FONDSBEWEGUNG"), None, RUN_TS).select(
        "bewegungs_id", "fonds_id", "anteile", "ausgabeaufschlag", "src_bewegungs_nr", "src_status")


@query
def stage_prices(t: Tables) -> DataFrame:
    delivery = t.stg("STG_KV_KURS").withColumn("kurs_id", F.concat(F.lit("KURS-"), F.col("isin")))
    return staging.stage_kurs(_delivered(delivery, "STG_KV_KURS"), None, RUN_TS).select(
        "isin", "kursdatum", "kurstyp", "kurs", "boerse", "src_kurs_id")


@query
def stage_fx(t: Tables) -> DataFrame:
    return staging.stage_wechselkurs(_delivered(t.stg("STG_KV_WECHSELKURS"), "STG_KV_WECHSELKURS"), None, RUN_TS).select(
        "waehrung_von", "waehrung_nach", "kursdatum", "kurs", "src_kurs_id")


@query
def stage_securities(t: Tables) -> DataFrame:
    return staging.stage_wertpapier(_delivered(t.delivery("STG_WP_STAMMDATEN", 2), "STG_WP_STAMMDATEN"), None, RUN_TS).select(
        "isin", "bezeichnung_lang", "wertpapiertyp", "branche_code", "faelligkeitsdatum", "src_wertpapier_id")


@query
def stage_funds(t: Tables) -> DataFrame:
    return staging.stage_fonds(_delivered(t.delivery("STG_WP_FONDS_STAMMDATEN", 2), "STG_WP_FONDS_STAMMDATEN"), None, RUN_TS).select(
        "fonds_id", "fondsname", "fondswaehrung", "kag_name", "src_fonds_id")


@query
def incremental_extract(t: Tables) -> DataFrame:
    """Rows changed after the last successful load found in the log."""
    log = t.log().withColumnRenamed("prozessstart", "ladestart").where("tabelle <> 'STG_KV_KURS' OR log_id % 4 = 0")
    since = readers.last_load(log, "STG_KV_KURS")
    return readers.rows_changed_since(
        t.raw("events").selectExpr("event_id", "event_type", "cast(ts AS timestamp) AS ts"), "ts", since).select("event_id", "event_type")


# --- validation and normalisation -----------------------------------------

@query
def isin_check(t: Tables) -> DataFrame:
    return t.stg("STG_KV_KURS").select("isin", "kursdatum", isin_error("isin").alias("fehler"))


@query
def sql_function_check(t: Tables) -> DataFrame:
    sql_functions.register(t.spark)
    return t.stg("STG_FB_TRANSAKTION").selectExpr(
        "transaktions_id", "isin_error(isin) AS fehler", "trade_type(transaktionstyp) AS typ",
        "flow_type(kontrahent) AS bewegung")


def _validated(rows: DataFrame, checks: list, *show: str) -> DataFrame:
    return with_verdict(rows, checks).select(*show, "ist_gueltig", "validierungsfehler")


@query
def validate_holding(t: Tables) -> DataFrame:
    return _validated(t.stg("STG_FB_BESTAND", broken=True), rules.holding_rules(), "fonds_id", "isin", "bewertungsdatum")


@query
def validate_trade(t: Tables) -> DataFrame:
    return _validated(t.stg("STG_FB_TRANSAKTION", broken=True), rules.trade_rules(), "transaktions_id", "fonds_id", "isin")


@query
def validate_flow(t: Tables) -> DataFrame:
    return _validated(t.stg("STG_FB_FONDSBEWEGUNG", broken=True), rules.flow_rules(), "bewegungs_id", "fonds_id")


@query
def validate_price(t: Tables) -> DataFrame:
    return _validated(t.stg("STG_KV_KURS", broken=True), rules.price_rules(), "isin", "kursdatum", "kurs")


@query
def validate_fx(t: Tables) -> DataFrame:
    return _validated(t.stg("STG_KV_WECHSELKURS", broken=True), rules.fx_rules(), "stg_id", "kurs")


@query
def validate_security(t: Tables) -> DataFrame:
    return _validated(t.delivery("STG_WP_STAMMDATEN", 2, broken=True), rules.security_rules(), "isin",
                      "bezeichnung_lang", "wertpapiertyp")


@query
def validate_fund(t: Tables) -> DataFrame:
    return _validated(t.delivery("STG_WP_FONDS_STAMMDATEN", 2, broken=True), rules.fund_rules(), "fonds_id",
                      "fondsname")


@query
def norm_trade_type(t: Tables) -> DataFrame:
    typ = t.stg("STG_FB_TRANSAKTION").select(
        "transaktions_id", "transaktionstyp", trade_type("transaktionstyp").alias("normiert"))
    return typ.withColumn("vorzeichen", trade_sign("normiert"))


@query
def norm_flow_type(t: Tables) -> DataFrame:
    typ = t.stg("STG_FB_FONDSBEWEGUNG").select(
        "bewegungs_id", "bewegungstyp", flow_type("bewegungstyp").alias("normiert"))
    return typ.withColumn("vorzeichen", flow_sign("normiert"))


@query
def defaults(t: Tables) -> DataFrame:
    return t.stg("STG_FB_TRANSAKTION").withColumns(transforms.trade_amounts()).select(
        "transaktions_id", "fonds_id", "buchungsdatum", "provision", "stueckzinsen", "gesamtbetrag", "eur_basis")


@query
def defaults_flow(t: Tables) -> DataFrame:
    return t.stg("STG_FB_FONDSBEWEGUNG").withColumns(transforms.flow_amounts()).select(
        "bewegungs_id", "buchungsdatum", "nettobetrag", "ausgabeaufschlag")


# --- lookups, dedupe, weights ---------------------------------------------

def _fx_requests(t: Tables) -> DataFrame:
    holdings = t.stg("STG_FB_BESTAND").select(
        "batch_id", canonical("waehrung_fonds").alias("waehrung"), F.col("bewertungsdatum").alias("datum"))
    flows = t.stg("STG_FB_FONDSBEWEGUNG").select(
        "batch_id", canonical("waehrung").alias("waehrung"), F.col("handelsdatum").alias("datum"))
    return holdings.distinct().unionByName(flows.distinct()).distinct()


def _asked(t: Tables, fx: DataFrame, **options) -> DataFrame:
    asked = _stored(_fx_requests(t))
    table = eur_rates(rate_requests(asked, F.col("waehrung"), "datum"), fx, **options)
    return with_eur_rate(asked, _stored(table), currency=F.col("waehrung"), on_date="datum", spread_by=["batch_id"])


@query
def fx_asof(t: Tables) -> DataFrame:
    return _asked(t, t.stg("STG_KV_WECHSELKURS"))


@query
def fx_asof_long(t: Tables) -> DataFrame:
    """A look-back of 400 days, from the quotes of every tenth order only."""
    return _asked(t, t.stg("STG_KV_WECHSELKURS").where("stg_id % 1000 < 10"), lookback=400)


@query
def fx_asof_inverse(t: Tables) -> DataFrame:
    """Rates quoted from EUR serve as a fallback when inverse quotes are allowed."""
    fx = t.stg("STG_KV_WECHSELKURS")
    turned = fx.withColumns({
        "waehrung_von": F.when(F.col("stg_id") % 2 == 0, F.col("waehrung_nach")).otherwise(F.col("waehrung_von")),
        "waehrung_nach": F.when(F.col("stg_id") % 2 == 0, F.col("waehrung_von")).otherwise(F.col("waehrung_nach")),
    })
    return _asked(t, turned, allow_inverse=True, lookback=2)


@query
def key_lookup(t: Tables) -> DataFrame:
    rows = facts.trade_rows(
        with_row_id(t.stg("STG_FB_TRANSAKTION").withColumns({
            "ist_gueltig": F.lit("J"), "transaktionstyp_normiert": F.lit("KAUF")})), keys(t))
    return rows.select("transaktions_id", "fonds_id", "isin", "fonds_sk", "wertpapier_sk", "depot_sk", "waehrung_id",
                       "zeit_id_handel", "zeit_id_valuta", "zeit_id_buchung")


@query
def key_lookup_master(t: Tables) -> DataFrame:
    land, branche, waehrung = reference_keys(t)
    rows = t.delivery("STG_WP_STAMMDATEN", 2).drop("branche_code").join(
        t.delivery("STG_WP_STAMMDATEN", 1).select("isin", "branche_code").where("isin IS NOT NULL"), "isin", "left")
    rows = with_key(rows, land, canonical("land_emittent"), "land_id", spread_by=["isin"])
    rows = with_key(rows, branche, canonical("branche_code"), "branche_id", spread_by=["isin"])
    rows = with_key(rows, waehrung, canonical("handelswaehrung"), "waehrung_id", spread_by=["isin"])
    return rows.select("isin", "land_id", "branche_id", "waehrung_id")


@query
def dedupe_latest(t: Tables) -> DataFrame:
    rows = latest(t.stg("STG_FB_BESTAND", arrival=True), ["fonds_id", "isin", "bewertungsdatum", "batch_id"], ARRIVAL)
    return rows.select("fonds_id", "isin", "bewertungsdatum", "batch_id", "marktwert", "depot_nr")


@query
def dedupe_security(t: Tables) -> DataFrame:
    rows = latest(t.stg("STG_KV_KURS", arrival=True), ["isin", "batch_id"], ARRIVAL)
    return rows.select("isin", "batch_id", "kursdatum", "kurs", "boerse")


@query
def dedupe_fund(t: Tables) -> DataFrame:
    rows = latest(t.stg("STG_FB_BESTAND", arrival=True), ["fonds_id", "batch_id"], [*ARRIVAL, "isin"])
    return rows.select("fonds_id", "batch_id", "bewertungsdatum", "marktwert")


@query
def portfolio_weight(t: Tables) -> DataFrame:
    raw = t.stg("STG_FB_BESTAND", arrival=True)
    return transforms.weighted_positions(raw, order_by=ARRIVAL, stored=_stored).select(
        "fonds_id", "isin", "bewertungsdatum", "batch_id", "ist_gueltig", "portfoliogewicht")


# --- table transforms -----------------------------------------------------

@query
def transform_wertpapier(t: Tables) -> DataFrame:
    both = t.delivery("STG_WP_STAMMDATEN", 1, broken=True).unionByName(
        t.delivery("STG_WP_STAMMDATEN", 2, broken=True))
    return transforms.transform_wertpapier(both, order_by=["isin"]).select(
        "batch_id", "isin", "bezeichnung_lang", "wertpapiertyp", "asset_klasse", "emittent_name", "land_iso3",
        "branche_code", "nominalwert", "faelligkeitsdatum", "handelswaehrung", "ist_gueltig", "validierungsfehler",
        "quellsystem")


@query
def transform_fonds(t: Tables) -> DataFrame:
    both = t.delivery("STG_WP_FONDS_STAMMDATEN", 1, broken=True).unionByName(
        t.delivery("STG_WP_FONDS_STAMMDATEN", 2, broken=True))
    return transforms.transform_fonds(both, order_by=["fonds_id"]).select(
        "batch_id", "fonds_id", "fondsname", "fondstyp", "investmentstrategie", "fondswaehrung", "kag_name",
        "domizil_land", "ist_gueltig", "validierungsfehler", "quellsystem")


@query
def transform_wechselkurse(t: Tables) -> DataFrame:
    return transforms.transform_wechselkurse(t.stg("STG_KV_WECHSELKURS", broken=True)).select(
        "batch_id", "waehrung_von", "waehrung_nach", "kursdatum", "kurstyp", "kurs", "ist_gueltig",
        "validierungsfehler")


@query
def transform_kurse(t: Tables) -> DataFrame:
    return transforms.transform_kurse(t.stg("STG_KV_KURS", arrival=True), rates(t, "STG_KV_KURS"), spread_by=ARRIVAL).drop("src_kurs_id")


@query
def transform_bestaende(t: Tables) -> DataFrame:
    return transforms.transform_bestaende(t.stg("STG_FB_BESTAND", arrival=True), rates(t, "STG_FB_BESTAND"), order_by=ARRIVAL, stored=_stored).drop(
        "stg_id", "nominale")


@query
def transform_transaktionen(t: Tables) -> DataFrame:
    return transforms.transform_transaktionen(
        t.stg("STG_FB_TRANSAKTION", arrival=True), rates(t, "STG_FB_TRANSAKTION"), spread_by=ARRIVAL).drop("stg_id", "nominale")


@query
def transform_fondsbewegungen(t: Tables) -> DataFrame:
    return transforms.transform_fondsbewegungen(
        t.stg("STG_FB_FONDSBEWEGUNG"), rates(t, "STG_FB_FONDSBEWEGUNG"), spread_by=["bewegungs_id"]).drop("stg_id")


# --- dimensions -----------------------------------------------------------

def _empty(t: Tables, table: str) -> DataFrame:
    return t.spark.createDataFrame([], TABLES[table].schema)


def _security_loads(t: Tables, second: date) -> DataFrame:
    ensure_checkpoint_dir(t.spark)
    land, branche, waehrung = reference_keys(t)
    dim = _empty(t, "DIM_WERTPAPIER")
    for number, day in ((1, FIRST_LOAD), (2, second)):
        vor = transforms.transform_wertpapier(t.delivery("STG_WP_STAMMDATEN", number), order_by=["isin"])
        dim = dimensions.load_wertpapier(
            dim, vor, laender=land, branchen=branche, waehrungen=waehrung,
            run_date=day, run_ts=RUN_TS, batch_id=number).snapshot()
        if number == 1:
            dim = dim.checkpoint()  # stands for the stored dimension the next load reads
    return dim


@query
def scd2_security(t: Tables) -> DataFrame:
    return _security_loads(t, SECOND_LOAD).select(
        "isin", "dwh_version", "gueltig_von", "gueltig_bis", "ist_aktuell", "bezeichnung_lang", "wertpapiertyp",
        "land_id", "branche_id", "waehrung_id", "faelligkeitsdatum", "batch_id_erstellt", "batch_id_geaendert")


@query
def scd2_fund(t: Tables) -> DataFrame:
    ensure_checkpoint_dir(t.spark)
    land, _, waehrung = reference_keys(t)
    dim = _empty(t, "DIM_FONDS")
    for number, day in ((1, FIRST_LOAD), (2, SECOND_LOAD)):
        vor = transforms.transform_fonds(t.delivery("STG_WP_FONDS_STAMMDATEN", number), order_by=["fonds_id"])
        dim = dimensions.load_fonds(dim, vor, laender=land, waehrungen=waehrung, run_date=day, run_ts=RUN_TS,
                                    batch_id=number).snapshot()
        if number == 1:
            dim = dim.checkpoint()
    return dim.select("fonds_id", "dwh_version", "gueltig_von", "gueltig_bis", "ist_aktuell", "fondsname", "kag_name",
                      "fondswaehrung_id", "domizil_land_id", "batch_id_erstellt", "batch_id_geaendert")


@query
def depot_insert(t: Tables) -> DataFrame:
    known = t.raw("events").selectExpr("'DEPOT' || cast(user_id % 4 AS string) AS depot_nr", "'J' AS ist_aktuell").distinct()
    return dimensions.new_depots(
        known, t.stg("STG_FB_BESTAND"), t.stg("STG_FB_TRANSAKTION"), run_date=FIRST_LOAD, run_ts=RUN_TS,
    ).select("depot_nr", "depotstelle", "dwh_version", "gueltig_von", "gueltig_bis", "ist_aktuell")


def _dated_versions(t: Tables) -> DataFrame:
    """Two versions per part with a part-specific change day, some with an empty interval between."""
    change = "cast('1998-01-01' AS date) + cast(p_partkey % 100 AS int)"
    return t.raw("part").selectExpr(
        f"{mapping.security_number('p_partkey')} AS isin", f"{change} AS wechsel",
        "explode(CASE WHEN p_partkey % 7 = 0 THEN array(1, 2, 3) ELSE array(1, 3) END) AS dwh_version",
    ).selectExpr(
        "isin", "dwh_version",
        "CASE dwh_version WHEN 1 THEN cast('1990-01-01' AS date) ELSE wechsel END AS gueltig_von",
        "CASE dwh_version WHEN 3 THEN cast('9999-12-31' AS date) ELSE wechsel - 1 END AS gueltig_bis")


@query
def point_in_time_version(t: Tables) -> DataFrame:
    rows = t.stg("STG_KV_KURS").select("isin", "kursdatum")
    return point_in_time(rows, _dated_versions(t), key="isin", on_date="kursdatum", take=["dwh_version"])


@query
def point_in_time_hot_key(t: Tables) -> DataFrame:
    """The join by shuffle, with one security in a third of the rows."""
    rows = t.stg("STG_KV_KURS", arrival=True).selectExpr(
        f"CASE WHEN l_orderkey % 3 = 0 THEN {mapping.security_number('7')} ELSE isin END AS isin", "kursdatum",
        "l_orderkey", "l_linenumber", "l_extendedprice")
    found = point_in_time(rows, _dated_versions(t), key="isin", on_date="kursdatum", take=["dwh_version"],
                          max_rows=0, rows_per_piece=1000)
    return found.select("l_orderkey", "l_linenumber", "isin", "kursdatum", "dwh_version")


@query
def versions_at_date(t: Tables) -> DataFrame:
    return version_at(_dated_versions(t), date(1998, 2, 1)).select("isin", "dwh_version")


@query
def surrogate_keys(t: Tables) -> DataFrame:
    return number_rows(t.raw("orders").select("o_orderkey"), ["o_orderkey"], "sk", start=1001).select("o_orderkey", "sk")


@query
def delivery_order(t: Tables) -> DataFrame:
    """A small first delivery and a larger correction as files: staged, numbered and reduced to the latest.

    Spark reads the larger file first; the numbers follow the names of the files.
    """
    keys = ["waehrung_von", "waehrung_nach", "kursdatum", "kurstyp"]
    quotes = t.stg("STG_KV_WECHSELKURS").groupBy(*keys).agg(F.min("kurs").alias("erster"), F.max("kurs").alias("kurs"))
    root = f"{ensure_checkpoint_dir(t.spark)}/lieferung-{uuid.uuid4().hex}"
    first = quotes.where("day(kursdatum) % 2 = 0").select(*keys, F.col("erster").alias("kurs"))
    first.write.parquet(f"{root}/1_erste")
    quotes.select(*keys, "kurs").write.parquet(f"{root}/2_korrektur")
    source = readers.FileSource(t.spark, {"STG_KV_WECHSELKURS": root}, "parquet", {"recursiveFileLookup": "true"})
    staged = staging.stage_wechselkurs(source.read("STG_KV_WECHSELKURS"), None, RUN_TS)
    return latest(arrival_ids(staged, "stg_id", lambda n: 1), keys).select(*keys, "kurs", "src_kurs_id")


# --- facts ----------------------------------------------------------------

def _merged(
    rows: DataFrame, match: tuple[str, ...], update: list[str], stored: Callable[[DataFrame], DataFrame] = _stored,
) -> DataFrame:
    """First delivery as the table, second delivery as the upsert."""
    listed = [c for c in update if c != "erstellt_am"]
    rows = stored(rows)
    return merge.upsert(rows.where("batch_id = 1"), rows.where("batch_id = 2"), match, listed)


@query
def upsert_price(t: Tables) -> DataFrame:
    stg = merge.one_per_key(t.stg("STG_KV_KURS", arrival=True), ["isin", "kursdatum", "kurstyp", "boerse", "batch_id"],
                            on_duplicate="latest", order_by=ARRIVAL)
    vor = with_row_id(transforms.transform_kurse(stg, rates(t, "STG_KV_KURS"), spread_by=ARRIVAL))
    rows = facts.price_rows(vor, keys(t)).drop("kurs_hoch", "kurs_tief", "kurs_eroeffnung", "handelsvolumen",
                                               "umsatz_stueck")
    return _merged(rows, TABLES["FAKT_KURS"].unique, facts.PRICE_UPDATE)


@query
def upsert_fx(t: Tables) -> DataFrame:
    stg = merge.one_per_key(t.stg("STG_KV_WECHSELKURS"),
                            ["waehrung_von", "waehrung_nach", "kursdatum", "kurstyp", "batch_id"],
                            on_duplicate="latest", order_by=["stg_id"])
    rows = facts.fx_rows(with_row_id(transforms.transform_wechselkurse(stg)), keys(t))
    return _merged(rows, TABLES["FAKT_WECHSELKURS"].unique, facts.FX_UPDATE)


@query
def upsert_holding(t: Tables) -> DataFrame:
    """Larger tables go slice by slice: a portfolio, and so what is matched in it, lies in one slice."""
    with shuffles_dropped(t.spark):
        stg, eur, known = t.stg("STG_FB_BESTAND", arrival=True), rates(t, "STG_FB_BESTAND"), keys(t)
        n, small = slice_count(stg), fits_tasks(stg, GROUP)

    def merged(part: DataFrame, stored: Callable[[DataFrame], DataFrame]) -> DataFrame:
        vor = with_row_id(transforms.transform_bestaende(part, eur, order_by=ARRIVAL, stored=stored, small_groups=small))
        rows = facts.holding_rows(vor, known, pieces=math.ceil(PIECES / n)).drop("nominale")
        return comparable(_merged(rows, TABLES["FAKT_BESTAND"].unique, facts.HOLDING_UPDATE, stored))

    if n == 1:
        return merged(stg, _stored)
    known = facts.Keys(*[KeyTable(_stored(k.table), k.rows) for k in (known.wertpapier, known.fonds, known.waehrung, known.depot)])
    folder = f"{ensure_checkpoint_dir(t.spark)}/scheiben-{uuid.uuid4().hex}"
    return slice_by_slice(cut(stg, ["fonds_id", "bewertungsdatum"], n), merged, folder, Folders(t.spark).drop)


@query
def append_trade(t: Tables) -> DataFrame:
    vor = with_row_id(transforms.transform_transaktionen(t.stg("STG_FB_TRANSAKTION", arrival=True), rates(t, "STG_FB_TRANSAKTION"),
                                                         spread_by=ARRIVAL))
    rows = _stored(facts.trade_rows(vor, keys(t)).drop("nominale"))
    return merge.insert_if_absent(rows.where("batch_id = 1"), rows.where("batch_id = 2"),
                                  TABLES["FAKT_TRANSAKTION"].unique)


NEW_TRADES, REPEATED_MONTH = "2000-07-01", "1996-03"


@query
def append_by_key_filter(t: Tables) -> DataFrame:
    """A delivery of new trades and of a month delivered years ago: the key filters name that month only."""
    trades = t.stg("STG_FB_TRANSAKTION").withColumn("zeit_id_handel", zeit_id("handelsdatum"))
    store = Warehouse(t.spark, f"{ensure_checkpoint_dir(t.spark)}/lager-{uuid.uuid4().hex}")
    keys = TABLES["FAKT_TRANSAKTION"].unique
    store.write_months("FAKT_TRANSAKTION", trades.where(f"handelsdatum < '{NEW_TRADES}'"), "zeit_id_handel", replace=False)
    store.refresh_key_filters("FAKT_TRANSAKTION", keys)
    delivery = trades.where(f"handelsdatum >= '{NEW_TRADES}' OR date_format(handelsdatum, 'yyyy-MM') = '{REPEATED_MONTH}'")
    months = store.months_with_keys("FAKT_TRANSAKTION", delivery, keys)
    fresh = merge.insert_if_absent(store.read("FAKT_TRANSAKTION", months=months), delivery, keys)
    read = "alle" if months is None else ",".join(map(str, months))
    return fresh.select("transaktions_id", "fonds_id", "zeit_id_handel", F.lit(read).alias("gelesene_monate"))


@query
def append_flow(t: Tables) -> DataFrame:
    """Flows of the second batch, half of which were delivered before."""
    stg = t.stg("STG_FB_FONDSBEWEGUNG").withColumn(
        "bewegungs_id", F.floor(F.col("bewegungs_id").cast("bigint") / 3).cast("string"))
    vor = with_row_id(transforms.transform_fondsbewegungen(stg, rates(t, "STG_FB_FONDSBEWEGUNG"), spread_by=["bewegungs_id"]))
    rows = _stored(facts.flow_rows(vor, keys(t)))
    return merge.insert_if_absent(rows.where("batch_id = 1"), rows.where("batch_id = 2"),
                                  TABLES["FAKT_FONDSBEWEGUNG"].unique)


@query
def replace_batch(t: Tables) -> DataFrame:
    before = transforms.transform_wechselkurse(t.stg("STG_KV_WECHSELKURS"))
    again = transforms.transform_wechselkurse(t.stg("STG_KV_WECHSELKURS", broken=True).where("batch_id = 2"))
    return merge.replace_batch(before, again, 2).select(
        "batch_id", "waehrung_von", "kursdatum", "kurs", "ist_gueltig", "validierungsfehler")


@query
def unresolved_keys(t: Tables) -> DataFrame:
    vor = with_row_id(transforms.transform_fondsbewegungen(t.stg("STG_FB_FONDSBEWEGUNG"), rates(t, "STG_FB_FONDSBEWEGUNG"),
                                                           spread_by=["bewegungs_id"]))
    _, rejected = merge.split_unresolved(facts.flow_rows(vor, keys(t)), ["fonds_sk", "depot_sk"])
    return rejected.select("bewegungs_id", "fonds_id", "fehlende_schluessel")


# --- deliveries and whole runs --------------------------------------------

@query
def delta_with_watermark(t: Tables) -> DataFrame:
    """Two deliveries of securities by change time: the second repeats the first and brings late and new rows."""
    parts = t.raw("part").selectExpr(
        "p_partkey", f"{mapping.security_number('p_partkey')} AS isin", "p_name AS bezeichnung_lang",
        "timestamp '2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(p_partkey % 1000 AS int)) AS geaendert_am")
    funds_rows = _delivered(t.delivery("STG_WP_FONDS_STAMMDATEN", 2), "STG_WP_FONDS_STAMMDATEN")
    control = Control(t.spark, f"{ensure_checkpoint_dir(t.spark)}/lager-{uuid.uuid4().hex}",
                      delta={"STG_WP_STAMMDATEN": readers.Delta("geaendert_am", ("isin",), timedelta(minutes=60))})
    for batch, rows in ((1, parts.where("p_partkey % 1000 < 600 AND p_partkey % 10 <> 3")), (2, parts)):
        control.source = readers.FrameSource({
            "STG_WP_STAMMDATEN": _delivered(rows, "STG_WP_STAMMDATEN"), "STG_WP_FONDS_STAMMDATEN": funds_rows})
        control.load_source(staging.SOURCE_SYSTEMS[0], batch, RUN_DAY)
    return control.store.read("STG_WP_STAMMDATEN").select("batch_id", "isin", "bezeichnung_lang", "src_geaendert_am")



class _OnceUnreachable(readers.FrameSource):
    """Prices cannot be read the first time."""

    tries = 0

    def read(self, table: str) -> DataFrame:
        if table == "STG_KV_KURS":
            self.tries += 1
            if self.tries == 1:
                raise ConnectionError("Kursversorgung nicht erreichbar")
        return super().read(table)


@query
def warehouse_run(t: Tables) -> DataFrame:
    """The logs of a daily run that fails in one source system and is resumed: steps, then phases."""
    on_day = {"STG_FB_BESTAND": "bewertungsdatum", "STG_KV_KURS": "kursdatum", "STG_KV_WECHSELKURS": "kursdatum"}
    frames = {n: t.stg(n).where(F.col(c) == F.lit(RUN_DAY)) for n, c in on_day.items()}
    frames["STG_FB_TRANSAKTION"] = merge.one_per_key(
        t.stg("STG_FB_TRANSAKTION", arrival=True).where(F.col("handelsdatum") == F.lit(RUN_DAY)),
        ["transaktions_id", "fonds_id"], on_duplicate="latest", order_by=ARRIVAL)
    frames["STG_FB_FONDSBEWEGUNG"] = t.stg("STG_FB_FONDSBEWEGUNG").withColumn(
        "handelsdatum", F.date_add("handelsdatum", 1)).where(F.col("handelsdatum") == F.lit(RUN_DAY))
    for name in ("STG_WP_STAMMDATEN", "STG_WP_FONDS_STAMMDATEN"):
        frames[name] = t.delivery(name, 2)
    source = _OnceUnreachable({n: _delivered(rows, n) for n, rows in frames.items()})
    control = Control(t.spark, f"{ensure_checkpoint_dir(t.spark)}/lager-{uuid.uuid4().hex}", source,
                      on_duplicate="latest", on_unresolved="reject")
    control.install(RUN_DAY, RUN_DAY)
    try:
        control.run_daily_etl(RUN_DAY)
    except ConnectionError:
        control.resume()
    phases = control.process_log().select("phase", F.lit(None).cast("string").alias("tabelle"), "status",
                                          F.lit(None).cast("bigint").alias("anzahl_saetze"))
    return control.step_log().select("phase", "tabelle", "status", "anzahl_saetze").unionByName(phases)


# --- monitoring -----------------------------------------------------------

@query
def batch_status(t: Tables) -> DataFrame:
    return monitor.last_batch_status(t.log())


@query
def log_state(t: Tables) -> DataFrame:
    events = t.log().withColumns({"prozess_id": F.floor(F.col("prozess_id") / 3),
                                  "ereignis_nr": (F.col("log_id") % 3).cast("int")})
    return monitor.latest_events(events, "prozess_id").select("prozess_id", "log_id", "status")


@query
def quality_report(t: Tables) -> DataFrame:
    r = rates(t, *transforms.CONVERTED)
    tables = {
        "VOR_WERTPAPIER": transforms.transform_wertpapier(
            t.delivery("STG_WP_STAMMDATEN", 1, broken=True).unionByName(
                t.delivery("STG_WP_STAMMDATEN", 2, broken=True)), order_by=["isin"]),
        "VOR_FONDS": transforms.transform_fonds(
            t.delivery("STG_WP_FONDS_STAMMDATEN", 1, broken=True).unionByName(
                t.delivery("STG_WP_FONDS_STAMMDATEN", 2, broken=True)), order_by=["fonds_id"]),
        "VOR_WECHSELKURS": transforms.transform_wechselkurse(t.stg("STG_KV_WECHSELKURS", broken=True)),
        "VOR_KURS": transforms.transform_kurse(t.stg("STG_KV_KURS"), r, spread_by=["isin"]),
        "VOR_BESTAND": transforms.transform_bestaende(t.stg("STG_FB_BESTAND", arrival=True), r, order_by=ARRIVAL, stored=_stored),
        "VOR_TRANSAKTION": transforms.transform_transaktionen(t.stg("STG_FB_TRANSAKTION"), r, spread_by=["isin"]),
        "VOR_FONDSBEWEGUNG": transforms.transform_fondsbewegungen(t.stg("STG_FB_FONDSBEWEGUNG"), r,
                                                                  spread_by=["bewegungs_id"]),
    }
    report = monitor.quality_report(tables, with_fx=True)
    return report.join(monitor.verdict(report).select("batch_id", "ergebnis"), "batch_id")


@query
def process_log_view(t: Tables) -> DataFrame:
    return monitor.process_log_view(t.log(), RUN_TS.date())


@query
def load_log_view(t: Tables) -> DataFrame:
    return monitor.load_log_view(
        t.log().withColumnsRenamed({"prozessstart": "ladestart", "prozessende": "ladeende"}), RUN_TS)


@query
def phase_stats(t: Tables) -> DataFrame:
    return monitor.phase_stats(t.log())


@query
def phase_stats_like(t: Tables) -> DataFrame:
    """Phases chosen by a pattern, in which an underscore stands for any character."""
    return monitor.phase_stats(t.log(), like="_T%").drop("last_run_seconds")


@query
def invalid_rows(t: Tables) -> DataFrame:
    vor = with_verdict(t.stg("STG_FB_BESTAND", broken=True), rules.holding_rules())
    return monitor.invalid_rows(vor, "fonds_id", "isin", "bewertungsdatum")


RETENTION_TS = datetime(2024, 4, 15, 0, 0, 0)


@query
def retention(t: Tables) -> DataFrame:
    return retain(t.raw("events").selectExpr("event_id", "cast(ts AS timestamp) AS ts"), "ts", RETENTION_TS).select("event_id")


@query
def retention_batches(t: Tables) -> DataFrame:
    rows = t.raw("events").selectExpr(f"{mapping.floor_div('event_id', 50)} AS batch_id", "cast(ts AS timestamp) AS ts")
    return expired_batches(rows, "ts", RETENTION_TS).select("batch_id", "anzahl")


# --- integrity ------------------------------------------------------------

@query
def unique_violations(t: Tables) -> DataFrame:
    return integrity.unique_violations(t.stg("STG_FB_TRANSAKTION"), TABLES["VOR_TRANSAKTION"].unique)


@query
def unique_fact_violations(t: Tables) -> DataFrame:
    """The fact key of prices, with a missing exchange as a value of its own."""
    return integrity.unique_violations(t.stg("STG_KV_KURS"), ["isin", "kursdatum", "kurstyp", "boerse"])


@query
def fk_violations(t: Tables) -> DataFrame:
    flows = integrity.fk_violations(t.stg("STG_FB_FONDSBEWEGUNG"), "fonds_id", funds(t), "fonds_id")
    dated = t.stg("STG_FB_TRANSAKTION").selectExpr("cast(date_format(handelsdatum, 'yyyyMMdd') AS int) AS zeit_id")
    days = integrity.fk_violations(dated, "zeit_id", calendar(t.spark), "zeit_id")
    return flows.selectExpr("'fonds_id' AS spalte", "wert", "anzahl").unionByName(
        days.selectExpr("'zeit_id' AS spalte", "cast(wert AS string) AS wert", "anzahl"))


@query
def check_violations(t: Tables) -> DataFrame:
    return integrity.column_violations(t.stg("STG_FB_TRANSAKTION", broken=True), TABLES["STG_FB_TRANSAKTION"])


@query
def reference_violations(t: Tables) -> DataFrame:
    """All foreign keys of the trade facts; the calendar ends early and some funds are unknown."""
    vor = with_row_id(transforms.transform_transaktionen(t.stg("STG_FB_TRANSAKTION", arrival=True), rates(t, "STG_FB_TRANSAKTION"), spread_by=ARRIVAL))
    parents = {
        "DIM_ZEIT": lambda: calendar(t.spark, date(1992, 1, 1), date(1996, 12, 31)),
        "DIM_FONDS": lambda: funds(t).where("fonds_sk <= 5"), "DIM_WERTPAPIER": lambda: securities(t),
        "DIM_DEPOT": lambda: depots(t), "DIM_WAEHRUNG": lambda: seeds.currencies(t.spark, RUN_TS),
    }
    return integrity.reference_violations(facts.trade_rows(vor, keys(t)), TABLES["FAKT_TRANSAKTION"], lambda name: parents[name]())


@query
def row_violations(t: Tables) -> DataFrame:
    """The trades that break a rule of their layout, with the rules."""
    rows = t.stg("STG_FB_TRANSAKTION", broken=True, arrival=True)
    return integrity.row_violations(rows, TABLES["STG_FB_TRANSAKTION"]).select("l_orderkey", "l_linenumber", "regeln")


@query
def allowed_value_violations(t: Tables) -> DataFrame:
    bad = integrity.allowed_violations(t.log(), "status", ("GESTARTET", "FEHLER"))
    return bad.select("prozess_id", "status")


@query
def current_row_violations(t: Tables) -> DataFrame:
    return integrity.current_row_violations(depots(t), "depot_nr")


@query
def interval_violations(t: Tables) -> DataFrame:
    """Two loads on one day close a version before it began."""
    return integrity.interval_violations(_security_loads(t, FIRST_LOAD), "isin")
