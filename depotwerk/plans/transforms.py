"""Layer 1 -> layer 2: deduplicate, validate, normalise, convert to EUR.

Each function takes staging rows of one or many batches and returns the
business columns of its ``VOR_`` table; ids and processing time are added on
write.  Rejected rows are kept and flagged.  ``rates`` holds the result of
:func:`depotwerk.operators.fx.eur_rates` for the rows' own requests.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import canonical, clean, flow_type, rules, trade_type, with_verdict
from ..operators.dedupe import latest
from ..operators.fx import in_eur, rate_requests, with_eur_rate
from ..operators.joins import ROWS_PER_PIECE, fits_tasks
from ..operators.weights import GROUP, with_portfolio_weight
from ..schemas import TABLES

MASTER_DATA = "WERTPAPIERSTAMMDATEN"


@dataclass(frozen=True)
class Rates:
    """EUR rate table with its known size, shared by the conversions of a run."""

    table: DataFrame
    rows: int | None = None


# The staged tables that are converted: currency and date that ask for the rate.
CONVERTED = {
    "STG_KV_KURS": ("waehrung", "kursdatum"),
    "STG_FB_BESTAND": ("waehrung_fonds", "bewertungsdatum"),
    "STG_FB_TRANSAKTION": ("waehrung", "handelsdatum"),
    "STG_FB_FONDSBEWEGUNG": ("waehrung", "handelsdatum"),
}


def requested_rates(staged: Mapping[str, DataFrame]) -> DataFrame:
    """The different rates that the rows of some staged tables ask for."""
    asked = [rate_requests(rows, canonical(CONVERTED[name][0]), CONVERTED[name][1]) for name, rows in staged.items()]
    return reduce(DataFrame.unionByName, asked).distinct()


def _project(df: DataFrame, table: str, computed: dict[str, Column]) -> DataFrame:
    """Columns of a target table: computed ones, the rest carried over, all in target types."""
    layout = TABLES[table]
    return df.withColumns(computed).to(layout.schema_without(layout.id_column, layout.time_column))


def _tidy(rows: DataFrame, texts: Sequence[str], codes: Sequence[str]) -> dict[str, Column]:
    """Trimmed texts and upper-case codes, for the columns a delivery has."""
    have = set(rows.columns)
    return {**{c: clean(c) for c in texts if c in have}, **{c: canonical(c) for c in codes if c in have}}


# Unique keys of the tables that are not deduplicated on their own, as they
# look after normalisation.
CANONICAL_KEYS = {
    "VOR_WECHSELKURS": ("waehrung_von", "waehrung_nach", "kurstyp"),
    "VOR_KURS": ("kurstyp",),
    "VOR_TRANSAKTION": (),
    "VOR_FONDSBEWEGUNG": (),
}


def latest_delivery(stg: DataFrame, target: str, order_by: Sequence[str] = ("stg_id",)) -> DataFrame:
    """Keep the latest staged row per unique key of ``target``; NULL key parts count as equal."""
    codes = CANONICAL_KEYS[target]
    marks = {
        f"__k_{c}": F.struct(canonical(c) if c in codes else F.col(c)) for c in TABLES[target].unique
    }
    return latest(stg.withColumns(marks), list(marks), order_by).drop(*marks)


def transform_wertpapier(stg: DataFrame, *, order_by: Sequence[str] = ("stg_id",)) -> DataFrame:
    """Securities: latest row per ISIN and batch."""
    rows = with_verdict(latest(stg, ["isin", "batch_id"], order_by), rules.security_rules())
    texts = ["bezeichnung_lang", "bezeichnung_kurz", "emittent_name", "branche", "branche_code", "hauptboerse"]
    codes = ["wertpapiertyp", "asset_klasse", "sub_asset_klasse", "nominalwaehrung", "fondstyp",
             "ausschuettungsart", "handelswaehrung", "notizwaehrung"]
    return _project(rows, "VOR_WERTPAPIER", {
        **_tidy(rows, texts, codes),
        "land_iso3": canonical("land_emittent"),
        "quellsystem": F.lit(MASTER_DATA),
    })


def transform_fonds(stg: DataFrame, *, order_by: Sequence[str] = ("stg_id",)) -> DataFrame:
    """Funds: latest row per fund and batch."""
    rows = with_verdict(latest(stg, ["fonds_id", "batch_id"], order_by), rules.fund_rules())
    texts = ["fondsname", "fondsname_kurz", "investmentstrategie", "kag_name", "verwahrstelle",
             "rechtliche_struktur"]
    codes = ["fondstyp", "asset_klasse", "fondswaehrung", "domizil_land", "ucits_konform", "status"]
    return _project(rows, "VOR_FONDS", {
        **_tidy(rows, texts, codes),
        "quellsystem": F.lit(MASTER_DATA),
    })


def transform_wechselkurse(stg: DataFrame) -> DataFrame:
    """Exchange rates: validated, not deduplicated."""
    rows = with_verdict(stg, rules.fx_rules())
    codes = ["waehrung_von", "waehrung_nach", "kurstyp"]
    return _project(rows, "VOR_WECHSELKURS", {c: canonical(c) for c in codes})


def transform_kurse(stg: DataFrame, rates: Rates, *, spread_by: Sequence[str] = ("stg_id",)) -> DataFrame:
    """Prices with their EUR value, not deduplicated."""
    rows = with_eur_rate(
        with_verdict(stg, rules.price_rules()), rates.table, rate_rows=rates.rows,
        currency=canonical("waehrung"), on_date="kursdatum", spread_by=list(spread_by),
    )
    return _project(rows, "VOR_KURS", {
        "kurstyp": canonical("kurstyp"),
        "waehrung": canonical("waehrung"),
        "kurs_in_eur": in_eur(F.col("kurs"), scale_type="decimal(20,6)"),
    })


def weighted_positions(
    stg: DataFrame,
    *,
    key: Sequence[str] = ("fonds_id", "isin", "bewertungsdatum", "batch_id"),
    order_by: Sequence[str] = ("stg_id",),
    stored: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    rows_per_task: int = ROWS_PER_PIECE,
    small_groups: bool | None = None,
) -> DataFrame:
    """Latest row per position with its verdict and portfolio weight.

    The rows of every portfolio are counted first, unless the caller has done
    so and says whether all are small (``small_groups``).  Where none has more than
    ``rows_per_task``, the rows move once, by portfolio, and are deduplicated
    and summed there.  Otherwise a repeated key is reduced before the shuffle
    and the totals are joined; the deduplicated rows are then used twice, for
    the totals and for the rows that take their share, and ``stored`` writes
    them once in between.
    """
    if set(GROUP) <= set(key) and (fits_tasks(stg, GROUP, rows_per_task) if small_groups is None else small_groups):
        # in this order one sort serves the position and its portfolio
        by_portfolio = [*GROUP, *(c for c in key if c not in GROUP)]
        rows = with_verdict(latest(stg.repartition(*GROUP), by_portfolio, order_by), rules.holding_rules())
        return with_portfolio_weight(rows, small_groups=True)
    rows = stored(with_verdict(latest(stg, key, order_by), rules.holding_rules()))
    return with_portfolio_weight(rows, spread_by=["isin", *order_by])


def transform_bestaende(
    stg: DataFrame,
    rates: Rates,
    *,
    key: Sequence[str] = ("fonds_id", "isin", "bewertungsdatum", "batch_id"),
    order_by: Sequence[str] = ("stg_id",),
    stored: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    rows_per_task: int = ROWS_PER_PIECE,
    small_groups: bool | None = None,
) -> DataFrame:
    """Holdings: latest row per position, EUR value, portfolio weight.

    The default key ignores the custody account, so one security in two
    accounts keeps only its latest row; pass a longer ``key`` to change that.
    """
    rows = weighted_positions(
        stg, key=key, order_by=order_by, stored=stored, rows_per_task=rows_per_task, small_groups=small_groups)
    rows = with_eur_rate(
        rows, rates.table, rate_rows=rates.rows,
        currency=canonical("waehrung_fonds"), on_date="bewertungsdatum", spread_by=["isin", *order_by],
    )
    return _project(rows, "VOR_BESTAND", {
        "marktwert_eur": in_eur(F.col("marktwert_fondswaehrung")),
        "waehrung_papier": canonical("waehrung_papier"),
        "waehrung_fonds": canonical("waehrung_fonds"),
    })


def trade_amounts() -> dict[str, Column]:
    """Defaults of a trade.  The EUR amount falls back to value plus fee, without accrued interest."""
    zero = F.lit(0).cast("decimal(20,2)")
    value, fee, accrued = (F.coalesce(c, zero) for c in ("transaktionswert", "provision", "stueckzinsen"))
    return {
        "buchungsdatum": F.coalesce("buchungsdatum", "valutatdatum"),
        "provision": fee,
        "stueckzinsen": accrued,
        "gesamtbetrag": F.coalesce(F.col("gesamtbetrag"), (value + fee + accrued).cast("decimal(20,2)")),
        "eur_basis": F.coalesce(F.col("gesamtbetrag"), (value + fee).cast("decimal(20,2)")),
    }


def flow_amounts() -> dict[str, Column]:
    """Defaults of a fund flow.  The load is a rate but is kept with two decimals."""
    return {
        "buchungsdatum": F.coalesce("buchungsdatum", "valutatdatum"),
        "nettobetrag": F.coalesce("nettobetrag", "bruttobetrag"),
        "ausgabeaufschlag": F.coalesce(F.col("ausgabeaufschlag"), F.lit(0).cast("decimal(10,4)")),
    }


def transform_transaktionen(stg: DataFrame, rates: Rates, *, spread_by: Sequence[str] = ("stg_id",)) -> DataFrame:
    """Trades: normalised type, defaults, EUR total; not deduplicated."""
    rows = with_eur_rate(
        with_verdict(stg, rules.trade_rules()), rates.table, rate_rows=rates.rows,
        currency=canonical("waehrung"), on_date="handelsdatum", spread_by=list(spread_by),
    )
    amounts = trade_amounts()
    basis = amounts.pop("eur_basis")
    return _project(rows, "VOR_TRANSAKTION", {
        **amounts,
        "transaktionstyp": canonical("transaktionstyp"),
        "transaktionstyp_normiert": trade_type("transaktionstyp"),
        "waehrung": canonical("waehrung"),
        "gesamtbetrag_eur": in_eur(basis),
    })


def transform_fondsbewegungen(stg: DataFrame, rates: Rates, *, spread_by: Sequence[str] = ("stg_id",)) -> DataFrame:
    """Fund flows: normalised type, defaults, EUR net amount; not deduplicated."""
    rows = with_eur_rate(
        with_verdict(stg, rules.flow_rules()), rates.table, rate_rows=rates.rows,
        currency=canonical("waehrung"), on_date="handelsdatum", spread_by=list(spread_by),
    )
    amounts = flow_amounts()
    return _project(rows, "VOR_FONDSBEWEGUNG", {
        **amounts,
        "bewegungstyp": canonical("bewegungstyp"),
        "bewegungstyp_normiert": flow_type("bewegungstyp"),
        "waehrung": canonical("waehrung"),
        "nettobetrag_eur": in_eur(amounts["nettobetrag"]),
    })
