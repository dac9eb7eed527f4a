"""The queries of :mod:`queries` as plain SQL, for a result comparison in DuckDB."""

from __future__ import annotations

from . import mapping
from .mapping import ARRIVAL, columns, select_list

CODE = "upper(nullif(trim({}), ''))"


def code(c: str) -> str:
    return CODE.format(c)


def out(*items: str) -> str:
    """Select list; ``:n`` double, ``:d`` ISO date, ``:i`` bigint, otherwise as is."""
    parts = []
    for item in items:
        c, _, kind = item.partition(":")
        parts.append({
            "n": f"cast({c} AS double) AS {c}",
            "d": f"cast(cast({c} AS date) AS varchar) AS {c}",
            "i": f"cast({c} AS bigint) AS {c}",
            "": c,
        }[kind])
    return ", ".join(parts)


def _from(table: str) -> str:
    return {
        "STG_FB_BESTAND": "lineitem JOIN supplier ON l_suppkey = s_suppkey",
        "STG_FB_TRANSAKTION": "orders JOIN lineitem ON o_orderkey = l_orderkey",
        "STG_KV_WECHSELKURS": "orders",
        "STG_KV_KURS": "lineitem",
        "STG_FB_FONDSBEWEGUNG": "events",
        "STG_WP_STAMMDATEN": "part",
        "STG_WP_FONDS_STAMMDATEN": "supplier",
    }[table]


def stg(table: str, broken: bool = False, arrival: bool = False) -> str:
    extra = ARRIVAL if arrival else []
    return f"SELECT {', '.join(select_list(columns(table, broken=broken)) + extra)} FROM {_from(table)}"


def delivery(table: str, number: int, broken: bool = False) -> str:
    cols = select_list({"batch_id": str(number), **columns(table, second=number == 2, broken=broken)})
    where = f" WHERE NOT ({mapping.MISSING_FIRST[table]})" if number == 1 else ""
    return f"SELECT {', '.join(cols)} FROM {_from(table)}{where}"


def deliveries(table: str, broken: bool = False) -> str:
    return f"{delivery(table, 1, broken)} UNION ALL {delivery(table, 2, broken)}"


NEWEST = ", ".join(f"{c} DESC" for c in ARRIVAL)


def latest(source: str, keys: str, order: str = NEWEST, null_keys: bool = False) -> str:
    drop = "" if null_keys else " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(",")) + " AND "
    return (f"SELECT * FROM {source} WHERE {drop or ''}true "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1")


ISIN_ERROR = """CASE WHEN isin IS NULL THEN 'ISIN fehlt'
  WHEN length(isin) <> 12 THEN 'ISIN muss 12 Zeichen lang sein (aktuell: ' || length(isin) || ')'
  WHEN NOT regexp_full_match(isin, '[A-Z]{2}[A-Z0-9]{9}[0-9]')
  THEN 'ISIN hat ungueltiges Format (erwartet: 2 Grossbuchstaben + 9 alphanum + 1 Ziffer)' END"""

ERRORS = {
    "holding": f"""CASE WHEN fonds_id IS NULL THEN 'Fonds-ID fehlt'
        WHEN ({ISIN_ERROR}) IS NOT NULL THEN 'Ungueltige ISIN: ' || ({ISIN_ERROR})
        WHEN bewertungsdatum IS NULL THEN 'Bewertungsdatum fehlt' WHEN marktwert IS NULL THEN 'Marktwert fehlt' END""",
    "trade": f"""CASE WHEN transaktions_id IS NULL THEN 'Transaktions-ID fehlt'
        WHEN fonds_id IS NULL THEN 'Fonds-ID fehlt'
        WHEN ({ISIN_ERROR}) IS NOT NULL THEN 'Ungueltige ISIN: ' || ({ISIN_ERROR})
        WHEN handelsdatum IS NULL THEN 'Handelsdatum fehlt'
        WHEN transaktionstyp IS NULL THEN 'Transaktionstyp fehlt' END""",
    "flow": """CASE WHEN bewegungs_id IS NULL THEN 'Bewegungs-ID fehlt' WHEN fonds_id IS NULL THEN 'Fonds-ID fehlt'
        WHEN handelsdatum IS NULL THEN 'Handelsdatum fehlt' WHEN anteile IS NULL THEN 'Anteile fehlen' END""",
    "price": f"""CASE WHEN ({ISIN_ERROR}) IS NOT NULL THEN 'Ungueltige ISIN: ' || ({ISIN_ERROR})
        WHEN kurs IS NULL OR kurs < 0 THEN 'Kurs ungueltig (NULL oder negativ)'
        WHEN waehrung IS NULL THEN 'Waehrung fehlt' END""",
    "fx": """CASE WHEN kurs IS NULL OR kurs <= 0 THEN 'Kurs muss groesser als 0 sein'
        WHEN waehrung_von IS NULL THEN 'Quellwaehrung fehlt' WHEN waehrung_nach IS NULL THEN 'Zielwaehrung fehlt' END""",
    "security": f"""CASE WHEN ({ISIN_ERROR}) IS NOT NULL THEN 'ISIN ungueltig: ' || ({ISIN_ERROR})
        WHEN bezeichnung_lang IS NULL THEN 'Bezeichnung fehlt'
        WHEN wertpapiertyp IS NULL THEN 'Wertpapiertyp fehlt' END""",
    "fund": """CASE WHEN fonds_id IS NULL THEN 'Fonds-ID fehlt' WHEN fondsname IS NULL THEN 'Fondsname fehlt'
        WHEN fondstyp IS NULL THEN 'Fondstyp fehlt' WHEN fondswaehrung IS NULL THEN 'Fondswaehrung fehlt' END""",
}


def judged(source: str, kind: str) -> str:
    return (f"SELECT *, CASE WHEN validierungsfehler IS NULL THEN 'J' ELSE 'N' END AS ist_gueltig "
            f"FROM (SELECT *, {ERRORS[kind]} AS validierungsfehler FROM {source})")


def validate(table: str, kind: str, *show: str, source: str | None = None) -> str:
    return (f"WITH s AS ({source or stg(table, broken=True)}), j AS ({judged('s', kind)}) "
            f"SELECT {out(*show, 'ist_gueltig', 'validierungsfehler')} FROM j")


TRADE_TYPE = """CASE WHEN upper(trim(transaktionstyp)) IN ('KAUF', 'KAUFAUFTRAG', 'BUY', 'PURCHASE') THEN 'KAUF'
  WHEN upper(trim(transaktionstyp)) IN ('VERKAUF', 'VERKAUFSAUFTRAG', 'SELL', 'SALE') THEN 'VERKAUF'
  WHEN upper(trim(transaktionstyp)) IN ('TAUSCH', 'SWAP') THEN 'TAUSCH' ELSE 'SONSTIGE' END"""
FLOW_TYPE = """CASE WHEN upper(trim(bewegungstyp)) IN ('AUSGABE', 'ZEICHNUNG', 'SUBSCRIPTION') THEN 'ZUFLUSS'
  WHEN upper(trim(bewegungstyp)) IN ('RUECKNAHME', 'REDEMPTION', 'RUECKGABE') THEN 'ABFLUSS' ELSE 'NEUTRAL' END"""

FX = f"fx AS ({stg('STG_KV_WECHSELKURS')})"


def fx_best(requests: str, lookback: int = 5) -> str:
    """CTEs ``req`` and ``best`` (batch_id, ccy, datum, kurs) over a request list."""
    return f"""req AS MATERIALIZED (SELECT DISTINCT batch_id, ccy, datum FROM ({requests})),
    quote AS MATERIALIZED (SELECT {code('waehrung_von')} AS ccy, kursdatum, batch_id AS b, cast(kurs AS decimal(15,8)) AS kurs,
        CASE WHEN {code('kurstyp')} = 'EZB' THEN 1 ELSE 0 END AS ezb, stg_id
        FROM fx WHERE {code('waehrung_nach')} = 'EUR'),
    same AS MATERIALIZED (SELECT ccy, kursdatum, b, kurs FROM quote
        QUALIFY row_number() OVER (PARTITION BY ccy, kursdatum, b ORDER BY ezb DESC, stg_id DESC) = 1),
    tag AS MATERIALIZED (SELECT ccy, kursdatum, kurs FROM quote
        QUALIFY row_number() OVER (PARTITION BY ccy, kursdatum ORDER BY ezb DESC, b DESC, stg_id DESC) = 1),
    best AS MATERIALIZED (SELECT r.batch_id, r.ccy, r.datum,
            coalesce(same.kurs, CASE WHEN r.datum - tag.kursdatum <= {lookback} THEN tag.kurs END) AS kurs
        FROM req r ASOF LEFT JOIN tag ON tag.ccy = r.ccy AND r.datum >= tag.kursdatum
        LEFT JOIN same ON same.ccy = r.ccy AND same.kursdatum = r.datum AND same.b = r.batch_id)"""


def rated(source: str, ccy: str, datum: str, name: str = "r") -> str:
    """CTEs up to ``name``: the source with ``wechselkurs_eur``."""
    return (fx_best(f"SELECT batch_id, {code(ccy)} AS ccy, {datum} AS datum FROM {source}") +
            f""", {name} AS (SELECT s.*, CASE WHEN {code('s.' + ccy)} = 'EUR' THEN cast(1 AS decimal(15,8))
            ELSE best.kurs END AS wechselkurs_eur FROM {source} s LEFT JOIN best
            ON best.batch_id = s.batch_id AND best.ccy = {code('s.' + ccy)} AND best.datum = s.{datum})""")


REQUESTS = (f"SELECT batch_id, {code('waehrung_fonds')} AS ccy, bewertungsdatum AS datum FROM b "
            f"UNION SELECT batch_id, {code('waehrung')} AS ccy, handelsdatum AS datum FROM f")
REQUEST_INPUT = f"b AS ({stg('STG_FB_BESTAND')}), f AS ({stg('STG_FB_FONDSBEWEGUNG')})"

FX_ASOF = f"""WITH {FX}, {REQUEST_INPUT}, {fx_best(REQUESTS)}
    SELECT req.batch_id, req.ccy AS waehrung, cast(req.datum AS varchar) AS datum,
        cast(CASE WHEN req.ccy = 'EUR' THEN 1 ELSE best.kurs END AS double) AS wechselkurs_eur
    FROM req LEFT JOIN best USING (batch_id, ccy, datum)"""

FX_LONG = f"""WITH fx AS ({stg('STG_KV_WECHSELKURS')} WHERE o_orderkey % 1000 < 10), {REQUEST_INPUT}, {fx_best(REQUESTS, 400)}
    SELECT req.batch_id, req.ccy AS waehrung, cast(req.datum AS varchar) AS datum,
        cast(CASE WHEN req.ccy = 'EUR' THEN 1 ELSE best.kurs END AS double) AS wechselkurs_eur
    FROM req LEFT JOIN best USING (batch_id, ccy, datum)"""

# exact tier: same batch and day; then newest day; direct before inverse, EZB first
FX_INVERSE = f"""WITH {FX}, {REQUEST_INPUT}, req AS ({REQUESTS}),
    quote AS (
      SELECT {code('waehrung_von')} AS ccy, kursdatum, batch_id AS b, stg_id, stg_id % 2 AS direkt,
        CASE WHEN {code('kurstyp')} = 'EZB' THEN 1 ELSE 0 END AS ezb,
        CASE WHEN stg_id % 2 = 1 THEN cast(kurs AS decimal(15,8))
          ELSE cast(cast((cast(20000000000000000 AS hugeint) + cast(kurs * 100000000 AS hugeint)) // (2 * cast(kurs * 100000000 AS hugeint)) AS decimal(20,0))
            * cast(0.00000001 AS decimal(9,8)) AS decimal(15,8)) END AS kurs
      FROM fx),
    best AS (SELECT r.batch_id, r.ccy, r.datum, q.kurs FROM req r JOIN quote q
        ON q.ccy = r.ccy AND q.kursdatum BETWEEN r.datum - 2 AND r.datum
        QUALIFY row_number() OVER (PARTITION BY r.batch_id, r.ccy, r.datum ORDER BY
            CASE WHEN q.kursdatum = r.datum AND q.b = r.batch_id THEN 1 ELSE 0 END DESC,
            q.kursdatum DESC, direkt DESC, ezb DESC, q.b DESC, stg_id DESC) = 1)
    SELECT req.batch_id, req.ccy AS waehrung, cast(req.datum AS varchar) AS datum,
        cast(CASE WHEN req.ccy = 'EUR' THEN 1 ELSE best.kurs END AS double) AS wechselkurs_eur
    FROM req LEFT JOIN best USING (batch_id, ccy, datum)"""

# --- dimensions as in the queries ------------------------------------------
CURRENCY = "cur AS (SELECT * FROM (VALUES ('EUR',1),('USD',2),('CHF',3),('GBP',4),('JPY',5),('SEK',6),('NOK',7),('DKK',8)) v(iso, id))"
COUNTRY = "land AS (SELECT * FROM (VALUES ('DEU',1),('AUT',2),('CHE',3),('USA',4),('GBR',5),('JPN',6),('LUX',7),('IRL',8)) v(iso, id))"
SECTOR = """sektor AS (SELECT * FROM (VALUES ('10','ENERGIE',1),('15','ROHSTOFF',2),('20','INDUSTRIE',3),
    ('25','KONSUM_ZY',4),('30','KONSUM_ST',5),('35','GESUNDH',6),('40','FINANZ',7),('45','IT',8),('50','TELEKOM',9),
    ('55','VERSORGER',10),('60','IMMOBILIEN',11)) v(gics, intern, id))"""
SECURITIES = f"wp AS (SELECT {mapping.security_number('p_partkey')} AS isin, p_partkey * 2 + 1 AS sk FROM part)"
FUNDS = f"fo AS (SELECT {mapping.fund_number('s_suppkey')} AS fonds_id, s_suppkey + 1 AS sk FROM supplier)"
DEPOTS = "de AS (SELECT DISTINCT 'DEPOT' || cast(user_id % 13 AS varchar) AS depot_nr, user_id % 13 * 2 + 1 AS sk FROM events)"
DIMS = f"{CURRENCY}, {SECURITIES}, {FUNDS}, {DEPOTS}"


def zeit(d: str) -> str:
    return f"cast(strftime({d}, '%Y%m%d') AS bigint)"


# --- validated tables as CTEs ------------------------------------------------
HOLDING_KEYS = "fonds_id, isin, bewertungsdatum, batch_id"
WEIGHT = """CASE WHEN ist_gueltig <> 'J' THEN 0 WHEN summe = 0 THEN 0 ELSE
    cast((cast(marktwert_fondswaehrung * 100 AS hugeint) * 200000000 + cast(summe * 100 AS hugeint))
        // (2 * cast(summe * 100 AS hugeint)) AS double) / 1000000 END"""
HOLDINGS = f"""raw AS ({stg('STG_FB_BESTAND', arrival=True)}), d AS ({latest('raw', HOLDING_KEYS)}),
    j AS ({judged('d', 'holding')}),
    tot AS (SELECT fonds_id, bewertungsdatum, batch_id, sum(marktwert_fondswaehrung) AS summe FROM j
        WHERE ist_gueltig = 'J' GROUP BY ALL),
    w AS (SELECT j.*, {WEIGHT} AS portfoliogewicht FROM j LEFT JOIN tot USING (fonds_id, bewertungsdatum, batch_id)),
    {FX}, {rated('w', 'waehrung_fonds', 'bewertungsdatum')},
    vb AS (SELECT * REPLACE ({code('waehrung_fonds')} AS waehrung_fonds, {code('waehrung_papier')} AS waehrung_papier),
        cast(marktwert_fondswaehrung * wechselkurs_eur AS decimal(20,2)) AS marktwert_eur FROM r)"""


def prices(raw: str) -> str:
    return f"""raw AS ({raw}), j AS ({judged('raw', 'price')}), {FX}, {rated('j', 'waehrung', 'kursdatum')},
    vk AS (SELECT * REPLACE ({code('waehrung')} AS waehrung, {code('kurstyp')} AS kurstyp),
        cast(kurs * wechselkurs_eur AS decimal(20,6)) AS kurs_in_eur FROM r)"""


TRADES = f"""raw AS ({stg('STG_FB_TRANSAKTION')}), j AS ({judged('raw', 'trade')}), {FX},
    {rated('j', 'waehrung', 'handelsdatum')},
    vt AS (SELECT * REPLACE ({code('waehrung')} AS waehrung, {code('transaktionstyp')} AS transaktionstyp,
        coalesce(buchungsdatum, valutatdatum) AS buchungsdatum, coalesce(provision, 0) AS provision,
        coalesce(stueckzinsen, 0) AS stueckzinsen,
        coalesce(gesamtbetrag, coalesce(transaktionswert, 0) + coalesce(provision, 0) + coalesce(stueckzinsen, 0)) AS gesamtbetrag),
        {TRADE_TYPE} AS transaktionstyp_normiert,
        cast(cast(coalesce(gesamtbetrag, coalesce(transaktionswert, 0) + coalesce(provision, 0)) AS decimal(20,2))
            * wechselkurs_eur AS decimal(20,2)) AS gesamtbetrag_eur FROM r)"""


def flows(raw: str) -> str:
    return f"""raw AS ({raw}), j AS ({judged('raw', 'flow')}), {FX}, {rated('j', 'waehrung', 'handelsdatum')},
    vf AS (SELECT * REPLACE ({code('waehrung')} AS waehrung, {code('bewegungstyp')} AS bewegungstyp,
        coalesce(buchungsdatum, valutatdatum) AS buchungsdatum, coalesce(nettobetrag, bruttobetrag) AS nettobetrag,
        cast(coalesce(ausgabeaufschlag, 0) AS decimal(20,2)) AS ausgabeaufschlag),
        {FLOW_TYPE} AS bewegungstyp_normiert,
        cast(coalesce(nettobetrag, bruttobetrag) * wechselkurs_eur AS decimal(20,2)) AS nettobetrag_eur FROM r)"""


FLOWS = flows(stg("STG_FB_FONDSBEWEGUNG"))


def security_vor(source: str) -> str:
    return f"""s AS ({source}), d AS ({latest('s', 'isin, batch_id', 'isin')}), j AS ({judged('d', 'security')}),
    vw AS (SELECT batch_id, isin, nullif(trim(bezeichnung_lang), '') AS bezeichnung_lang,
        {code('wertpapiertyp')} AS wertpapiertyp, {code('asset_klasse')} AS asset_klasse,
        nullif(trim(emittent_name), '') AS emittent_name, {code('land_emittent')} AS land_iso3,
        nullif(trim(branche_code), '') AS branche_code, nominalwert, faelligkeitsdatum,
        {code('handelswaehrung')} AS handelswaehrung, ist_gueltig, validierungsfehler,
        'WERTPAPIERSTAMMDATEN' AS quellsystem FROM j)"""


def fund_vor(source: str) -> str:
    return f"""s AS ({source}), d AS ({latest('s', 'fonds_id, batch_id', 'fonds_id')}), j AS ({judged('d', 'fund')}),
    vo AS (SELECT batch_id, fonds_id, nullif(trim(fondsname), '') AS fondsname, {code('fondstyp')} AS fondstyp,
        investmentstrategie, {code('fondswaehrung')} AS fondswaehrung, kag_name, {code('domizil_land')} AS domizil_land,
        ist_gueltig, validierungsfehler, 'WERTPAPIERSTAMMDATEN' AS quellsystem FROM j)"""

SECTOR_ID = """(SELECT min(x.id) FROM sektor x WHERE x.gics = {c} OR x.intern = upper(trim({c})))"""


def scd2(vor: str, rows: str, key: str, attributes: list[str], tracked: list[str], second: str, show: list[str]) -> str:
    """Two deliveries through a type-2 dimension, written with plain joins."""
    differs = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in tracked)
    attrs = ", ".join(attributes)
    a_attrs = ", ".join(f"a.{c}" for c in attributes)
    return f"""WITH {vor}, {CURRENCY}, {COUNTRY}, {SECTOR}, v AS ({rows}),
    a AS (SELECT * FROM v WHERE batch_id = 1), b AS (SELECT * FROM v WHERE batch_id = 2),
    g AS (SELECT a.{key} AS k, b.{key} IS NOT NULL AND ({differs}) AS neu FROM a LEFT JOIN b USING ({key})),
    dim AS (
      SELECT a.{key}, {a_attrs}, 1 AS dwh_version, DATE '2024-01-01' AS gueltig_von,
        CASE WHEN g.neu THEN DATE '{second}' - 1 ELSE DATE '9999-12-31' END AS gueltig_bis,
        CASE WHEN g.neu THEN 'N' ELSE 'J' END AS ist_aktuell, 1 AS batch_id_erstellt,
        CASE WHEN g.neu THEN 2 ELSE 1 END AS batch_id_geaendert FROM a JOIN g ON g.k = a.{key}
      UNION ALL
      SELECT {key}, {attrs}, CASE WHEN {key} IN (SELECT k FROM g) THEN 2 ELSE 1 END, DATE '{second}',
        DATE '9999-12-31', 'J', 2, 2 FROM b WHERE {key} NOT IN (SELECT k FROM g WHERE NOT neu))
    SELECT {out(*show)} FROM dim"""


SECURITY_ROWS = f"""SELECT vw.*, (SELECT id FROM land WHERE iso = land_iso3) AS land_id,
    {SECTOR_ID.format(c='branche_code')} AS branche_id, (SELECT id FROM cur WHERE iso = handelswaehrung) AS waehrung_id
    FROM vw WHERE ist_gueltig = 'J'"""
FUND_ROWS = """SELECT vo.*, (SELECT id FROM cur WHERE iso = fondswaehrung) AS fondswaehrung_id,
    (SELECT id FROM land WHERE iso = domizil_land) AS domizil_land_id FROM vo WHERE ist_gueltig = 'J'"""
SECURITY_ATTRS = ["bezeichnung_lang", "wertpapiertyp", "asset_klasse", "emittent_name", "land_id", "branche_id",
                  "waehrung_id", "faelligkeitsdatum"]
SECURITY_TRACKED = ["bezeichnung_lang", "wertpapiertyp", "asset_klasse", "emittent_name", "land_id",
                    "faelligkeitsdatum"]
SECURITY_TWO = security_vor(deliveries("STG_WP_STAMMDATEN"))

DAY_NAMES = "['Montag','Dienstag','Mittwoch','Donnerstag','Freitag','Samstag','Sonntag']"
MONTH_NAMES = ("['Januar','Februar','März','April','Mai','Juni','Juli','August','September','Oktober',"
               "'November','Dezember']")

LOG = f"""lg AS (SELECT {', '.join(select_list(mapping.LOG))}, ts AS prozessstart, CASE event_type WHEN 'view' THEN NULL
    ELSE ts + to_microseconds(cast(round(value * 1000000) AS bigint)) END AS prozessende FROM events)"""


def elapsed(unit: int) -> str:
    """Half-up division of whole microseconds, two decimals."""
    us = "(epoch_us(prozessende) - epoch_us(prozessstart))"
    return f"cast((2 * 100 * {us} + {unit * 1000000}) // {2 * unit * 1000000} AS double) / 100"


def log_view(number: str, seconds: int, time_column: str, extra: str, start: str, end: str, where: str) -> str:
    return f"""WITH {LOG} SELECT {number}, batch_id, {extra}, status,
        strftime(prozessstart, '%d.%m.%Y %H:%M:%S') AS {start}, strftime(prozessende, '%d.%m.%Y %H:%M:%S') AS {end},
        {elapsed(seconds)} AS {time_column}, fehlermeldung FROM lg WHERE {where}"""


def fact_upsert(ctes: str, rows: str, keys: list[str], update: list[str], cols: list[str], show: list[str]) -> str:
    match = " AND ".join(f"o.{k} IS NOT DISTINCT FROM n.{k}" for k in keys)
    value = ", ".join(
        (f"CASE WHEN n.vorhanden THEN n.{c} ELSE o.{c} END" if c in update
         else f"CASE WHEN o.vorhanden THEN o.{c} ELSE n.{c} END") + f" AS {c}" for c in cols)
    return f"""WITH {ctes}, fakt AS MATERIALIZED ({rows}),
    o AS (SELECT *, true AS vorhanden FROM fakt WHERE batch_id = 1),
    n AS (SELECT *, true AS vorhanden FROM fakt WHERE batch_id = 2),
    m AS (SELECT {value} FROM o FULL OUTER JOIN n ON {match}) SELECT {out(*show)} FROM m"""


PRICE_COLS = ["zeit_id", "wertpapier_sk", "waehrung_id", "kurstyp", "kurs", "kurs_in_eur", "wechselkurs_eur", "boerse",
              "kurs_quelle", "kurs_qualitaet", "batch_id", "isin"]
PRICE_LATEST = latest(f"({stg('STG_KV_KURS', arrival=True)})", "isin, kursdatum, kurstyp, boerse, batch_id",
                      null_keys=True)
PRICE_FACTS = f"""SELECT {zeit('kursdatum')} AS zeit_id, wp.sk AS wertpapier_sk, cur.id AS waehrung_id, kurstyp, kurs,
    kurs_in_eur, wechselkurs_eur, boerse, kurs_quelle, kurs_qualitaet, batch_id, vk.isin
    FROM vk LEFT JOIN wp ON wp.isin = vk.isin LEFT JOIN cur ON cur.iso = vk.waehrung WHERE ist_gueltig = 'J'"""

FX_COLS = ["zeit_id", "waehrung_von_id", "waehrung_nach_id", "kurstyp", "kurs", "batch_id", "waehrung_von",
           "waehrung_nach"]
FX_LATEST = latest(f"({stg('STG_KV_WECHSELKURS')})", "waehrung_von, waehrung_nach, kursdatum, kurstyp, batch_id",
                   "stg_id DESC", null_keys=True)
FX_FACTS = f"""SELECT {zeit('kursdatum')} AS zeit_id, c1.id AS waehrung_von_id, c2.id AS waehrung_nach_id,
    {code('kurstyp')} AS kurstyp, kurs, batch_id, {code('waehrung_von')} AS waehrung_von,
    {code('waehrung_nach')} AS waehrung_nach FROM f LEFT JOIN cur c1 ON c1.iso = {code('waehrung_von')}
    LEFT JOIN cur c2 ON c2.iso = {code('waehrung_nach')} WHERE kurs > 0"""

HOLDING_COLS = ["zeit_id", "fonds_sk", "wertpapier_sk", "depot_sk", "waehrung_papier_id", "waehrung_fonds_id",
                "stueckzahl", "einstandskurs", "einstandswert", "aktueller_kurs", "marktwert", "unrealisierter_gv",
                "marktwert_fondswaehrung", "einstandswert_fondswaehrung", "wechselkurs", "marktwert_eur",
                "einstandswert_eur", "wechselkurs_eur", "portfoliogewicht", "batch_id", "fonds_id", "isin", "depot_nr"]
HOLDING_FACTS = f"""SELECT {zeit('bewertungsdatum')} AS zeit_id, fo.sk AS fonds_sk, wp.sk AS wertpapier_sk,
    de.sk AS depot_sk, c1.id AS waehrung_papier_id, c2.id AS waehrung_fonds_id, stueckzahl, einstandskurs,
    einstandswert, aktueller_kurs, marktwert, marktwert - coalesce(einstandswert, 0) AS unrealisierter_gv,
    marktwert_fondswaehrung, einstandswert AS einstandswert_fondswaehrung, wechselkurs, marktwert_eur,
    cast(einstandswert * coalesce(wechselkurs_eur, cast(1 AS decimal(15,8))) AS decimal(20,2)) AS einstandswert_eur,
    wechselkurs_eur, portfoliogewicht, batch_id, vb.fonds_id, vb.isin, vb.depot_nr
    FROM vb LEFT JOIN fo ON fo.fonds_id = vb.fonds_id LEFT JOIN wp ON wp.isin = vb.isin
    LEFT JOIN de ON de.depot_nr = vb.depot_nr LEFT JOIN cur c1 ON c1.iso = vb.waehrung_papier
    LEFT JOIN cur c2 ON c2.iso = vb.waehrung_fonds WHERE ist_gueltig = 'J'"""

NUMBERS = {"kurs", "kurs_in_eur", "wechselkurs_eur", "stueckzahl", "einstandskurs", "einstandswert", "aktueller_kurs",
           "marktwert", "unrealisierter_gv", "marktwert_fondswaehrung", "einstandswert_fondswaehrung", "wechselkurs",
           "marktwert_eur", "einstandswert_eur", "portfoliogewicht"}


def typed(cols: list[str]) -> list[str]:
    def kind(c: str) -> str:
        if c in NUMBERS:
            return f"{c}:n"
        return f"{c}:i" if c.endswith(("_id", "_sk")) and c not in ("fonds_id",) else c
    return [kind(c) for c in cols]


def count_errors(name: str, label: str, ctes: str, rows: str, rate: bool) -> str:
    no_rate = "count(*) FILTER (WHERE ist_gueltig = 'J' AND wechselkurs_eur IS NULL)" if rate else "0"
    return f"""SELECT * FROM (WITH {ctes} SELECT cast(batch_id AS bigint) AS batch_id, '{name}' AS tabelle,
        '{label}' AS bezeichnung, count(*) AS anzahl, count(*) FILTER (WHERE ist_gueltig = 'N') AS ungueltig,
        cast({no_rate} AS bigint) AS ohne_eur_kurs FROM {rows} GROUP BY batch_id)"""


QUALITY = " UNION ALL ".join([
    count_errors("VOR_WERTPAPIER", "Wertpapier-Stammdaten",
                 security_vor(deliveries("STG_WP_STAMMDATEN", True)), "vw", False),
    count_errors("VOR_FONDS", "Fonds-Stammdaten",
                 fund_vor(deliveries("STG_WP_FONDS_STAMMDATEN", True)), "vo", False),
    count_errors("VOR_KURS", "Kursdaten", prices(stg("STG_KV_KURS")), "vk", True),
    count_errors("VOR_BESTAND", "Bestandsdaten", HOLDINGS, "vb", True),
    count_errors("VOR_TRANSAKTION", "Transaktionsdaten", TRADES, "vt", True),
    count_errors("VOR_FONDSBEWEGUNG", "Fondsbewegungsdaten", FLOWS, "vf", True),
    count_errors("VOR_WECHSELKURS", "Wechselkurse",
                 f"s AS ({stg('STG_KV_WECHSELKURS', broken=True)}), x AS ({judged('s', 'fx')})", "x", False),
])

VERSIONS = f"""v AS (SELECT {mapping.security_number('p_partkey')} AS isin, s.n AS dwh_version,
    CASE s.n WHEN 1 THEN DATE '1990-01-01' ELSE DATE '1998-01-01' + cast(p_partkey % 100 AS int) END AS gueltig_von,
    CASE s.n WHEN 3 THEN DATE '9999-12-31' ELSE DATE '1998-01-01' + cast(p_partkey % 100 AS int) - 1 END AS gueltig_bis
    FROM part JOIN (VALUES (1), (2), (3)) s(n) ON s.n <> 2 OR p_partkey % 7 = 0)"""

TRADE_FACTS = f"""SELECT {zeit('handelsdatum')} AS zeit_id_handel, {zeit('valutatdatum')} AS zeit_id_valuta,
    {zeit('buchungsdatum')} AS zeit_id_buchung, fo.sk AS fonds_sk, wp.sk AS wertpapier_sk, de.sk AS depot_sk,
    cur.id AS waehrung_id, transaktions_id, transaktionstyp, transaktionstyp_normiert,
    cast(stueckzahl AS double) AS stueckzahl, cast(kurs AS double) AS kurs,
    cast(transaktionswert AS double) AS transaktionswert, cast(provision AS double) AS provision,
    cast(stueckzinsen AS double) AS stueckzinsen, cast(gesamtbetrag AS double) AS gesamtbetrag,
    cast(CASE transaktionstyp_normiert WHEN 'KAUF' THEN 1 WHEN 'VERKAUF' THEN -1 ELSE 0 END AS bigint) AS vorzeichen,
    cast(gesamtbetrag_eur AS double) AS gesamtbetrag_eur, cast(wechselkurs_eur AS double) AS wechselkurs_eur,
    kontrahent, batch_id, vt.fonds_id, vt.isin
    FROM vt LEFT JOIN fo ON fo.fonds_id = vt.fonds_id LEFT JOIN wp ON wp.isin = vt.isin
    LEFT JOIN de ON de.depot_nr = vt.depot_nr LEFT JOIN cur ON cur.iso = vt.waehrung WHERE ist_gueltig = 'J'"""
FLOW_FACTS = f"""SELECT {zeit('handelsdatum')} AS zeit_id_handel, {zeit('valutatdatum')} AS zeit_id_valuta,
    {zeit('buchungsdatum')} AS zeit_id_buchung, fo.sk AS fonds_sk, de.sk AS depot_sk, cur.id AS waehrung_id,
    bewegungs_id, bewegungstyp, bewegungstyp_normiert, cast(anteile AS double) AS anteile,
    cast(anteilswert_nav AS double) AS anteilswert_nav, cast(ausgabeaufschlag AS double) AS ausgabeaufschlag,
    cast(bruttobetrag AS double) AS bruttobetrag, cast(nettobetrag AS double) AS nettobetrag,
    cast(CASE bewegungstyp_normiert WHEN 'ZUFLUSS' THEN 1 WHEN 'ABFLUSS' THEN -1 ELSE 0 END AS bigint) AS vorzeichen,
    cast(nettobetrag_eur AS double) AS nettobetrag_eur, cast(wechselkurs_eur AS double) AS wechselkurs_eur,
    anleger_id, batch_id, vf.fonds_id
    FROM vf LEFT JOIN fo ON fo.fonds_id = vf.fonds_id LEFT JOIN de ON de.depot_nr = vf.depot_nr
    LEFT JOIN cur ON cur.iso = vf.waehrung WHERE ist_gueltig = 'J'"""


def append(ctes: str, rows: str, key: str) -> str:
    return f"""WITH {ctes}, {DIMS}, fakt AS MATERIALIZED ({rows}) SELECT * FROM fakt n WHERE batch_id = 2 AND NOT EXISTS (
        SELECT 1 FROM fakt o WHERE o.batch_id = 1 AND o.{key} = n.{key} AND o.fonds_id = n.fonds_id)"""


def _warehouse_run() -> str:
    """The logs of a run of one day, from counts of what each step takes."""
    def of_day(table: str, column: str, source: str | None = None) -> str:
        return f"SELECT * FROM ({source or stg(table)}) WHERE {column} = DATE '2000-01-31'"

    trades = latest(f"({of_day('', 'handelsdatum', stg('STG_FB_TRANSAKTION', arrival=True))})", "transaktions_id, fonds_id", null_keys=True)
    flows_of_day = (f"SELECT * REPLACE (handelsdatum + 1 AS handelsdatum) FROM ({stg('STG_FB_FONDSBEWEGUNG')}) "
                    "WHERE handelsdatum + 1 = DATE '2000-01-31'")
    tables = {"h": of_day("STG_FB_BESTAND", "bewertungsdatum"), "k": of_day("STG_KV_KURS", "kursdatum"),
              "x": of_day("STG_KV_WECHSELKURS", "kursdatum"), "t": trades, "f": flows_of_day,
              "w": delivery("STG_WP_STAMMDATEN", 2), "o": delivery("STG_WP_FONDS_STAMMDATEN", 2)}
    known = "isin IN (SELECT isin FROM vw WHERE ist_gueltig = 'J')"
    fund = "fonds_id IN (SELECT fonds_id FROM vo WHERE ist_gueltig = 'J')"
    rate = f"SELECT DISTINCT {code('waehrung_von')}, {code('waehrung_nach')}, {code('kurstyp')} FROM x"
    price = f"SELECT DISTINCT isin, {code('kurstyp')} FROM k"
    held = "SELECT DISTINCT fonds_id, isin FROM h WHERE isin IS NOT NULL"
    numbered = {
        ("STAGING", "WERTPAPIERSTAMMDATEN"): "SELECT isin FROM w UNION ALL SELECT fonds_id FROM o",
        ("STAGING", "KURSVERSORGUNG"): "SELECT kursdatum FROM k UNION ALL SELECT kursdatum FROM x",
        ("STAGING", "FONDSBUCHHALTUNG"): "SELECT fonds_id FROM h UNION ALL SELECT fonds_id FROM t UNION ALL SELECT fonds_id FROM f",
        ("TRANSFORMATION", "VOR_WERTPAPIER"): "SELECT * FROM vw", ("TRANSFORMATION", "VOR_FONDS"): "SELECT * FROM vo",
        ("TRANSFORMATION", "VOR_WECHSELKURS"): rate, ("TRANSFORMATION", "VOR_KURS"): price,
        ("TRANSFORMATION", "VOR_BESTAND"): held, ("TRANSFORMATION", "VOR_TRANSAKTION"): "SELECT * FROM t",
        ("TRANSFORMATION", "VOR_FONDSBEWEGUNG"): "SELECT * FROM f",
        ("ZIELBELADUNG", "FAKT_WECHSELKURS"): rate, ("ZIELBELADUNG", "FAKT_KURS"): f"{price} WHERE {known}",
        ("ZIELBELADUNG", "FAKT_BESTAND"): f"{held} AND {known} AND {fund}",
        ("ZIELBELADUNG", "FAKT_TRANSAKTION"): f"SELECT * FROM ({judged('t', 'trade')}) WHERE ist_gueltig = 'J' AND {known} AND {fund}",
        ("ZIELBELADUNG", "FAKT_FONDSBEWEGUNG"): f"SELECT * FROM ({judged('f', 'flow')}) WHERE ist_gueltig = 'J' AND {fund}",
    }
    lines = [f"SELECT '{phase}' AS phase, '{name}' AS tabelle, 'ERFOLGREICH' AS status, (SELECT count(*) FROM ({rows})) AS anzahl_saetze"
             for (phase, name), rows in numbered.items()]
    plain = [("STAGING", "KURSVERSORGUNG", "FEHLER"), *[("STAGING", n, "UEBERSPRUNGEN") for n in ("WERTPAPIERSTAMMDATEN", "FONDSBUCHHALTUNG")],
             *[("ZIELBELADUNG", n, "ERFOLGREICH") for n in ("DIM_WERTPAPIER", "DIM_FONDS", "DIM_DEPOT")],
             *[(p, None, s) for p, s in (("GESAMT", "FEHLER"), ("STAGING", "FEHLER"), ("GESAMT", "ERFOLGREICH"), ("STAGING", "ERFOLGREICH"),
                                         ("TRANSFORMATION", "ERFOLGREICH"), ("ZIELBELADUNG", "ERFOLGREICH"))]]
    lines += [f"SELECT '{p}', {repr(n) if n else 'NULL'}, '{s}', NULL" for p, n, s in plain]
    ctes = ", ".join(f"{name} AS MATERIALIZED ({rows})" for name, rows in tables.items())
    return f"""WITH {ctes}, vw AS MATERIALIZED ({judged("(" + latest('w', 'isin', 'isin') + ")", 'security')}),
        vo AS MATERIALIZED ({judged("(" + latest('o', 'fonds_id', 'fonds_id') + ")", 'fund')}) """ + " UNION ALL ".join(lines)


def rule_count(column: str, rule: str, broken: str) -> str:
    return (f"SELECT '{column}' AS spalte, '{rule}' AS regel, count(*) FILTER (WHERE {broken}) AS anzahl FROM s "
            f"HAVING count(*) FILTER (WHERE {broken}) > 0")


FX_OUT = ("batch_id:i", "waehrung_von", "waehrung_nach", "kursdatum:d", "kurstyp", "kurs:n", "ist_gueltig",
          "validierungsfehler")


def fx_vor(broken: bool) -> str:
    return (f"SELECT * REPLACE ({code('waehrung_von')} AS waehrung_von, {code('waehrung_nach')} AS waehrung_nach, "
            f"{code('kurstyp')} AS kurstyp) FROM ({judged('(' + stg('STG_KV_WECHSELKURS', broken=broken) + ')', 'fx')})")


ORACLE: dict[str, str] = {
    "calendar_days": f"""WITH t AS (SELECT cast(l_shipdate AS date) AS d FROM lineitem UNION
        SELECT cast(o_orderdate AS date) FROM orders UNION SELECT cast(ts AS date) FROM events)
        SELECT {zeit('d')} AS zeit_id, cast(d AS varchar) AS datum, day(d) AS tag_nr, isodow(d) AS wochentag_nr,
        {DAY_NAMES}[isodow(d)] AS wochentag_name, substring({DAY_NAMES}[isodow(d)], 1, 2) AS wochentag_kuerzel,
        CASE WHEN isodow(d) IN (6, 7) THEN 'J' ELSE 'N' END AS ist_wochenende, 'J' AS ist_bankarbeitstag,
        'N' AS ist_feiertag, weekofyear(d) AS woche_im_jahr, month(d) AS monat_nr, {MONTH_NAMES}[month(d)] AS monat_name,
        substring({MONTH_NAMES}[month(d)], 1, 3) AS monat_kuerzel, quarter(d) AS quartal_nr,
        'Q' || quarter(d) || '/' || year(d) AS quartal_name, year(d) AS jahr FROM t""",
    "calendar_fill": f"""WITH b AS (SELECT min(cast(l_shipdate AS date)) AS lo, max(cast(l_shipdate AS date)) AS hi
        FROM lineitem), t AS (SELECT cast(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date) AS d FROM b)
        SELECT {zeit('d')} AS zeit_id, cast(d AS varchar) AS datum, isodow(d) AS wochentag_nr FROM t
        WHERE d NOT IN (SELECT cast(o_orderdate AS date) FROM orders WHERE o_orderstatus = 'F')""",
    "stage_holdings": f"""WITH s AS ({stg('STG_FB_BESTAND')}) SELECT fonds_id, isin,
        cast(bewertungsdatum AS varchar) AS bewertungsdatum, cast(marktwert AS double) AS marktwert,
        cast(wechselkurs AS double) AS wechselkurs,
        cast(cast(marktwert * wechselkurs AS decimal(20,2)) AS double) AS marktwert_fondswaehrung, depot_nr, depotstelle FROM s""",
    "stage_trades": f"""WITH s AS ({stg('STG_FB_TRANSAKTION')}) SELECT transaktions_id, fonds_id,
        cast(gesamtbetrag AS double) AS gesamtbetrag, cast(cast(gesamtbetrag * cast(0.92 AS decimal(15,8)) AS decimal(20,2)) AS double)
        AS gesamtbetrag_fondswaehrung, transaktions_id AS src_transaktions_nr, 'ABGESCHLOSSEN' AS src_status FROM s""",
    "stage_flows": f"""WITH s AS ({stg('STG_FB_FONDSBEWEGUNG')}) SELECT bewegungs_id, fonds_id,
        cast(anteile AS double) AS anteile, cast(ausgabeaufschlag AS double) AS ausgabeaufschlag,
        bewegungs_id AS src_bewegungs_nr, 'ABGESCHLOSSEN' AS src_status FROM s""",
    "stage_prices": f"""WITH s AS ({stg('STG_KV_KURS')}) SELECT isin, cast(kursdatum AS varchar) AS kursdatum, kurstyp,
        cast(kurs AS double) AS kurs, boerse, 'KURS-' || isin AS src_kurs_id FROM s""",
    "stage_fx": f"""WITH s AS ({stg('STG_KV_WECHSELKURS')}) SELECT waehrung_von, waehrung_nach,
        cast(kursdatum AS varchar) AS kursdatum, cast(kurs AS double) AS kurs,
        'WK-' || waehrung_von || waehrung_nach || strftime(kursdatum, '%Y%m%d') AS src_kurs_id FROM s""",
    "delivery_order": f"""WITH s AS ({stg('STG_KV_WECHSELKURS')}) SELECT waehrung_von, waehrung_nach,
        cast(kursdatum AS varchar) AS kursdatum, kurstyp, cast(max(kurs) AS double) AS kurs,
        'WK-' || waehrung_von || waehrung_nach || strftime(kursdatum, '%Y%m%d') AS src_kurs_id FROM s GROUP BY ALL""",
    "stage_securities": f"""WITH s AS ({delivery('STG_WP_STAMMDATEN', 2)}) SELECT isin, bezeichnung_lang, wertpapiertyp,
        branche_code, cast(faelligkeitsdatum AS varchar) AS faelligkeitsdatum, isin AS src_wertpapier_id FROM s""",
    "stage_funds": f"""WITH s AS ({delivery('STG_WP_FONDS_STAMMDATEN', 2)}) SELECT fonds_id, fondsname, fondswaehrung,
        kag_name, fonds_id AS src_fonds_id FROM s""",
    "incremental_extract": """SELECT event_id, event_type FROM events WHERE ts > (SELECT max(ts) FROM events
        WHERE event_id % 3 = 1 AND event_id % 4 = 0 AND event_type <> 'error')""",
    "isin_check": f"""WITH s AS ({stg('STG_KV_KURS')}) SELECT isin, cast(kursdatum AS varchar) AS kursdatum,
        {ISIN_ERROR} AS fehler FROM s""",
    "sql_function_check": f"""WITH s AS ({stg('STG_FB_TRANSAKTION')}) SELECT transaktions_id, {ISIN_ERROR} AS fehler,
        {TRADE_TYPE} AS typ, 'NEUTRAL' AS bewegung FROM s""",
    "validate_holding": validate("STG_FB_BESTAND", "holding", "fonds_id", "isin", "bewertungsdatum:d"),
    "validate_trade": validate("STG_FB_TRANSAKTION", "trade", "transaktions_id", "fonds_id", "isin"),
    "validate_flow": validate("STG_FB_FONDSBEWEGUNG", "flow", "bewegungs_id", "fonds_id"),
    "validate_price": validate("STG_KV_KURS", "price", "isin", "kursdatum:d", "kurs:n"),
    "validate_fx": validate("STG_KV_WECHSELKURS", "fx", "stg_id", "kurs:n"),
    "validate_security": validate("STG_WP_STAMMDATEN", "security", "isin", "bezeichnung_lang", "wertpapiertyp",
                                  source=delivery("STG_WP_STAMMDATEN", 2, True)),
    "validate_fund": validate("STG_WP_FONDS_STAMMDATEN", "fund", "fonds_id", "fondsname",
                              source=delivery("STG_WP_FONDS_STAMMDATEN", 2, True)),
    "norm_trade_type": f"""WITH s AS ({stg('STG_FB_TRANSAKTION')}), n AS (SELECT transaktions_id, transaktionstyp,
        {TRADE_TYPE} AS normiert FROM s) SELECT *, cast(CASE normiert WHEN 'KAUF' THEN 1 WHEN 'VERKAUF' THEN -1 ELSE 0 END AS bigint)
        AS vorzeichen FROM n""",
    "norm_flow_type": f"""WITH s AS ({stg('STG_FB_FONDSBEWEGUNG')}), n AS (SELECT bewegungs_id, bewegungstyp,
        {FLOW_TYPE} AS normiert FROM s) SELECT *, cast(CASE normiert WHEN 'ZUFLUSS' THEN 1 WHEN 'ABFLUSS' THEN -1 ELSE 0 END AS bigint)
        AS vorzeichen FROM n""",
    "defaults": f"""WITH s AS ({stg('STG_FB_TRANSAKTION')}) SELECT transaktions_id, fonds_id,
        cast(coalesce(buchungsdatum, valutatdatum) AS varchar) AS buchungsdatum,
        cast(coalesce(provision, 0) AS double) AS provision, cast(coalesce(stueckzinsen, 0) AS double) AS stueckzinsen,
        cast(coalesce(gesamtbetrag, transaktionswert + coalesce(provision, 0) + coalesce(stueckzinsen, 0)) AS double) AS gesamtbetrag,
        cast(coalesce(gesamtbetrag, transaktionswert + coalesce(provision, 0)) AS double) AS eur_basis FROM s""",
    "defaults_flow": f"""WITH s AS ({stg('STG_FB_FONDSBEWEGUNG')}) SELECT bewegungs_id,
        cast(coalesce(buchungsdatum, valutatdatum) AS varchar) AS buchungsdatum,
        cast(coalesce(nettobetrag, bruttobetrag) AS double) AS nettobetrag,
        cast(coalesce(ausgabeaufschlag, 0) AS double) AS ausgabeaufschlag FROM s""",
    "fx_asof": FX_ASOF,
    "fx_asof_long": FX_LONG,
    "fx_asof_inverse": FX_INVERSE,
    "key_lookup": f"""WITH {DIMS}, s AS ({stg('STG_FB_TRANSAKTION')}) SELECT transaktions_id, s.fonds_id, s.isin,
        fo.sk AS fonds_sk, wp.sk AS wertpapier_sk, de.sk AS depot_sk, cast(cur.id AS bigint) AS waehrung_id,
        {zeit('handelsdatum')} AS zeit_id_handel, {zeit('valutatdatum')} AS zeit_id_valuta,
        {zeit('buchungsdatum')} AS zeit_id_buchung FROM s LEFT JOIN fo ON fo.fonds_id = s.fonds_id
        LEFT JOIN wp ON wp.isin = s.isin LEFT JOIN de ON de.depot_nr = s.depot_nr
        LEFT JOIN cur ON cur.iso = {code('waehrung')}""",
    "key_lookup_master": f"""WITH {CURRENCY}, {COUNTRY}, {SECTOR}, s AS ({delivery('STG_WP_STAMMDATEN', 2)}),
        a AS (SELECT isin, branche_code FROM ({delivery('STG_WP_STAMMDATEN', 1)}) WHERE isin IS NOT NULL)
        SELECT s.isin, cast((SELECT id FROM land WHERE iso = {code('land_emittent')}) AS bigint) AS land_id,
        cast({SECTOR_ID.format(c='trim(a.branche_code)')} AS bigint) AS branche_id,
        cast((SELECT id FROM cur WHERE iso = {code('handelswaehrung')}) AS bigint) AS waehrung_id
        FROM s LEFT JOIN a ON a.isin = s.isin""",
    "dedupe_latest": f"""WITH raw AS ({stg('STG_FB_BESTAND', arrival=True)}), d AS ({latest('raw', HOLDING_KEYS)})
        SELECT {out('fonds_id', 'isin', 'bewertungsdatum:d', 'batch_id', 'marktwert:n', 'depot_nr')} FROM d""",
    "dedupe_security": f"""WITH raw AS ({stg('STG_KV_KURS', arrival=True)}), d AS ({latest('raw', 'isin, batch_id')})
        SELECT {out('isin', 'batch_id', 'kursdatum:d', 'kurs:n', 'boerse')} FROM d""",
    "dedupe_fund": f"""WITH raw AS ({stg('STG_FB_BESTAND', arrival=True)}),
        d AS ({latest('raw', 'fonds_id, batch_id', NEWEST + ', isin DESC NULLS LAST')})
        SELECT {out('fonds_id', 'batch_id', 'bewertungsdatum:d', 'marktwert:n')} FROM d""",
    "portfolio_weight": f"""WITH {HOLDINGS} SELECT {out('fonds_id', 'isin', 'bewertungsdatum:d', 'batch_id',
        'ist_gueltig', 'portfoliogewicht:n')} FROM w""",
    "transform_wertpapier": f"""WITH {security_vor(deliveries('STG_WP_STAMMDATEN', True))}
        SELECT {out('batch_id:i', 'isin', 'bezeichnung_lang', 'wertpapiertyp', 'asset_klasse', 'emittent_name', 'land_iso3',
        'branche_code', 'nominalwert:n', 'faelligkeitsdatum:d', 'handelswaehrung', 'ist_gueltig', 'validierungsfehler',
        'quellsystem')} FROM vw""",
    "transform_fonds": f"""WITH {fund_vor(deliveries('STG_WP_FONDS_STAMMDATEN', True))}
        SELECT {out('batch_id:i', 'fonds_id', 'fondsname', 'fondstyp', 'investmentstrategie', 'fondswaehrung', 'kag_name',
        'domizil_land', 'ist_gueltig', 'validierungsfehler', 'quellsystem')} FROM vo""",
    "transform_wechselkurse": f"SELECT {out(*FX_OUT)} FROM ({fx_vor(True)})",
    "transform_kurse": f"""WITH {prices(stg('STG_KV_KURS'))} SELECT {out('batch_id', 'isin', 'kursdatum:d', 'kurstyp',
        'kurs:n', 'waehrung', 'boerse', 'kurs_quelle', 'kurs_qualitaet', 'kurs_in_eur:n', 'wechselkurs_eur:n', 'ist_gueltig',
        'validierungsfehler')} FROM vk""",
    "transform_bestaende": f"""WITH {HOLDINGS} SELECT {out('batch_id', 'fonds_id', 'isin', 'bewertungsdatum:d',
        'stueckzahl:n', 'einstandskurs:n', 'einstandswert:n', 'aktueller_kurs:n', 'marktwert:n',
        'marktwert_fondswaehrung:n', 'wechselkurs:n', 'marktwert_eur:n', 'wechselkurs_eur:n', 'portfoliogewicht:n',
        'waehrung_papier', 'waehrung_fonds', 'depot_nr', 'depotstelle', 'ist_gueltig', 'validierungsfehler')} FROM vb""",
    "transform_transaktionen": f"""WITH {TRADES} SELECT {out('batch_id', 'transaktions_id', 'fonds_id', 'isin',
        'transaktionstyp', 'transaktionstyp_normiert', 'handelsdatum:d', 'valutatdatum:d', 'buchungsdatum:d',
        'stueckzahl:n', 'kurs:n', 'transaktionswert:n', 'provision:n', 'stueckzinsen:n', 'gesamtbetrag:n',
        'gesamtbetrag_eur:n', 'wechselkurs_eur:n', 'waehrung', 'kontrahent', 'depot_nr', 'ist_gueltig',
        'validierungsfehler')} FROM vt""",
    "transform_fondsbewegungen": f"""WITH {FLOWS} SELECT {out('batch_id', 'bewegungs_id', 'fonds_id', 'bewegungstyp',
        'bewegungstyp_normiert', 'handelsdatum:d', 'valutatdatum:d', 'buchungsdatum:d', 'anteile:n',
        'anteilswert_nav:n', 'bruttobetrag:n', 'nettobetrag:n', 'ausgabeaufschlag:n', 'nettobetrag_eur:n',
        'wechselkurs_eur:n', 'depot_nr', 'anleger_id', 'waehrung', 'ist_gueltig', 'validierungsfehler')} FROM vf""",
    "scd2_security": scd2(SECURITY_TWO, SECURITY_ROWS, "isin", SECURITY_ATTRS, SECURITY_TRACKED, "2024-02-01", [
        "isin", "dwh_version:i", "gueltig_von:d", "gueltig_bis:d", "ist_aktuell", "bezeichnung_lang", "wertpapiertyp",
        "land_id:i", "branche_id:i", "waehrung_id:i", "faelligkeitsdatum:d", "batch_id_erstellt:i",
        "batch_id_geaendert:i"]),
    "scd2_fund": scd2(fund_vor(deliveries("STG_WP_FONDS_STAMMDATEN")), FUND_ROWS, "fonds_id",
                      ["fondsname", "fondstyp", "kag_name", "fondswaehrung_id", "domizil_land_id",
                       "investmentstrategie"],
                      ["fondsname", "fondstyp", "kag_name", "fondswaehrung_id", "investmentstrategie"], "2024-02-01", [
        "fonds_id", "dwh_version:i", "gueltig_von:d", "gueltig_bis:d", "ist_aktuell", "fondsname", "kag_name",
        "fondswaehrung_id:i", "domizil_land_id:i", "batch_id_erstellt:i", "batch_id_geaendert:i"]),
    "depot_insert": f"""WITH known AS (SELECT DISTINCT 'DEPOT' || cast(user_id % 4 AS varchar) AS depot_nr FROM events),
        h AS (SELECT DISTINCT depot_nr, depotstelle FROM ({stg('STG_FB_BESTAND')}) WHERE depot_nr IS NOT NULL),
        t AS (SELECT DISTINCT depot_nr FROM ({stg('STG_FB_TRANSAKTION')})),
        n AS (SELECT * FROM h WHERE depot_nr NOT IN (SELECT depot_nr FROM known) UNION ALL
        SELECT depot_nr, NULL FROM t WHERE depot_nr NOT IN (SELECT depot_nr FROM known UNION SELECT depot_nr FROM h))
        SELECT depot_nr, depotstelle, cast(1 AS bigint) AS dwh_version, '2024-01-01' AS gueltig_von,
        '9999-12-31' AS gueltig_bis, 'J' AS ist_aktuell FROM n""",
    "point_in_time_version": f"""WITH {VERSIONS}, s AS ({stg('STG_KV_KURS')}) SELECT s.isin,
        cast(s.kursdatum AS varchar) AS kursdatum, cast(v.dwh_version AS bigint) AS dwh_version FROM s LEFT JOIN v
        ON v.isin = s.isin AND s.kursdatum BETWEEN v.gueltig_von AND v.gueltig_bis""",
    "point_in_time_hot_key": f"""WITH {VERSIONS}, s AS (SELECT l_orderkey, l_linenumber, kursdatum,
        CASE WHEN l_orderkey % 3 = 0 THEN {mapping.security_number('7')} ELSE isin END AS isin
        FROM ({stg('STG_KV_KURS', arrival=True)})) SELECT s.l_orderkey, s.l_linenumber, s.isin,
        cast(s.kursdatum AS varchar) AS kursdatum, cast(v.dwh_version AS bigint) AS dwh_version FROM s LEFT JOIN v
        ON v.isin = s.isin AND s.kursdatum BETWEEN v.gueltig_von AND v.gueltig_bis""",
    "versions_at_date": f"""WITH {VERSIONS} SELECT isin, cast(dwh_version AS bigint) AS dwh_version FROM v
        WHERE DATE '1998-02-01' BETWEEN gueltig_von AND gueltig_bis""",
    "surrogate_keys": "SELECT o_orderkey, 1000 + row_number() OVER (ORDER BY o_orderkey) AS sk FROM orders",
    "upsert_price": fact_upsert(f"{prices(PRICE_LATEST)}, {DIMS}", PRICE_FACTS, ["isin", "zeit_id", "kurstyp", "boerse"],
                                ["wertpapier_sk", "kurs", "kurs_in_eur", "wechselkurs_eur", "kurs_quelle",
                                 "kurs_qualitaet", "batch_id"], PRICE_COLS, typed(PRICE_COLS)),
    "upsert_fx": fact_upsert(f"f AS ({FX_LATEST}), {CURRENCY}", FX_FACTS,
                             ["waehrung_von", "waehrung_nach", "zeit_id", "kurstyp"],
                             ["waehrung_von_id", "waehrung_nach_id", "kurs", "batch_id"], FX_COLS, typed(FX_COLS)),
    "upsert_holding": fact_upsert(f"{HOLDINGS}, {DIMS}", HOLDING_FACTS, ["fonds_id", "isin", "zeit_id", "depot_nr"],
                                  [c for c in HOLDING_COLS if c not in ("waehrung_papier_id", "waehrung_fonds_id",
                                   "zeit_id", "fonds_id", "isin", "depot_nr")], HOLDING_COLS, typed(HOLDING_COLS)),
    "append_trade": append(TRADES, TRADE_FACTS, "transaktions_id").replace(
        "cur.id AS waehrung_id", "cast(cur.id AS bigint) AS waehrung_id"),
    "append_by_key_filter": f"""SELECT transaktions_id, fonds_id, {zeit('handelsdatum')} AS zeit_id_handel,
        '199603' AS gelesene_monate FROM ({stg('STG_FB_TRANSAKTION')}) WHERE handelsdatum >= DATE '2000-07-01'""",
    "append_flow": append(
        flows(f"SELECT * REPLACE (cast(cast(bewegungs_id AS bigint) // 3 AS varchar) AS bewegungs_id) "
              f"FROM ({stg('STG_FB_FONDSBEWEGUNG')})"), FLOW_FACTS, "bewegungs_id").replace(
        "cur.id AS waehrung_id", "cast(cur.id AS bigint) AS waehrung_id"),
    "replace_batch": f"""SELECT {out('batch_id:i', 'waehrung_von', 'kursdatum:d', 'kurs:n', 'ist_gueltig',
        'validierungsfehler')} FROM (SELECT * FROM ({fx_vor(False)}) WHERE batch_id <> 2
        UNION ALL SELECT * FROM ({fx_vor(True)}) WHERE batch_id = 2)""",
    "unresolved_keys": f"""WITH {FLOWS}, {DIMS}, k AS (SELECT bewegungs_id, vf.fonds_id, fo.sk AS f, de.sk AS d FROM vf
        LEFT JOIN fo ON fo.fonds_id = vf.fonds_id LEFT JOIN de ON de.depot_nr = vf.depot_nr WHERE ist_gueltig = 'J')
        SELECT bewegungs_id, fonds_id, concat_ws(', ', CASE WHEN f IS NULL THEN 'fonds_sk' END,
        CASE WHEN d IS NULL THEN 'depot_sk' END) AS fehlende_schluessel FROM k WHERE f IS NULL OR d IS NULL""",
    "batch_status": f"""WITH {LOG}, n AS (SELECT * FROM lg WHERE phase = 'GESAMT' ORDER BY prozess_id DESC LIMIT 1),
        p AS (SELECT lg.* FROM lg JOIN n USING (batch_id) WHERE lg.phase <> 'GESAMT')
        SELECT n.batch_id, cast(n.lade_datum AS varchar) AS lade_datum,
        (SELECT arg_max(status, prozess_id) FROM p WHERE phase = 'STAGING') AS status_staging,
        (SELECT arg_max(status, prozess_id) FROM p WHERE phase = 'TRANSFORMATION') AS status_transform,
        (SELECT arg_max(status, prozess_id) FROM p WHERE phase = 'ZIELBELADUNG') AS status_zielladen,
        n.status AS status_gesamt, coalesce((SELECT arg_max(fehlermeldung, prozess_id) FROM p
        WHERE fehlermeldung IS NOT NULL), n.fehlermeldung) AS fehler_detail FROM n""",
    "log_state": f"""WITH {LOG}, x AS (SELECT log_id // 3 AS prozess_id, log_id, log_id % 3 AS nr, status FROM lg)
        SELECT prozess_id, log_id, status FROM x QUALIFY row_number() OVER (PARTITION BY prozess_id ORDER BY nr DESC) = 1""",
    "quality_report": f"""WITH q AS ({QUALITY}) SELECT q.*, CASE WHEN sum(ungueltig) OVER (PARTITION BY batch_id) > 0
        THEN 'WARNUNG' ELSE 'OK' END AS ergebnis FROM q""",
    "process_log_view": log_view("prozess_id", 60, "laufzeit_minuten",
                                 "strftime(lade_datum, '%d.%m.%Y') AS lade_datum, phase", "prozessstart", "prozessende",
                                 "lade_datum >= DATE '2024-02-10' - 30"),
    "load_log_view": log_view("log_id", 1, "laufzeit_sekunden", "quellsystem, tabelle, anzahl_saetze", "ladestart",
                              "ladeende", "prozessstart >= TIMESTAMP '2024-02-10 12:00:00' - INTERVAL 30 DAY"),
    "phase_stats": f"""WITH {LOG}, x AS (SELECT *, {elapsed(1)} AS dauer,
        row_number() OVER (PARTITION BY phase ORDER BY prozessstart DESC, prozess_id DESC) AS rn FROM lg)
        SELECT phase, count(*) AS run_count, count(*) FILTER (WHERE status = 'FEHLER') AS failure_count,
        strftime(max(prozessstart), '%Y-%m-%d %H:%M:%S.%f') AS last_start,
        max(dauer) FILTER (WHERE rn = 1) AS last_run_seconds FROM x GROUP BY phase""",
    "phase_stats_like": f"""WITH {LOG} SELECT phase, count(*) AS run_count, count(*) FILTER (WHERE status = 'FEHLER') AS failure_count,
        strftime(max(prozessstart), '%Y-%m-%d %H:%M:%S.%f') AS last_start FROM lg WHERE phase LIKE '_T%' GROUP BY phase""",
    "warehouse_run": _warehouse_run(),
    "delta_with_watermark": f"""WITH p AS (SELECT {mapping.security_number('p_partkey')} AS isin, p_name AS bezeichnung_lang,
            p_partkey % 1000 AS m, p_partkey % 1000 < 600 AND p_partkey % 10 <> 3 AS zuerst FROM part),
        s AS (SELECT 1 AS batch_id, * FROM p WHERE zuerst UNION ALL
            SELECT 2, * FROM p WHERE NOT zuerst AND m > (SELECT max(m) FROM p WHERE zuerst) - 60)
        SELECT cast(batch_id AS bigint) AS batch_id, isin, bezeichnung_lang,
            strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(cast(m AS bigint)), '%Y-%m-%d %H:%M:%S.%f') AS src_geaendert_am FROM s""",
    "invalid_rows": f"""WITH s AS ({stg('STG_FB_BESTAND', broken=True)}), j AS ({judged('s', 'holding')})
        SELECT {out('batch_id', 'fonds_id', 'isin', 'bewertungsdatum:d', 'validierungsfehler')} FROM j WHERE ist_gueltig = 'N'""",
    "retention": "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-04-15 00:00:00' - INTERVAL 90 DAY",
    "retention_batches": """SELECT event_id // 50 AS batch_id, count(*) AS anzahl FROM events GROUP BY 1
        HAVING max(ts) < TIMESTAMP '2024-04-15 00:00:00' - INTERVAL 90 DAY""",
    "unique_violations": f"""SELECT transaktions_id, fonds_id, batch_id, count(*) AS anzahl
        FROM ({stg('STG_FB_TRANSAKTION')}) GROUP BY ALL HAVING count(*) > 1""",
    "unique_fact_violations": f"""SELECT isin, cast(kursdatum AS varchar) AS kursdatum, kurstyp, boerse, count(*) AS anzahl
        FROM ({stg('STG_KV_KURS')}) GROUP BY isin, s.kursdatum, kurstyp, boerse HAVING count(*) > 1""".replace(
        "GROUP BY isin, s.kursdatum", "GROUP BY isin, kursdatum"),
    "fk_violations": f"""WITH {FUNDS}, f AS ({stg('STG_FB_FONDSBEWEGUNG')}), t AS ({stg('STG_FB_TRANSAKTION')})
        SELECT 'fonds_id' AS spalte, fonds_id AS wert, count(*) AS anzahl FROM f WHERE fonds_id NOT IN (SELECT fonds_id FROM fo)
        GROUP BY 2 UNION ALL
        SELECT 'zeit_id', strftime(handelsdatum, '%Y%m%d'), count(*) FROM t WHERE handelsdatum < DATE '2000-01-01'
        OR handelsdatum > DATE '2040-12-31' GROUP BY 2""",
    "check_violations": f"WITH s AS ({stg('STG_FB_TRANSAKTION', broken=True)}) " + " UNION ALL ".join([
        rule_count(c, "NOT NULL", f"{c} IS NULL")
        for c in ("transaktions_id", "fonds_id", "isin", "transaktionstyp", "handelsdatum")] + [
        rule_count(c, f"LENGTH <= {n}", f"length({c}) > {n}")
        for c, n in (("transaktions_id", 100), ("fonds_id", 50), ("isin", 12), ("transaktionstyp", 20), ("waehrung", 3),
                     ("kontrahent", 200), ("depot_nr", 50))]),
    "row_violations": f"WITH s AS ({stg('STG_FB_TRANSAKTION', broken=True, arrival=True)}), v AS (SELECT l_orderkey, l_linenumber, "
        "concat_ws(', ', " + ", ".join(
            [f"CASE WHEN {c} IS NULL THEN '{c} NOT NULL' END" + (f", CASE WHEN length({c}) > {n} THEN '{c} LENGTH <= {n}' END" if n else "")
             for c, n in (("transaktions_id", 100), ("fonds_id", 50), ("isin", 12), ("transaktionstyp", 20), ("handelsdatum", 0))]
            + ["CASE WHEN length(waehrung) > 3 THEN 'waehrung LENGTH <= 3' END"])
        + ") AS regeln FROM s) SELECT * FROM v WHERE regeln <> ''",
    "reference_violations": f"""WITH {TRADES}, {DIMS}, fakt AS MATERIALIZED ({TRADE_FACTS}), v AS (
        """ + " UNION ALL ".join(
            f"SELECT '{c}' AS spalte, cast({c} AS varchar) AS wert FROM fakt WHERE {c} NOT BETWEEN 19920101 AND 19961231"
            for c in ("zeit_id_handel", "zeit_id_valuta", "zeit_id_buchung")) + """
        UNION ALL SELECT 'fonds_sk', cast(fonds_sk AS varchar) FROM fakt WHERE fonds_sk > 5)
        SELECT spalte, wert, count(*) AS anzahl FROM v GROUP BY ALL""",
    "allowed_value_violations": f"WITH {LOG} SELECT prozess_id, status FROM lg WHERE status NOT IN ('GESTARTET', 'FEHLER')",
    "current_row_violations": """SELECT 'DEPOT' || cast(n AS varchar) AS depot_nr, cast(2 AS bigint) AS anzahl
        FROM (SELECT DISTINCT user_id % 13 AS n FROM events) WHERE n % 2 = 0""",
    "interval_violations": scd2(SECURITY_TWO, SECURITY_ROWS, "isin", SECURITY_ATTRS, SECURITY_TRACKED, "2024-01-01", [
        "isin", "dwh_version:i", "gueltig_von:d", "gueltig_bis:d"]) + " WHERE gueltig_bis < gueltig_von",
}
