"""Data dictionary: column types, table layouts and the rules attached to them.

A column name means the same thing in every table, so types are kept once per
name; a table lists names.  ``!`` marks a required column, ``name:type``
overrides the dictionary type for one table.  Names are ASCII throughout.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Type per column name.
_DICTIONARY = {
    "bigint": """
        stg_id vor_id log_id prozess_id batch_id batch_id_erstellt batch_id_geaendert
        schritt_id ungueltig ohne_eur_kurs
        wertpapier_sk fonds_sk depot_sk waehrung_id land_id branche_id fondswaehrung_id
        domizil_land_id waehrung_papier_id waehrung_fonds_id waehrung_von_id waehrung_nach_id
        bestand_id transaktion_id fondsbewegung_id kurs_id wechselkurs_id
        dwh_version anzahl_saetze tage_bis_heute monate_bis_heute""",
    "int": """
        zeit_id zeit_id_handel zeit_id_valuta zeit_id_buchung vorzeichen dezimalstellen
        tag_nr wochentag_nr woche_im_jahr monat_nr quartal_nr jahr
        gj_monat_nr gj_quartal_nr gj_jahr""",
    "date": """
        bewertungsdatum handelsdatum valutatdatum buchungsdatum kursdatum faelligkeitsdatum
        auflagedatum gueltig_von gueltig_bis datum lade_datum""",
    "timestamp": """
        ladezeit verarbeitungszeit ladestart ladeende prozessstart prozessende schrittstart schrittende
        erstellt_am geaendert_am src_erstellt_am src_geaendert_am""",
    "decimal(20,6)": """
        nominale stueckzahl einstandskurs aktueller_kurs kurs anteile anteilswert_nav
        umsatz_stueck kurs_in_eur kurs_hoch kurs_tief kurs_eroeffnung""",
    "decimal(20,2)": """
        einstandswert marktwert marktwert_fondswaehrung marktwert_eur transaktionswert provision
        stueckzinsen gesamtbetrag gesamtbetrag_fondswaehrung gesamtbetrag_eur bruttobetrag
        nettobetrag nettobetrag_eur ausgabeaufschlag handelsvolumen auflegungsvolumen
        unrealisierter_gv einstandswert_fondswaehrung einstandswert_eur""",
    "decimal(15,8)": "wechselkurs wechselkurs_eur",
    "decimal(20,4)": "nominalwert",
    "decimal(10,6)": "kuponrate portfoliogewicht",
}

# Text columns by maximum length.
_TEXT = {
    1: "ist_gueltig ist_aktuell ucits_konform ist_wochenende ist_bankarbeitstag ist_feiertag "
       "ist_euro_waehrung ist_eu_mitglied ist_eurozone",
    2: "iso2_code",
    3: "waehrung waehrung_fonds waehrung_papier waehrung_von waehrung_nach nominalwaehrung "
       "handelswaehrung notizwaehrung fondswaehrung land_emittent land_iso3 domizil_land iso_code "
       "iso_code_numerisch iso3_code iso_numerisch waehrung_iso3 wochentag_kuerzel monat_kuerzel",
    5: "symbol",
    6: "wkn",
    7: "sedol",
    8: "kurszeit",
    9: "cusip",
    10: "boerse_kuerzel quartal_name gics_sektor_code gics_branche_code gics_sub_branche_code sic_code",
    11: "kag_bic",
    12: "isin emittent_isin",
    20: "transaktionstyp transaktionstyp_normiert valor ticker branche_code kuponfrequenz "
        "ausschuettungsart status kurs_qualitaet wochentag_name monat_name branche_intern_code",
    30: "bewegungstyp bewegungstyp_normiert kurstyp phase",
    50: "fonds_id depot_nr boerse hauptboerse wertpapiertyp asset_klasse sub_asset_klasse fondstyp "
        "depot_typ src_status",
    100: "transaktions_id bewegungs_id depotstelle anleger_id kurs_quelle src_kurs_id "
         "src_transaktions_nr src_bewegungs_nr src_wertpapier_id src_fonds_id bezeichnung_kurz branche "
         "fondsname_kurz rechtliche_struktur quellsystem tabelle feiertag_name inhaber_id "
         "name_de:100 name_en:100 region sub_region gics_sektor_name gics_branche_name "
         "gics_sub_branche_name",
    200: "kontrahent investmentstrategie sic_name branche_intern_name",
    500: "bezeichnung_lang emittent_name fondsname kag_name verwahrstelle inhaber_name",
    4000: "validierungsfehler fehlermeldung",
}

COLUMN_TYPE: dict[str, str] = {
    name: kind for kind, names in _DICTIONARY.items() for name in names.split()
}
COLUMN_LENGTH: dict[str, int] = {
    name.split(":")[0]: length for length, names in _TEXT.items() for name in names.split()
}
COLUMN_TYPE.update({name: "string" for name in COLUMN_LENGTH})

JA_NEIN = ("J", "N")


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


_PLAIN = {"bigint": T.LongType(), "int": T.IntegerType(), "date": T.DateType(),
          "timestamp": T.TimestampType(), "string": T.StringType()}


def spark_type(name: str) -> T.DataType:
    if name.startswith("decimal"):
        precision, scale = name[len("decimal("):-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _PLAIN[name]



@dataclass(frozen=True)
class Table:
    """Layout of one table."""

    name: str
    columns: tuple[str, ...]
    required: frozenset[str]
    types: dict[str, str]
    lengths: dict[str, int]
    id_column: str | None = None
    time_column: str | None = None
    partition: str | None = None
    unique: tuple[str, ...] = ()
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        """All columns nullable: required columns are checked, not assumed."""
        return self.schema_without()

    def schema_without(self, *skip: str | None) -> T.StructType:
        return T.StructType([T.StructField(c, spark_type(self.types[c])) for c in self.columns if c not in skip])


TABLES: dict[str, Table] = {}


def _table(name: str, columns: str, **rules) -> None:
    names, required, types, lengths = [], set(), {}, {}
    for item in columns.split():
        item, bang, _ = item.partition("!")
        col, _, override = item.partition(":")
        names.append(col)
        if bang:
            required.add(col)
        if override.isdigit():
            types[col], lengths[col] = "string", int(override)
        else:
            types[col] = override or COLUMN_TYPE[col]
            if types[col] == "string":
                lengths[col] = COLUMN_LENGTH[col]
    flags = {c: JA_NEIN for c in names if COLUMN_LENGTH.get(c) == 1}
    flags.update(rules.pop("allowed", {}))
    unique = tuple(rules.pop("unique", "").split())
    TABLES[name] = Table(
        name, tuple(names), frozenset(required), types, lengths,
        unique=unique, allowed=flags, **rules,
    )


_STG = dict(id_column="stg_id", time_column="ladezeit", partition="batch_id")
_STG_HEAD = "stg_id! batch_id! ladezeit! "
_VOR = dict(id_column="vor_id", time_column="verarbeitungszeit", partition="batch_id")
_VOR_HEAD = "vor_id! batch_id! verarbeitungszeit! "
_DIM_HEAD = "gueltig_von! gueltig_bis! ist_aktuell dwh_version! "

# --- layer 1: raw batches -------------------------------------------------
_table("STG_FB_BESTAND", _STG_HEAD + """fonds_id! isin! bewertungsdatum! nominale stueckzahl
    einstandskurs einstandswert aktueller_kurs marktwert waehrung_fonds waehrung_papier wechselkurs
    marktwert_fondswaehrung depot_nr depotstelle src_erstellt_am src_geaendert_am""", **_STG)
_table("STG_FB_TRANSAKTION", _STG_HEAD + """transaktions_id! fonds_id! isin! transaktionstyp!
    handelsdatum! valutatdatum buchungsdatum stueckzahl nominale kurs kursdatum transaktionswert
    provision stueckzinsen gesamtbetrag waehrung waehrung_fonds wechselkurs
    gesamtbetrag_fondswaehrung kontrahent depot_nr src_transaktions_nr src_status:50
    src_erstellt_am src_geaendert_am""", **_STG)
_table("STG_FB_FONDSBEWEGUNG", _STG_HEAD + """bewegungs_id! fonds_id! bewegungstyp! handelsdatum!
    valutatdatum buchungsdatum anteile! anteilswert_nav ausgabeaufschlag:decimal(10,4) bruttobetrag
    nettobetrag depot_nr depotstelle anleger_id waehrung src_bewegungs_nr src_status
    src_erstellt_am src_geaendert_am""", **_STG)
_table("STG_KV_KURS", _STG_HEAD + """isin! kursdatum! kurszeit kurstyp! kurs! waehrung!
    handelsvolumen umsatz_stueck boerse boerse_kuerzel kurs_quelle kurs_qualitaet src_kurs_id
    src_erstellt_am""", **_STG)
_table("STG_KV_WECHSELKURS", _STG_HEAD + """waehrung_von! waehrung_nach! kursdatum! kurstyp:20!
    kurs:decimal(20,8)! src_kurs_id src_erstellt_am""", **_STG)
_table("STG_WP_STAMMDATEN", _STG_HEAD + """isin! wkn valor cusip sedol ticker bezeichnung_lang!
    bezeichnung_kurz wertpapiertyp! asset_klasse sub_asset_klasse emittent_name emittent_isin
    land_emittent branche branche_code nominalwert nominalwaehrung faelligkeitsdatum kuponrate
    kuponfrequenz fondstyp ausschuettungsart auflagedatum handelswaehrung notizwaehrung hauptboerse
    boerse_kuerzel status src_wertpapier_id src_erstellt_am src_geaendert_am""", **_STG)
_table("STG_WP_FONDS_STAMMDATEN", _STG_HEAD + """fonds_id! isin wkn fondsname! fondsname_kurz
    fondstyp! investmentstrategie asset_klasse fondswaehrung! auflagedatum auflegungsvolumen kag_name
    kag_bic verwahrstelle domizil_land rechtliche_struktur ucits_konform status src_fonds_id
    src_erstellt_am src_geaendert_am""", **_STG)

# --- layer 2: validated batches -------------------------------------------
_table("VOR_WERTPAPIER", _VOR_HEAD + """isin! wkn valor ticker bezeichnung_lang! bezeichnung_kurz
    wertpapiertyp! asset_klasse sub_asset_klasse emittent_name land_iso3 branche branche_code
    nominalwert nominalwaehrung faelligkeitsdatum kuponrate kuponfrequenz fondstyp
    ausschuettungsart auflagedatum handelswaehrung notizwaehrung hauptboerse ist_gueltig
    validierungsfehler quellsystem src_geaendert_am""", unique="isin batch_id", **_VOR)
_table("VOR_FONDS", _VOR_HEAD + """fonds_id! isin wkn fondsname! fondsname_kurz fondstyp!
    investmentstrategie asset_klasse fondswaehrung! auflagedatum kag_name verwahrstelle domizil_land
    rechtliche_struktur ucits_konform status ist_gueltig validierungsfehler quellsystem
    src_geaendert_am""", unique="fonds_id batch_id", **_VOR)
_table("VOR_KURS", _VOR_HEAD + """isin! kursdatum! kurstyp! kurs! waehrung! boerse kurs_quelle
    kurs_qualitaet kurs_in_eur wechselkurs_eur ist_gueltig validierungsfehler src_kurs_id""",
    unique="isin kursdatum kurstyp batch_id", **_VOR)
_table("VOR_WECHSELKURS", _VOR_HEAD + """waehrung_von! waehrung_nach! kursdatum! kurstyp:20!
    kurs:decimal(20,8)! ist_gueltig validierungsfehler""",
    unique="waehrung_von waehrung_nach kursdatum kurstyp batch_id", **_VOR)
_table("VOR_BESTAND", _VOR_HEAD + """fonds_id! isin! bewertungsdatum! nominale stueckzahl
    einstandskurs einstandswert aktueller_kurs marktwert marktwert_fondswaehrung wechselkurs
    marktwert_eur wechselkurs_eur portfoliogewicht waehrung_papier waehrung_fonds depot_nr
    depotstelle ist_gueltig validierungsfehler stg_id""",
    unique="fonds_id isin bewertungsdatum batch_id", **_VOR)
_table("VOR_TRANSAKTION", _VOR_HEAD + """transaktions_id! fonds_id! isin! transaktionstyp!
    transaktionstyp_normiert! handelsdatum! valutatdatum buchungsdatum stueckzahl nominale kurs
    transaktionswert provision stueckzinsen gesamtbetrag gesamtbetrag_eur wechselkurs_eur waehrung
    kontrahent depot_nr ist_gueltig validierungsfehler stg_id""",
    unique="transaktions_id fonds_id batch_id", **_VOR)
_table("VOR_FONDSBEWEGUNG", _VOR_HEAD + """bewegungs_id! fonds_id! bewegungstyp!
    bewegungstyp_normiert! handelsdatum! valutatdatum buchungsdatum anteile! anteilswert_nav
    bruttobetrag nettobetrag ausgabeaufschlag nettobetrag_eur wechselkurs_eur depot_nr anleger_id
    waehrung ist_gueltig validierungsfehler stg_id""",
    unique="bewegungs_id fonds_id batch_id", **_VOR)

# --- layer 3: dimensions --------------------------------------------------
_table("DIM_ZEIT", """zeit_id! datum! tag_nr! wochentag_nr! wochentag_name! wochentag_kuerzel!
    ist_wochenende! ist_bankarbeitstag ist_feiertag feiertag_name woche_im_jahr! monat_nr!
    monat_name! monat_kuerzel! quartal_nr! quartal_name! jahr! gj_monat_nr gj_quartal_nr gj_jahr
    tage_bis_heute monate_bis_heute""", unique="datum")
_table("DIM_WAEHRUNG", "waehrung_id! " + _DIM_HEAD + """iso_code! iso_code_numerisch name_de!
    name_en symbol dezimalstellen ist_euro_waehrung land_iso3 erstellt_am! geaendert_am!""",
    id_column="waehrung_id")
_table("DIM_LAND", "land_id! " + _DIM_HEAD + """iso3_code! iso2_code iso_numerisch name_de:200!
    name_en:200 region sub_region waehrung_iso3 ist_eu_mitglied ist_eurozone erstellt_am!
    geaendert_am!""", id_column="land_id")
_table("DIM_BRANCHE", "branche_id! " + _DIM_HEAD + """gics_sektor_code gics_sektor_name
    gics_branche_code gics_branche_name gics_sub_branche_code gics_sub_branche_name sic_code
    sic_name branche_intern_code branche_intern_name erstellt_am!""", id_column="branche_id")
_table("DIM_WERTPAPIER", "wertpapier_sk! " + _DIM_HEAD + """isin! wkn valor ticker
    bezeichnung_lang! bezeichnung_kurz wertpapiertyp! asset_klasse sub_asset_klasse emittent_name
    land_id branche_id waehrung_id nominalwert nominalwaehrung faelligkeitsdatum kuponrate
    kuponfrequenz fondstyp ausschuettungsart auflagedatum hauptboerse erstellt_am! geaendert_am!
    batch_id_erstellt batch_id_geaendert""", id_column="wertpapier_sk",
    foreign={"land_id": ("DIM_LAND", "land_id"), "branche_id": ("DIM_BRANCHE", "branche_id"),
             "waehrung_id": ("DIM_WAEHRUNG", "waehrung_id")})
_table("DIM_FONDS", "fonds_sk! " + _DIM_HEAD + """fonds_id! isin wkn fondsname! fondsname_kurz
    fondstyp! investmentstrategie asset_klasse fondswaehrung_id domizil_land_id auflagedatum kag_name
    verwahrstelle rechtliche_struktur ucits_konform erstellt_am! geaendert_am! batch_id_erstellt
    batch_id_geaendert""", id_column="fonds_sk",
    foreign={"fondswaehrung_id": ("DIM_WAEHRUNG", "waehrung_id"),
             "domizil_land_id": ("DIM_LAND", "land_id")})
_table("DIM_DEPOT", "depot_sk! " + _DIM_HEAD + """depot_nr! depotstelle:200 depot_typ inhaber_name
    inhaber_id waehrung_id erstellt_am! geaendert_am!""", id_column="depot_sk",
    foreign={"waehrung_id": ("DIM_WAEHRUNG", "waehrung_id")})

_ZEIT = ("DIM_ZEIT", "zeit_id")
_FONDS = ("DIM_FONDS", "fonds_sk")
_PAPIER = ("DIM_WERTPAPIER", "wertpapier_sk")
_DEPOT = ("DIM_DEPOT", "depot_sk")
_GELD = ("DIM_WAEHRUNG", "waehrung_id")
_ROLLEN = {"zeit_id_handel": _ZEIT, "zeit_id_valuta": _ZEIT, "zeit_id_buchung": _ZEIT}

# --- layer 3: facts, partitioned by month ---------------------------------
# The natural keys kept on the facts are also their match keys, so a new
# dimension version never duplicates a fact: depot_nr on FAKT_BESTAND and the
# currency codes on FAKT_WECHSELKURS are stored for that purpose.
_FAKT = dict(time_column="erstellt_am", partition="zeit_monat")
_table("FAKT_BESTAND", """bestand_id! zeit_id! fonds_sk! wertpapier_sk! depot_sk
    waehrung_papier_id waehrung_fonds_id nominale stueckzahl einstandskurs einstandswert
    aktueller_kurs marktwert unrealisierter_gv marktwert_fondswaehrung einstandswert_fondswaehrung
    wechselkurs marktwert_eur einstandswert_eur wechselkurs_eur portfoliogewicht erstellt_am!
    batch_id! fonds_id isin depot_nr""", id_column="bestand_id",
    unique="fonds_id isin zeit_id depot_nr",
    foreign={"zeit_id": _ZEIT, "fonds_sk": _FONDS, "wertpapier_sk": _PAPIER, "depot_sk": _DEPOT,
             "waehrung_papier_id": _GELD, "waehrung_fonds_id": _GELD}, **_FAKT)
_table("FAKT_TRANSAKTION", """transaktion_id! zeit_id_handel! zeit_id_valuta zeit_id_buchung
    fonds_sk! wertpapier_sk! depot_sk waehrung_id transaktions_id! transaktionstyp!
    transaktionstyp_normiert! stueckzahl nominale kurs transaktionswert provision stueckzinsen
    gesamtbetrag vorzeichen gesamtbetrag_eur wechselkurs_eur kontrahent erstellt_am! batch_id!
    fonds_id isin""", id_column="transaktion_id", unique="transaktions_id fonds_id",
    foreign={**_ROLLEN, "fonds_sk": _FONDS, "wertpapier_sk": _PAPIER, "depot_sk": _DEPOT,
             "waehrung_id": _GELD}, **_FAKT)
_table("FAKT_FONDSBEWEGUNG", """fondsbewegung_id! zeit_id_handel! zeit_id_valuta zeit_id_buchung
    fonds_sk! depot_sk waehrung_id bewegungs_id! bewegungstyp! bewegungstyp_normiert! anteile!
    anteilswert_nav ausgabeaufschlag bruttobetrag nettobetrag vorzeichen nettobetrag_eur
    wechselkurs_eur anleger_id erstellt_am! batch_id! fonds_id""", id_column="fondsbewegung_id",
    unique="bewegungs_id fonds_id",
    foreign={**_ROLLEN, "fonds_sk": _FONDS, "depot_sk": _DEPOT, "waehrung_id": _GELD}, **_FAKT)
_table("FAKT_KURS", """kurs_id! zeit_id! wertpapier_sk! waehrung_id! kurstyp! kurs! kurs_hoch
    kurs_tief kurs_eroeffnung handelsvolumen umsatz_stueck kurs_in_eur wechselkurs_eur boerse
    kurs_quelle kurs_qualitaet erstellt_am! batch_id! isin""", id_column="kurs_id",
    unique="isin zeit_id kurstyp boerse",
    foreign={"zeit_id": _ZEIT, "wertpapier_sk": _PAPIER, "waehrung_id": _GELD}, **_FAKT)
_table("FAKT_WECHSELKURS", """wechselkurs_id! zeit_id! waehrung_von_id! waehrung_nach_id!
    kurstyp:20! kurs:decimal(20,8)! erstellt_am! batch_id! waehrung_von waehrung_nach""",
    id_column="wechselkurs_id", unique="waehrung_von waehrung_nach zeit_id kurstyp",
    foreign={"zeit_id": _ZEIT, "waehrung_von_id": _GELD, "waehrung_nach_id": _GELD}, **_FAKT)

# --- logs -----------------------------------------------------------------
_table("STG_LADELOG", """log_id! batch_id! quellsystem! tabelle! ladestart! ladeende anzahl_saetze
    status fehlermeldung erstellt_am!""", id_column="log_id", time_column="erstellt_am",
    allowed={"status": ("GESTARTET", "ERFOLGREICH", "FEHLER")})
_table("ETL_PROZESSLOG", """prozess_id! batch_id! lade_datum! prozessstart! prozessende phase!
    status fehlermeldung erstellt_am""", id_column="prozess_id",
    allowed={"status": ("GESTARTET", "ERFOLGREICH", "FEHLER", "UEBERSPRUNGEN")})
# One line per finished step of a phase: what a run needs to go on where it
# stopped, and the counts taken while the step wrote.
_table("ETL_SCHRITTLOG", """schritt_id! batch_id! phase! tabelle! schrittstart! schrittende! anzahl_saetze
    ungueltig ohne_eur_kurs status! fehlermeldung erstellt_am!""", id_column="schritt_id", time_column="erstellt_am",
    allowed={"status": ("ERFOLGREICH", "FEHLER", "UEBERSPRUNGEN")})

LOGS = ("STG_LADELOG", "ETL_PROZESSLOG", "ETL_SCHRITTLOG")
STAGING = [t for t in TABLES if t.startswith("STG_") and t != "STG_LADELOG"]
VALIDATED = [t for t in TABLES if t.startswith("VOR_")]
DIMENSIONS = [t for t in TABLES if t.startswith("DIM_")]
FACTS = [t for t in TABLES if t.startswith("FAKT_")]
