"""DuckDB restatement of the dirty proxy feeds and the cleaning rules."""

from __future__ import annotations

from lanewatch import constants as K
from lanewatch.plans.oracle_sql import _base, case_map, q, safe_div
from lanewatch.sources.proxy import MOTIVE_OF_PRIORITY, OCCURRENCE_OF_STATUS, OUTCOME_OF_LINENUMBER


def raw_alarms_cte() -> str:
    ts = "DATA_PARTENZA"
    qs = "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"
    date_s = (f"CASE l_linenumber WHEN 1 THEN strftime({ts}, '%Y-%m-%d %H:%M:%S') "
              f"WHEN 2 THEN strftime({ts}, '%Y/%m/%d') WHEN 3 THEN strftime({ts}, '%d.%m.%Y') "
              f"WHEN 4 THEN strftime({ts}, '%d-%m-%y') "
              f"WHEN 5 THEN upper(strftime({ts}, '%b')) || ' ' || strftime({ts}, '%-d %Y') "
              f"WHEN 6 THEN 'garbage' ELSE strftime({ts}, '%Y-%m-%d') END")
    tot_s = (f"CASE l_linenumber WHEN 1 THEN {qs} || ' pax' WHEN 2 THEN '~' || {qs} WHEN 3 THEN 'N.D.' "
             f"WHEN 4 THEN '-5' WHEN 5 THEN '1,5' WHEN 6 THEN {qs} || ' voli' ELSE {qs} END")
    return f"""raw_alarms AS (
  SELECT _rid,
    ' ' || lower(nc_name) || ' ' AS AREOPORTO_ARRIVO,
    lower(AREOPORTO_PARTENZA) AS AREOPORTO_PARTENZA,
    CASE WHEN l_linenumber IN (3, 6) THEN '24' ELSE CAST(ANNO_PARTENZA AS VARCHAR) END AS ANNO_PARTENZA,
    CASE WHEN l_linenumber IN (2, 6) THEN 'GEN' ELSE CAST(MESE_PARTENZA AS VARCHAR) END AS MESE_PARTENZA,
    {date_s} AS DATA_PARTENZA,
    {tot_s} AS TOT,
    CASE WHEN l_linenumber = 7 THEN '?' ELSE CAST(ZONA AS VARCHAR) END AS ZONA,
    CASE WHEN l_linenumber = 7 THEN 'N/C' ELSE {case_map('o_orderstatus || l_linestatus', OCCURRENCE_OF_STATUS)} END AS OCCORRENZE,
    CASE WHEN l_linenumber % 2 = 0 THEN 'it' ELSE 'DE' END AS CODICE_PAESE_ARR,
    CASE WHEN l_linenumber = 5 THEN 'ZZ' ELSE 'AL' END AS CODICE_PAESE_PART,
    ' ' || PAESE_ARR AS PAESE_ARR,
    PAESE_PART || ' ' AS PAESE_PART,
    ' ' || {case_map('o_orderpriority', MOTIVE_OF_PRIORITY)} AS MOTIVO_ALLARME
  FROM ({_base(True)}) b)"""


def raw_travellers_cte() -> str:
    ts = "DATA_PARTENZA"
    qs = "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"
    inv = "CAST(CAST(floor(l_quantity * l_discount * 10) AS INTEGER) AS VARCHAR)"
    alr = "CAST(CAST(floor(l_quantity * l_tax * 5) AS INTEGER) AS VARCHAR)"
    return f"""raw_travellers AS (
  SELECT _rid, AREOPORTO_ARRIVO, AREOPORTO_PARTENZA || ' ' AS AREOPORTO_PARTENZA,
    CAST(ANNO_PARTENZA AS VARCHAR) AS ANNO_PARTENZA, CAST(MESE_PARTENZA AS VARCHAR) AS MESE_PARTENZA,
    CASE WHEN l_linenumber <= 3 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') ELSE strftime({ts}, '%-d/%-m/%Y') END AS DATA_PARTENZA,
    CASE WHEN l_linenumber = 1 THEN {qs} || ' pax' ELSE {qs} END AS ENTRATI,
    CASE WHEN l_linenumber = 6 THEN '~99' ELSE {inv} END AS INVESTIGATI,
    CASE WHEN l_linenumber = 5 THEN '-1' ELSE {alr} END AS ALLARMATI,
    CASE WHEN l_linestatus = 'O' THEN 'Maschio' WHEN l_linenumber = 7 THEN '1' ELSE 'f.' END AS GENERE,
    CASE l_linenumber WHEN 2 THEN 'Visto' WHEN 3 THEN 'Passaporto' ELSE c_mktsegment END AS TIPO_DOCUMENTO,
    CASE l_linenumber WHEN 1 THEN 'minore' WHEN 2 THEN '18-30' WHEN 3 THEN '61+' WHEN 4 THEN '-5'
      ELSE o_orderpriority END AS FASCIA_ETA,
    CASE WHEN l_linenumber % 3 = 0 THEN 'it' WHEN l_linenumber % 3 = 1 THEN ' TR ' ELSE nc_name END AS NAZIONALITA,
    {case_map('l_linenumber', OUTCOME_OF_LINENUMBER, "'OK'")} AS ESITO_CONTROLLO,
    s_name AS COMPAGNIA_AEREA, CAST(ZONA AS VARCHAR) AS ZONA, PAESE_PART || ' ' AS PAESE_PART
  FROM ({_base(False)}) b)"""


def _nulls(c: str) -> str:
    toks = ", ".join(q(t) for t in K.NULL_TOKENS)
    return f"(CASE WHEN {c} IN ({toks}) THEN NULL ELSE {c} END)"


def parse_date_sql(c: str) -> str:
    s = f"trim({c})"
    for it, en in K.ITALIAN_MONTHS_EN.items():
        s = f"replace({s}, {q(it)}, {q(en)})"
    y4 = lambda f, rx: f"CASE WHEN regexp_matches({s}, {q(rx)}) THEN try_strptime({s}, {q(f)}) END"
    parts = [
        y4("%Y-%m-%d %H:%M:%S", r"^\d{4}-"), y4("%Y-%m-%dT%H:%M:%S", r"^\d{4}-"), y4("%Y-%m-%d", r"^\d{4}-"),
        y4("%Y/%m/%d", r"^\d{4}/"), y4("%d.%m.%Y", r"\.\d{4}$"), f"try_strptime({s}, '%d-%m-%y')",
        y4("%b %d %Y", r" \d{4}$"), y4("%d/%m/%Y", r"/\d{4}$"), y4("%d/%m/%Y %H:%M", r"/\d{4} "),
        y4("%d/%m/%Y %H:%M:%S", r"/\d{4} "), y4("%d-%m-%Y", r"-\d{4}$"), y4("%d %m %Y", r" \d{4}$"),
    ]
    return "coalesce(" + ", ".join(parts) + ")"


def extract_number_sql(c: str) -> str:
    s = f"replace(replace(replace(replace(trim({c}), ',', '.'), '~', ''), 'pax', ''), 'voli', '')"
    return f"TRY_CAST(trim({s}) AS DOUBLE)"


def iso3_sql(c: str) -> str:
    v = f"upper(trim({c}))"
    return f"coalesce({case_map(v, K.ISO2_TO_ISO3)}, {v})"


def _zone(c: str) -> str:
    zs = ", ".join(q(z) for z in K.ZONES)
    return f"(CASE WHEN trim({c}) IN ({zs}) THEN CAST(trim({c}) AS INTEGER) END)"


def _common_sql(src: str) -> str:
    d = parse_date_sql("DATA_PARTENZA")
    return f"""{d} AS DATA_TS,
    upper(trim(AREOPORTO_ARRIVO)) AS AREOPORTO_ARRIVO, upper(trim(AREOPORTO_PARTENZA)) AS AREOPORTO_PARTENZA,
    TRY_CAST(coalesce({case_map('ANNO_PARTENZA', K.YEAR_REPAIRS)}, ANNO_PARTENZA) AS DOUBLE) AS ANNO_RAW,
    CAST(TRY_CAST(coalesce(CAST({case_map('MESE_PARTENZA', K.ITALIAN_MONTHS)} AS VARCHAR), MESE_PARTENZA) AS DOUBLE) AS INTEGER) AS MESE_RAW,
    {_zone('ZONA')} AS ZONA"""


def _nulled(src: str, cols: list[str]) -> str:
    return f"(SELECT _rid, {', '.join(f'{_nulls(c)} AS {c}' for c in cols)} FROM {src})"


ALARM_RAW_COLS = ["AREOPORTO_ARRIVO", "AREOPORTO_PARTENZA", "ANNO_PARTENZA", "MESE_PARTENZA", "DATA_PARTENZA", "TOT",
                  "ZONA", "OCCORRENZE", "CODICE_PAESE_ARR", "CODICE_PAESE_PART", "PAESE_ARR", "PAESE_PART",
                  "MOTIVO_ALLARME"]
TRAVELLER_RAW_COLS = ["AREOPORTO_ARRIVO", "AREOPORTO_PARTENZA", "ANNO_PARTENZA", "MESE_PARTENZA", "DATA_PARTENZA",
                      "ENTRATI", "INVESTIGATI", "ALLARMATI", "GENERE", "TIPO_DOCUMENTO", "FASCIA_ETA", "NAZIONALITA",
                      "ESITO_CONTROLLO", "COMPAGNIA_AEREA", "ZONA", "PAESE_PART"]


def clean_alarms_cte(src: str = "raw_alarms", out: str = "clean_alarms") -> str:
    occ_bad = ", ".join(q(v) for v in K.OCCURRENCE_INVALID)
    tot = extract_number_sql("TOT")
    return f"""{out}_0 AS (SELECT _rid, {_common_sql(src)},
    {tot} AS TOT_NUM,
    CASE WHEN OCCORRENZE IN ({occ_bad}) THEN NULL ELSE OCCORRENZE END AS OCCORRENZE,
    {iso3_sql('CODICE_PAESE_ARR')} AS CODICE_PAESE_ARR, {iso3_sql('CODICE_PAESE_PART')} AS CODICE_PAESE_PART,
    trim(PAESE_ARR) AS PAESE_ARR, trim(PAESE_PART) AS PAESE_PART, trim(MOTIVO_ALLARME) AS MOTIVO_ALLARME
  FROM {_nulled(src, ALARM_RAW_COLS)}),
{out} AS (SELECT _rid, AREOPORTO_ARRIVO, AREOPORTO_PARTENZA,
    coalesce(CAST(year(DATA_TS) AS DOUBLE), ANNO_RAW) AS ANNO_PARTENZA,
    coalesce(CAST(month(DATA_TS) AS INTEGER), MESE_RAW) AS MESE_PARTENZA,
    DATA_TS AS DATA_PARTENZA,
    CASE WHEN TOT_NUM < 0 OR TOT_NUM <> round(TOT_NUM) OR TOT_NUM > 9999 THEN NULL ELSE TOT_NUM END AS TOT,
    ZONA, OCCORRENZE, CODICE_PAESE_ARR, CODICE_PAESE_PART, PAESE_ARR, PAESE_PART, MOTIVO_ALLARME,
    CAST(hour(DATA_TS) AS INTEGER) AS ora_partenza, CAST(isodow(DATA_TS) - 1 AS INTEGER) AS giorno_settimana,
    CAST(month(DATA_TS) AS INTEGER) AS mese
  FROM {out}_0)"""


def clean_travellers_cte(src: str = "raw_travellers", out: str = "clean_travellers") -> str:
    fem = ", ".join(q(v) for v in K.FEMALE_VALUES)
    mal = ", ".join(q(v) for v in K.MALE_VALUES)
    docs = ", ".join(q(v) for v in K.DOCUMENT_TYPES)
    bands = ", ".join(q(v) for v in K.AGE_BANDS)
    rep = {k: v for k, v in K.AGE_BAND_REPAIRS.items()}
    rep_keys = ", ".join(q(k) for k in rep)
    rep_case = "CASE FASCIA_ETA " + " ".join(
        f"WHEN {q(k)} THEN {q(v) if v is not None else 'NULL'}" for k, v in rep.items()) + " END"
    band = f"(CASE WHEN FASCIA_ETA IN ({rep_keys}) THEN {rep_case} ELSE FASCIA_ETA END)"
    nz = iso3_sql("NAZIONALITA")
    nonneg = lambda c: f"(CASE WHEN {extract_number_sql(c)} < 0 THEN NULL ELSE {extract_number_sql(c)} END)"
    return f"""{out}_0 AS (SELECT _rid, {_common_sql(src)},
    {nonneg('ENTRATI')} AS ENT, {nonneg('INVESTIGATI')} AS INV0, {nonneg('ALLARMATI')} AS ALR0,
    CASE WHEN lower(trim(GENERE)) IN ({fem}) THEN 'F' WHEN lower(trim(GENERE)) IN ({mal}) THEN 'M' END AS GENERE,
    CASE WHEN TIPO_DOCUMENTO IN ({docs}) THEN TIPO_DOCUMENTO END AS TIPO_DOCUMENTO,
    CASE WHEN {band} IN ({bands}) THEN {band} END AS FASCIA_ETA,
    CASE WHEN length({nz}) = 3 THEN {nz} END AS NAZIONALITA,
    ESITO_CONTROLLO, COMPAGNIA_AEREA, PAESE_PART
  FROM {_nulled(src, TRAVELLER_RAW_COLS)}),
{out}_1 AS (SELECT *, coalesce(ENT, 0.0) AS ENTRATI,
    coalesce(CASE WHEN INV0 > ENT THEN NULL ELSE INV0 END, 0.0) AS INVESTIGATI,
    coalesce(CASE WHEN ALR0 > ENT THEN NULL ELSE ALR0 END, 0.0) AS ALLARMATI FROM {out}_0),
{out} AS (SELECT _rid, AREOPORTO_ARRIVO, AREOPORTO_PARTENZA,
    coalesce(CAST(year(DATA_TS) AS DOUBLE), ANNO_RAW) AS ANNO_PARTENZA,
    coalesce(CAST(month(DATA_TS) AS INTEGER), MESE_RAW) AS MESE_PARTENZA,
    DATA_TS AS DATA_PARTENZA, ENTRATI, INVESTIGATI, ALLARMATI, GENERE, TIPO_DOCUMENTO, FASCIA_ETA, NAZIONALITA,
    ESITO_CONTROLLO, COMPAGNIA_AEREA, ZONA, PAESE_PART,
    {safe_div('ALLARMATI', 'ENTRATI')} AS tasso_allarme, {safe_div('INVESTIGATI', 'ENTRATI')} AS tasso_investigati,
    CAST(hour(DATA_TS) AS INTEGER) AS ora_partenza, CAST(isodow(DATA_TS) - 1 AS INTEGER) AS giorno_settimana,
    CAST(month(DATA_TS) AS INTEGER) AS mese
  FROM {out}_1)"""
