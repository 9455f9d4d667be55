"""Feed cleaning, perimeter filters, schema checks and data-quality reports.

Each cleaner is a few projections (no shuffles) of native expressions; the date
parser is evaluated outside generated code, so that this stays compilable.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lanewatch import constants as K
from lanewatch.functions import cleaning as C
from lanewatch.functions.columns import safe_div

ALARM_CONTRACT = ["AREOPORTO_ARRIVO", "AREOPORTO_PARTENZA", "ANNO_PARTENZA", "MESE_PARTENZA", "DATA_PARTENZA",
                  "TOT", "ZONA", "OCCORRENZE", "PAESE_PART", "MOTIVO_ALLARME"]
TRAVELLER_CONTRACT = ["AREOPORTO_ARRIVO", "AREOPORTO_PARTENZA", "ANNO_PARTENZA", "MESE_PARTENZA",
                      "DATA_PARTENZA", "ENTRATI", "INVESTIGATI", "ALLARMATI", "GENERE", "TIPO_DOCUMENTO",
                      "FASCIA_ETA", "NAZIONALITA", "ESITO_CONTROLLO", "COMPAGNIA_AEREA", "ZONA", "PAESE_PART"]


def drop_known(df: DataFrame, cols) -> DataFrame:
    """Drop duplicate columns when present."""
    return df.drop(*[c for c in cols if c in df.columns])


def replace_null_tokens(df: DataFrame, tokens=None, skip=()) -> DataFrame:
    """Over every string column, in one projection."""
    return df.select(*[
        C.null_tokens(F.col(f.name), tokens).alias(f.name)
        if isinstance(f.dataType, StringType) and f.name not in skip else F.col(f.name)
        for f in df.schema.fields])


def _parsed(df: DataFrame) -> DataFrame:
    """Parsed timestamp, codes.

    Each stage references the previous one by column name, so every expensive
    expression (the date parser, the number extraction) is evaluated once per row;
    later stages only read columns.
    """
    out = {
        "DATA_PARTENZA": C.parse_date(F.col("DATA_PARTENZA")),
        "_anno_raw": C.year_repair(F.col("ANNO_PARTENZA")),
        "_mese_raw": C.month_number(F.col("MESE_PARTENZA")),
        "ZONA": C.zone(F.col("ZONA")),
        "AREOPORTO_ARRIVO": C.airport(F.col("AREOPORTO_ARRIVO")),
        "AREOPORTO_PARTENZA": C.airport(F.col("AREOPORTO_PARTENZA")),
    }
    for c in ("CODICE_PAESE_ARR", "CODICE_PAESE_PART"):
        if c in df.columns:
            out[c] = C.iso3(F.col(c))
    return df.withColumns(out)


def _calendar(df: DataFrame) -> DataFrame:
    """C6 + C21: year / month from the parsed date where it parsed; hour, weekday (Monday = 0), month."""
    d = F.col("DATA_PARTENZA")
    return (df.withColumns({"ANNO_PARTENZA": F.coalesce(F.year(d).cast("double"), F.col("_anno_raw")),
                            "MESE_PARTENZA": F.coalesce(F.month(d), F.col("_mese_raw")),
                            "ora_partenza": F.hour(d), "giorno_settimana": F.weekday(d), "mese": F.month(d)})
              .drop("_anno_raw", "_mese_raw"))


def clean_alarms(raw: DataFrame) -> DataFrame:
    """C1–C8, C11, C13, C15, C16, C18, C21 on the all-string alarm feed."""
    df = _parsed(replace_null_tokens(drop_known(raw, K.DROP_COLS_ALARMS)))
    out = {"TOT": C.extract_number(F.col("TOT")),
           "OCCORRENZE": F.when(F.col("OCCORRENZE").isin(K.OCCURRENCE_INVALID), F.lit(None).cast("string"))
                          .otherwise(F.col("OCCORRENZE"))}
    for c in ("PAESE_ARR", "PAESE_PART", "MOTIVO_ALLARME"):
        if c in df.columns:
            out[c] = F.trim(F.col(c))
    df = df.withColumns(out).withColumn("TOT", C.count_domain(F.col("TOT")))
    return _calendar(df)


def clean_travellers(raw: DataFrame) -> DataFrame:
    """C1–C6, C9–C12, C14–C21 on the all-string traveller feed."""
    df = _parsed(replace_null_tokens(drop_known(raw, K.DROP_COLS_TRAVELLERS)))
    out = {c: C.non_negative(C.extract_number(F.col(c))) for c in ("ENTRATI", "INVESTIGATI", "ALLARMATI")}
    out.update({
        "GENERE": C.gender(F.col("GENERE")),
        "TIPO_DOCUMENTO": C.allowed(F.col("TIPO_DOCUMENTO"), K.DOCUMENT_TYPES),
        "FASCIA_ETA": C.age_band(F.col("FASCIA_ETA")),
    })
    if "NAZIONALITA" in df.columns:
        out["NAZIONALITA"] = C.nationality(F.col("NAZIONALITA"))
    df = df.withColumns(out)
    ent = F.col("ENTRATI")
    df = df.withColumns({"INVESTIGATI": F.coalesce(C.at_most(F.col("INVESTIGATI"), ent), F.lit(0.0)),
                         "ALLARMATI": F.coalesce(C.at_most(F.col("ALLARMATI"), ent), F.lit(0.0))})
    df = df.withColumn("ENTRATI", F.coalesce(ent, F.lit(0.0)))
    df = df.withColumns({"tasso_allarme": safe_div(F.col("ALLARMATI"), F.col("ENTRATI")),
                         "tasso_investigati": safe_div(F.col("INVESTIGATI"), F.col("ENTRATI"))})
    return _calendar(df)


def null_fractions(df: DataFrame) -> DataFrame:
    """Per column, null count and percent (one aggregation, unpivoted)."""
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_c{i}")
                                                    for i, c in enumerate(df.columns)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(c).alias("column"), F.col(f"_c{i}").alias("n_null"),
                 F.round(safe_div(F.col(f"_c{i}") * 100.0, F.col("_n")), 2).alias("pct_null"))
        for i, c in enumerate(df.columns)])))


def drop_sparse_columns(df: DataFrame, threshold: float = K.SPARSE_NULL_THRESHOLD,
                        keep=()) -> tuple[DataFrame, list[str]]:
    """Drop columns whose null fraction exceeds ``threshold`` (never ``keep``)."""
    fr = null_fractions(df).collect()  # one row per column: bounded by the schema
    drop = [r["column"] for r in fr if r["pct_null"] / 100.0 > threshold and r["column"] not in set(keep)]
    return df.drop(*drop), drop


# ----------------------------------------------------------------- perimeter
PERIMETER_COLUMNS = {
    "anno": "ANNO_PARTENZA", "mese": "MESE_PARTENZA", "aeroporto_partenza": "AREOPORTO_PARTENZA",
    "aeroporto_arrivo": "AREOPORTO_ARRIVO", "paese_partenza": "PAESE_PART", "paese_arrivo": "PAESE_ARR",
    "zona": "ZONA",
}


def normalise_perimeter(perimeter: dict | None) -> dict:
    """Drop blank values, upper-case airport codes; unknown keys are errors."""
    out = {}
    for k, v in (perimeter or {}).items():
        if k not in PERIMETER_COLUMNS:
            raise ValueError(f"unknown perimeter key {k!r}; expected one of {sorted(PERIMETER_COLUMNS)}")
        if v is None or (isinstance(v, str) and not v.strip()):
            continue
        out[k] = v.strip().upper() if k.startswith("aeroporto") and isinstance(v, str) else v
    return out


def perimeter_predicate(perimeter: dict | None) -> Column:
    """Conjunction of equalities; strings compare case-insensitively."""
    p = normalise_perimeter(perimeter)
    preds = []
    for k, v in p.items():
        c = F.col(PERIMETER_COLUMNS[k])
        preds.append(F.upper(c.cast("string")) == F.lit(str(v).upper()) if isinstance(v, str) else c == F.lit(v))
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def apply_perimeter(df: DataFrame, perimeter: dict | None) -> DataFrame:
    """Filter a feed to a perimeter (pushed to the scan by Catalyst)."""
    p = normalise_perimeter(perimeter)
    needed = [PERIMETER_COLUMNS[k] for k in p]
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"perimeter columns missing from feed: {missing}")
    return df.filter(perimeter_predicate(p))


# ----------------------------------------------------------------- schema check
def check_schema(df: DataFrame, canonical, aliases: dict | None = None) -> tuple[DataFrame, list[str]]:
    """Rename known aliases to canonical names; report still-missing columns."""
    aliases = aliases or {}
    ren = {a: c for a, c in aliases.items() if a in df.columns and c not in df.columns}
    out = df.withColumnsRenamed(ren) if ren else df
    return out, [c for c in canonical if c not in out.columns]


# ---------------------------------------------------------------- FIXED VALUES
LEGACY_LABELS = {
    "ALTA": "HIGH", "MEDIA": "MEDIUM", "NORMALE": "NORMAL", "BASSA": "LOW",
    "CRITICO": "CRITICAL", "ALTO": "HIGH", "MEDIO": "MEDIUM", "BASSO": "LOW",
}
# ------------------------------------------------------------ END FIXED VALUES


def legacy_label(c) -> Column:
    """Legacy label vocabulary -> current labels (trim + upper first)."""
    from lanewatch.functions.columns import lookup
    v = F.upper(F.trim(C.col_(c)))
    return F.coalesce(lookup(LEGACY_LABELS, v), v)


def filter_options(df: DataFrame, dims) -> DataFrame:
    """Distinct non-null values per dimension, as (dimension, value) rows.

    One unpivot + distinct (a distributed shuffle), never a collected set.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
                                for d in dims]))
    return (df.select(pairs.alias("p")).select("p.dimension", "p.value")
              .filter(F.col("value").isNotNull()).distinct())


def value_counts(df: DataFrame, col: str, k: int = 30) -> DataFrame:
    """Top-k values of a column with row counts (ties by value)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.col(col)).limit(k))
