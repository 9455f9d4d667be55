"""Per-entity feature table (one row per route) from the two cleaned feeds.

Each feed is reduced by ONE conditional aggregation (the occurrence pivot,
motive shares, outcome pivot, modes and country/zone fallbacks are all folded
into it — no join per feature family), then the two aggregates are joined once
(full outer) on the entity key.  Global statistics (p99 cap, max log volume)
are uncorrelated scalar subqueries: Spark runs each once and inlines the value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewatch import constants as K
from lanewatch.functions.columns import clip, safe_div, sum_cols
from lanewatch.operators.quantiles import quantiles, quantiles_by
from lanewatch.session import keep


def _first_non_null(c: str, order: str = "_rid"):
    """pandas groupby 'first': first non-null value in row order."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))


#: the least int, long before Spark's first date
NO_DAY = -2**31


def merge_feeds(alarms: DataFrame, travellers: DataFrame) -> DataFrame:
    """J1 + A1: alarm grain LEFT JOIN per (arrival, departure, date) traveller totals.

    The right side is pre-aggregated, so the join is 1:1 on its key; null keys
    never match. The day is a number that is never null on the right: a null test
    there, written or inferred from the join, would parse every date twice.
    """
    keys = ["AREOPORTO_ARRIVO", "AREOPORTO_PARTENZA", "_data_key"]
    day = F.unix_date(F.to_date("DATA_PARTENZA"))
    t = travellers.withColumn("_data_key", F.coalesce(day, F.lit(NO_DAY)))
    agg = t.groupBy(*keys).agg(
        F.coalesce(F.sum("ENTRATI"), F.lit(0.0)).alias("tot_entrati"),
        F.coalesce(F.sum("ALLARMATI"), F.lit(0.0)).alias("tot_allarmati"),
        F.coalesce(F.sum("INVESTIGATI"), F.lit(0.0)).alias("tot_investigati"),
        F.avg("tasso_allarme").alias("tasso_allarme_volo"),
        F.avg("tasso_investigati").alias("tasso_inv_volo"),
        F.countDistinct("NAZIONALITA").alias("n_nazionalita"),
        F.count_if(F.col("ESITO_CONTROLLO") == "RESPINTO").alias("n_respinti"),
        F.count_if(F.col("ESITO_CONTROLLO") == "FERMATO").alias("n_fermati"),
        F.count_if(F.col("ESITO_CONTROLLO") == "SEGNALATO").alias("n_segnalati"),
    )
    a = alarms.withColumn("_data_key", day)
    return a.join(agg, on=keys, how="left").drop("_data_key")


def alarm_entity_aggregate(alarms: DataFrame, key: str = "ROTTA", by: tuple[str, ...] = ()) -> DataFrame:
    """Metadata, log volume, occurrence pivot, motive shares, derived rates.

    Rows are summed by key, zone and country in a hash aggregation; the first zone and country of a
    key (a text that only a sorting aggregation can hold) are chosen among these few sums.
    """
    a = alarms.filter(F.col(key).isNotNull())
    tot = F.col("TOT")
    occ = F.col("OCCORRENZE")
    mot = F.col("MOTIVO_ALLARME")
    aggs = [F.count(tot).alias("n_osservazioni_allarmi"), F.sum(tot).alias("tot_allarmi_sum")]
    aggs += [F.sum(F.when(occ == v, tot)).alias(name) for v, name in K.OCCURRENCE_COLUMNS.items()]
    aggs += [F.count_if(mot == m).alias(f"_n_{m.lower()}") for m in K.MOTIVES]
    aggs.append(F.count(mot).alias("_n_motives"))
    parts = a.groupBy(*by, key, "ZONA", "PAESE_PART").agg(F.min("_rid").alias("_first"), *aggs)
    sums = [c for c in parts.columns if c not in (*by, key, "ZONA", "PAESE_PART", "_first")]
    g = parts.groupBy(*by, key).agg(_first_non_null("ZONA", "_first").alias("ZONA"), _first_non_null("PAESE_PART", "_first").alias("PAESE_PART"),
                                    *[F.sum(c).alias(c) for c in sums]) \
        .withColumn("tot_allarmi_sum", F.coalesce("tot_allarmi_sum", F.lit(0.0)))

    occ_cols = list(K.OCCURRENCE_COLUMNS.values())
    out = [*by, F.col(key), "ZONA", "PAESE_PART", "n_osservazioni_allarmi",
           clip("tot_allarmi_sum", lo=0).alias("tot_allarmi_sum"),
           F.log1p("tot_allarmi_sum").alias("tot_allarmi_log")]
    out += [clip(F.coalesce(F.col(c), F.lit(0.0)), lo=0).alias(c) for c in occ_cols]
    out += [clip(safe_div(F.col(f"_n_{m.lower()}"), F.col("_n_motives")), 0, 1).alias(f"pct_{m.lower()}")
            for m in K.MOTIVES]
    g = g.select(*out)
    return g.select(
        "*",
        clip(safe_div("allarmi_chiusi", F.col("allarmi_chiusi") + F.col("allarmi_non_chiusi")), 0, 1)
        .alias("tasso_chiusura"),
        clip(safe_div("allarmi_rilevanti", "voli_con_allarmi"), 0, 1).alias("tasso_rilevanza"),
        clip(safe_div(sum_cols(["np_sdi", "np_nsis", "np_int"]),
                      sum_cols(["allarmi_sdi_occ", "allarmi_interpol_occ"])), 0, 1)
        .alias("false_positive_rate"),
    )


#: categories of the traveller feed whose most frequent value (ties: the least) describes a key; a key has few
#: combinations of the first ones' values
FEW_VALUED = {"GENERE": "genere_predominante", "FASCIA_ETA": "fascia_eta_predominante", "TIPO_DOCUMENTO": "tipo_doc_prevalente",
              "PAESE_PART": "_paese_fallback", "ZONA": "_zona_fallback"}
MANY_VALUED = {"NAZIONALITA": "nazionalita_top", "COMPAGNIA_AEREA": "compagnia_top"}


def traveller_entity_aggregate(travellers: DataFrame, key: str = "ROTTA", denominator: str = "observations",
                               by: tuple[str, ...] = ()) -> DataFrame:
    """A8–A12 plus the J4 fallbacks (mode of country/zone), in one pass; outcome rates over ``observations`` or ``outcomes``.

    Rows meet one hash aggregation over three grouping sets: sums by key and the categories of few values, counts by
    key and by each other category. Sums by key and counts by value follow from these, and the modes are
    chosen among the counts (a mode over the rows would sort them all).
    """
    t = travellers.filter(F.col(key).isNotNull())
    esito = F.col("ESITO_CONTROLLO")
    aggs = [
        F.coalesce(F.sum("ENTRATI"), F.lit(0.0)).alias("tot_entrati"),
        F.coalesce(F.sum("ALLARMATI"), F.lit(0.0)).alias("tot_allarmati"),
        F.coalesce(F.sum("INVESTIGATI"), F.lit(0.0)).alias("tot_investigati"),
        F.count("ENTRATI").alias("n_osservazioni_viag"),
        *[f(c).alias(f"_{f.__name__}_{c}") for c in ("tasso_allarme", "tasso_investigati") for f in (F.sum, F.count)],
    ]
    aggs += [F.count_if(esito == v).alias(name) for v, name in K.OUTCOME_COLUMNS.items()]
    of_key, modes = [*by, key], [*FEW_VALUED, *MANY_VALUED]
    rows = t.groupingSets([[*of_key, *FEW_VALUED], *[[*of_key, c] for c in MANY_VALUED]], *of_key, *modes).agg(
        (F.grouping_id() == 2 ** len(MANY_VALUED) - 1).alias("_few"), F.count(F.lit(1)).alias("_n"), *aggs)
    sums = [c for c in rows.columns if c not in (*of_key, *modes, "_few", "_n")]
    parts = rows.groupingSets([of_key, *[[*of_key, c] for c in modes]], *of_key, *modes).agg(
        F.grouping_id().alias("_set"), F.sum("_n").alias("_n"), *[F.sum(F.when(F.col("_few"), F.col(c))).alias(c) for c in sums])
    whole = 2 ** len(modes) - 1
    names = FEW_VALUED | MANY_VALUED
    g = parts.groupBy(*of_key).agg(
        *[F.max(F.when(F.col("_set") == whole, F.col(c))).alias(c) for c in sums],
        *[F.min(F.when((F.col("_set") == whole - 2 ** (len(modes) - 1 - i)) & F.col(c).isNotNull(),
                       F.struct((-F.col("_n")).alias("n"), F.col(c).alias("v")))).getField("v").alias(names[c])
          for i, c in enumerate(modes)])
    mean = lambda c: F.when(F.col(f"_count_{c}") > 0, F.col(f"_sum_{c}") / F.col(f"_count_{c}"))
    g = g.withColumns({"tasso_allarme_medio": mean("tasso_allarme"), "tasso_inv_medio": mean("tasso_investigati")})
    nobs = F.col("n_osservazioni_viag") if denominator == "observations" else sum_cols([F.col(c) for c in K.OUTCOME_COLUMNS.values()])
    rej = clip(safe_div("n_respinti", nobs), 0, 1)
    det = clip(safe_div("n_fermati", nobs), 0, 1)
    g = g.select(
        *by, key,
        clip("tot_entrati", lo=0).alias("tot_entrati"),
        clip("tot_allarmati", lo=0).alias("tot_allarmati"),
        clip("tot_investigati", lo=0).alias("tot_investigati"),
        "n_osservazioni_viag",
        clip("tasso_allarme_medio", 0, 1).alias("tasso_allarme_medio"),
        clip("tasso_inv_medio", 0, 1).alias("tasso_inv_medio"),
        *[F.coalesce(F.col(c), F.lit("ND")).alias(c) for c in
          ["genere_predominante", "fascia_eta_predominante", "tipo_doc_prevalente",
           "nazionalita_top", "compagnia_top"]],
        "_paese_fallback", "_zona_fallback",
        safe_div("tot_allarmati", "tot_investigati").alias("_api_raw"),
        *list(K.OUTCOME_COLUMNS.values()),
        rej.alias("tasso_respinti"),
        det.alias("tasso_fermati"),
        clip(rej * K.OUTCOME_RISK_WEIGHTS["rejected"] + det * K.OUTCOME_RISK_WEIGHTS["detained"], 0, 1)
        .alias("score_rischio_esiti"),
    )
    g = keep(g)  # one row per entity; read twice
    if by:
        caps = quantiles_by(g, {"cap": "_api_raw"}, [0.99], by).select(*by, F.col("q")[0].alias("_cap"))
        return g.join(caps, list(by), "left").withColumn("alarm_per_invest", F.least("_api_raw", "_cap")).drop("_api_raw", "_cap")
    cap = quantiles(g, {"cap": "_api_raw"}, [0.99])["cap"][0]
    return g.withColumn("alarm_per_invest", F.least(F.col("_api_raw"), F.lit(cap).cast("double"))).drop("_api_raw")


ALARM_NUMERIC = (["n_osservazioni_allarmi", "tot_allarmi_sum", "tot_allarmi_log"]
                 + list(K.OCCURRENCE_COLUMNS.values())
                 + [f"pct_{m.lower()}" for m in K.MOTIVES]
                 + ["tasso_chiusura", "tasso_rilevanza", "false_positive_rate"])
TRAVELLER_NUMERIC = (["tot_entrati", "tot_allarmati", "tot_investigati", "n_osservazioni_viag",
                      "tasso_allarme_medio", "tasso_inv_medio", "alarm_per_invest"]
                     + list(K.OUTCOME_COLUMNS.values())
                     + ["tasso_respinti", "tasso_fermati", "score_rischio_esiti"])
TRAVELLER_CATEGORICAL = ["genere_predominante", "fascia_eta_predominante", "tipo_doc_prevalente",
                         "nazionalita_top", "compagnia_top"]
FEATURE_COLUMNS = (["ROTTA", "ZONA", "PAESE_PART"] + ALARM_NUMERIC + TRAVELLER_NUMERIC
                   + TRAVELLER_CATEGORICAL + ["score_composito"])


def entity_features(alarms: DataFrame, travellers: DataFrame, key: str = "ROTTA", by: tuple[str, ...] = ()) -> DataFrame:
    """The full per-entity feature table (+ score_composito); ``by``: one table per group, in one plan."""
    a = alarm_entity_aggregate(alarms, key, by)
    t = traveller_entity_aggregate(travellers, key, by=by)
    j = a.join(t, on=[*by, key], how="full")
    blank = ["ND", "//", ""]
    paese = F.when(F.col("PAESE_PART").isin(blank), None).otherwise(F.col("PAESE_PART"))
    zona = F.col("ZONA").cast("string")
    zona = F.when(zona.isin(blank), None).otherwise(zona)
    cols = [*by, F.col(key),
            F.coalesce(zona, F.col("_zona_fallback").cast("string"), F.lit("ND")).alias("ZONA"),
            F.coalesce(paese, F.col("_paese_fallback"), F.lit("ND")).alias("PAESE_PART")]
    cols += [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ALARM_NUMERIC + TRAVELLER_NUMERIC]
    cols += [F.coalesce(F.col(c), F.lit("ND")).alias(c) for c in TRAVELLER_CATEGORICAL]
    f = keep(j.select(*cols))
    log_max = f.select(F.max("tot_allarmi_log")).scalar() if not by else F.col("_log_max")
    if by:
        f = f.join(f.groupBy(*by).agg(F.max("tot_allarmi_log").alias("_log_max")), list(by))
    w = K.COMPOSITE_WEIGHTS
    score = (F.col("tot_allarmi_log") / F.greatest(log_max, F.lit(1.0)) * w["log_volume"]
             + F.col("score_rischio_esiti") * w["outcome_risk"]
             + F.col("pct_interpol") * w["interpol"]
             + F.col("tasso_rilevanza") * w["relevance"])
    return f.withColumn("score_composito", clip(score, 0, 1)).drop("_log_max")


def feature_quality_report(features: DataFrame) -> DataFrame:
    """One-row quality summary of a feature table."""
    nums = ALARM_NUMERIC + TRAVELLER_NUMERIC + ["score_composito"]
    na = F.col("n_osservazioni_allarmi")
    nv = F.col("n_osservazioni_viag")
    null_total = sum_cols([F.count_if(F.col(c).isNull()) for c in features.columns])
    neg_total = sum_cols([F.count_if(F.col(c) < 0) for c in nums])
    return features.agg(
        F.count(F.lit(1)).alias("n_rotte"),
        F.lit(len(nums)).alias("n_features"),
        null_total.alias("null_totali"),
        neg_total.alias("negativi_totali"),
        F.round(F.avg("score_composito"), 4).alias("score_mean"),
        F.round(F.max("score_composito"), 4).alias("score_max"),
        F.round(F.min("score_composito"), 4).alias("score_min"),
        F.count_if((na > 0) & (nv > 0)).alias("entrambi_dataset"),
        F.count_if((na > 0) & (nv == 0)).alias("solo_allarmi"),
        F.count_if((na == 0) & (nv > 0)).alias("solo_viaggiatori"),
    )
