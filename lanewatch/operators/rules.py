"""Business rules, risk tiers, drivers, profiles and roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewatch import constants as K
from lanewatch.functions.columns import lookup, sum_cols

# ---------------------------------------------------------------- FIXED VALUES
RECOMMENDATIONS = {
    "CRITICAL": "Immediate alert — mandatory manual verification and reporting to superiors",
    "HIGH": "Enhanced monitoring — increase inspection frequency on the route",
    "MEDIUM": "Under observation — maintain heightened attention for the next 30 days",
    "LOW": "No action required — routine monitoring",
}
ZONE_LABELS = {
    1: "UE / Schengen",
    2: "Nord Africa / Medio Oriente",
    3: "Africa Sub-Sahariana",
    4: "Asia / Oceania",
    5: "Africa settentrionale",
    6: "Americhe",
    7: "Europa Extra-UE",
    8: "Maghreb",
}
TIER_RANK = {"CRITICAL": 4, "HIGH": 3, "MEDIUM": 2, "LOW": 1}
# ------------------------------------------------------------ END FIXED VALUES


def num(df: DataFrame, c: str) -> Column:
    """Numeric column with null -> 0, or a zero column when missing."""
    if c in df.columns:
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return F.lit(0.0)


def rule_columns(df: DataFrame, t: dict | None = None) -> dict[str, Column]:
    """R1–R5 as named boolean Columns (declarative rule list)."""
    t = {**K.RULE_THRESHOLDS, **(t or {})}
    return {
        "br_high_interpol": num(df, "pct_interpol") >= t["high_interpol_pct"],
        "br_high_rejection": num(df, "tasso_respinti") >= t["high_rejection_rate"],
        "br_low_closure": (num(df, "tot_allarmi_log") > t["low_closure_volume"])
                          & (num(df, "tasso_chiusura") < t["low_closure_rate"]),
        "br_multi_source": (num(df, "pct_interpol") >= t["multi_source_pct"])
                           & (num(df, "pct_sdi") >= t["multi_source_pct"]),
        "br_high_alarm_rate": num(df, "tasso_allarme_medio") >= t["high_alarm_rate"],
    }


def tier(label: Column, br_score: Column) -> Column:
    """The CRITICAL / HIGH / MEDIUM / LOW ladder."""
    strong = br_score >= K.TIER_RULE_SCORE
    return (F.when((label == "HIGH") & strong, "CRITICAL")
             .when((label == "HIGH") | ((label == "MEDIUM") & strong), "HIGH")
             .when(label == "MEDIUM", "MEDIUM")
             .otherwise("LOW"))


def apply_rules(df: DataFrame, thresholds: dict | None = None, score_col: str = "ensemble_score",
                label_col: str = "anomaly_label") -> DataFrame:
    """Rule flags, br_score, confidence, final_risk, risk_drivers."""
    rules = rule_columns(df, thresholds)
    out = df.withColumns({name: c.cast("int") for name, c in rules.items()})
    br = sum_cols([F.col(n) for n in rules]) / F.lit(float(len(rules)))
    out = out.withColumn("br_score", br)
    ml = num(out, score_col)
    out = out.withColumn(
        "confidence",
        F.bround(K.CONFIDENCE_WEIGHTS["ml"] * ml + K.CONFIDENCE_WEIGHTS["rules"] * F.col("br_score"), 4))
    out = out.withColumn("final_risk", tier(F.coalesce(F.col(label_col), F.lit("NORMAL")), F.col("br_score")))
    drivers = F.array(*[F.when(F.col(n) == 1, F.lit(K.RULE_LABELS[n])) for n in rules])
    return out.withColumn("risk_drivers", F.array_compact(drivers))


def risk_num(c: Column) -> Column:
    return lookup(TIER_RANK, c)


def alerts(risk: DataFrame, min_conf: float = K.ALERT_MIN_CONFIDENCE) -> DataFrame:
    """C28 + W6: alert rows (tier >= MEDIUM, confidence >= 0.20) in review order."""
    return (risk.filter(F.col("final_risk").isin(K.ALERT_TIERS) & (F.col("confidence") >= min_conf))
                .withColumn("risk_num", risk_num(F.col("final_risk"))))


def tier_distribution(risk: DataFrame, col: str = "final_risk", domain=None) -> DataFrame:
    """Counts per value in a fixed order, zero-filled (domain LEFT JOIN counts)."""
    domain = domain or K.RISK_TIERS
    spark = risk.sparkSession
    dom = spark.range(len(domain)).select(
        F.col("id").cast("int").alias("ord"),
        F.element_at(F.array(*[F.lit(v) for v in domain]), (F.col("id") + 1).cast("int")).alias(col))
    cnt = risk.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return (dom.join(cnt, on=col, how="left")
               .select("ord", col, F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def rule_hits(risk: DataFrame) -> DataFrame:
    """Routes hitting each rule (one aggregation, unpivoted)."""
    names = list(K.RULE_LABELS)
    wide = risk.agg(*[F.sum(F.col(n)).cast("bigint").alias(n) for n in names])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(n).alias("rule"), F.lit(K.RULE_LABELS[n]).alias("label"),
                 F.col(n).alias("n_hits")) for i, n in enumerate(names)])))


def zone_label(z: Column) -> Column:
    """Zone code (string or number) -> label; unknown -> 'Zona n'; missing -> unclassified."""
    zi = z.cast("string").try_cast("double").cast("int")
    return (F.when(z.isNull() | z.cast("string").isin("ND", "nan", ""), F.lit("Non classificata"))
             .when(zi.isNull(), F.lit("Non classificata"))
             .otherwise(F.coalesce(lookup(ZONE_LABELS, zi), F.concat(F.lit("Zona "), zi.cast("string")))))


def country_rollup(risk: DataFrame) -> DataFrame:
    """Per departure country: counts, alerts, confidence stats, max tier."""
    alert = F.col("final_risk").isin(K.ALERT_TIERS)
    g = (risk.filter(F.col("PAESE_PART") != "ND")
             .groupBy("PAESE_PART")
             .agg(F.count("ROTTA").alias("n_rotte"),
                  F.count_if(alert).alias("n_alert"),
                  F.max(risk_num(F.col("final_risk"))).alias("max_risk_num"),
                  F.max("confidence").alias("max_confidence"),
                  F.avg("confidence").alias("mean_confidence"),
                  F.sum("tot_allarmi_sum").alias("tot_allarmi"),
                  F.avg("pct_interpol").alias("mean_interpol"),
                  F.avg("score_rischio_esiti").alias("mean_esiti")))
    inv = {v: k for k, v in TIER_RANK.items()}
    return g.select("*", F.coalesce(lookup(inv, F.col("max_risk_num")), F.lit("LOW")).alias("max_risk_label"),
                    F.round(F.col("n_alert") / F.col("n_rotte"), 3).alias("alert_rate"))


def zone_rollup(risk: DataFrame) -> DataFrame:
    """Per zone label, with an unclassified bucket."""
    alert = F.col("final_risk").isin(K.ALERT_TIERS)
    inv = {v: k for k, v in TIER_RANK.items()}
    g = (risk.withColumn("zona_label", zone_label(F.col("ZONA")))
             .groupBy("zona_label")
             .agg(F.count("ROTTA").alias("n_rotte"), F.count_if(alert).alias("n_alert"),
                  F.max("confidence").alias("max_confidence"), F.avg("confidence").alias("mean_confidence"),
                  F.max(risk_num(F.col("final_risk"))).alias("max_risk_num")))
    return g.select("*", F.round(F.col("n_alert") / F.col("n_rotte"), 3).alias("alert_rate"),
                    F.coalesce(lookup(inv, F.col("max_risk_num")), F.lit("LOW")).alias("max_risk_label"))


def profiles(risk: DataFrame, features=None, score_col: str = "ensemble_score") -> DataFrame:
    """Nested profile per alert entity (flags list, rules list, indicators, advice)."""
    feats = [c for c in (features or K.BASELINE_FEATURES) if "flag_" + c in risk.columns]
    flags = F.array_compact(F.array(*[F.when(F.col("flag_" + c) == 1, F.lit(c)) for c in feats])) \
        if feats else F.array().cast("array<string>")
    a = alerts(risk)
    return a.select(
        F.col("ROTTA").alias("rotta"),
        F.col("PAESE_PART").cast("string").alias("paese_partenza"),
        zone_label(F.col("ZONA")).alias("zona"),
        "final_risk", "anomaly_label",
        F.bround("confidence", 4).alias("confidence"),
        F.bround(F.col(score_col), 4).alias("anomaly_score"),
        F.bround("br_score", 4).alias("br_score"),
        (F.col("n_anomalie").cast("int") if "n_anomalie" in risk.columns else F.lit(0)).alias("n_anomalie_baseline"),
        flags.alias("feature_anomale"),
        F.col("risk_drivers").alias("business_rules_active"),
        F.struct(
            F.col("tot_allarmi_sum").cast("bigint").alias("tot_allarmi"),
            *[F.bround(num(risk, c), 4).alias(c) for c in
              ["tot_allarmi_log", "pct_interpol", "pct_sdi", "pct_nsis", "score_rischio_esiti",
               "tasso_chiusura", "tasso_respinti"]]).alias("indicators"),
        lookup(RECOMMENDATIONS, F.col("final_risk")).alias("recommendation"),
    )


def alert_summary(risk: DataFrame) -> DataFrame:
    """Totals, alert rate, confidence stats with arg-max entity, counts above cut-offs."""
    alert = F.col("final_risk").isin(K.ALERT_TIERS)
    alert_conf = F.when(alert & (F.col("confidence") >= K.ALERT_MIN_CONFIDENCE), F.col("confidence"))
    return risk.agg(
        F.count(F.lit(1)).alias("n_total"),
        *[F.count_if(F.col("final_risk") == t).alias(f"n_{t.lower()}") for t in K.RISK_TIERS],
        F.count_if(alert).alias("n_alert"),
        F.round(F.count_if(alert) * 100.0 / F.count(F.lit(1)), 2).alias("alert_rate_pct"),
        F.avg(alert_conf).alias("mean_confidence_alert"),
        F.max("confidence").alias("max_confidence"),
        F.min_by("ROTTA", F.struct(-F.col("confidence"), F.col("ROTTA"))).alias("top_route"),
        F.min_by("PAESE_PART", F.struct(-F.col("confidence"), F.col("ROTTA"))).alias("top_country"),
        F.count_if(F.col("confidence") > 0.5).alias("n_conf_gt_50"),
        F.count_if(F.col("confidence") > 0.4).alias("n_conf_gt_40"),
        F.count_if(F.col("confidence") > 0.3).alias("n_conf_gt_30"),
    )


def rule_what_if(scored: DataFrame, scenarios: list[dict], score_col: str = "ensemble_score",
                 label_col: str = "anomaly_label") -> DataFrame:
    """R13 / E3 core: re-run only the rule layer under each threshold scenario.

    Scenarios (a short parameter list) become rows through ``explode`` of a
    literal array — one pass over the scored table, no join; counts per tier
    are conditional aggregates grouped by scenario id.
    """
    names = sorted({k for s in scenarios for k in s} | set(K.RULE_THRESHOLDS))
    arr = F.array(*[F.struct(F.lit(i).alias("scenario_id"),
                             *[F.lit(float({**K.RULE_THRESHOLDS, **s}[n])).alias(n) for n in names])
                    for i, s in enumerate(scenarios)])
    x = scored.select(num(scored, "pct_interpol").alias("pi"), num(scored, "tasso_respinti").alias("tr"),
                      num(scored, "tot_allarmi_log").alias("tl"), num(scored, "tasso_chiusura").alias("tc"),
                      num(scored, "pct_sdi").alias("ps"), num(scored, "tasso_allarme_medio").alias("ta"),
                      F.coalesce(F.col(label_col), F.lit("NORMAL")).alias("lab"),
                      F.explode(arr).alias("s"))
    s = F.col("s")
    hits = [(F.col("pi") >= s["high_interpol_pct"]),
            (F.col("tr") >= s["high_rejection_rate"]),
            (F.col("tl") > s["low_closure_volume"]) & (F.col("tc") < s["low_closure_rate"]),
            (F.col("pi") >= s["multi_source_pct"]) & (F.col("ps") >= s["multi_source_pct"]),
            (F.col("ta") >= s["high_alarm_rate"])]
    br = sum_cols([h.cast("int") for h in hits]) / F.lit(5.0)
    x = x.select(s["scenario_id"].alias("scenario_id"), tier(F.col("lab"), br).alias("final_risk"))
    return x.groupBy("scenario_id").agg(
        *[F.count_if(F.col("final_risk") == t).alias(t) for t in K.RISK_TIERS])
