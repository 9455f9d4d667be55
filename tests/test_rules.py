"""Business-rule layer: each rule below / at / above its threshold, rule score,
confidence blend and the tier ladder (rows as data)."""

import pytest

from lanewatch import constants as K
from lanewatch.operators import rules as R

# A row that fires no rule.
BASE = {"ROTTA": "AAA-BBB", "PAESE_PART": "X", "ZONA": "1", "anomaly_label": "NORMAL", "ensemble_score": 0.10,
        "pct_interpol": 0.05, "pct_sdi": 0.05, "pct_nsis": 0.0, "tasso_respinti": 0.10, "tot_allarmi_log": 2.0,
        "tasso_chiusura": 0.50, "tasso_allarme_medio": 0.10}
SCHEMA = ("ROTTA string, PAESE_PART string, ZONA string, anomaly_label string, ensemble_score double, "
          "pct_interpol double, pct_sdi double, pct_nsis double, tasso_respinti double, tot_allarmi_log double, "
          "tasso_chiusura double, tasso_allarme_medio double")


def run(spark, **over):
    row = {**BASE, **over}
    df = spark.createDataFrame([tuple(row[k] for k in BASE)], SCHEMA)
    return R.apply_rules(df).first()


def test_default_row_fires_nothing(spark):
    r = run(spark)
    assert all(r[n] == 0 for n in K.RULE_LABELS) and r["br_score"] == 0.0 and r["risk_drivers"] == []


@pytest.mark.parametrize("over,rule,expected", [
    ({"pct_interpol": 0.29}, "br_high_interpol", 0), ({"pct_interpol": 0.30}, "br_high_interpol", 1),
    ({"pct_interpol": 0.31}, "br_high_interpol", 1),
    ({"tasso_respinti": 0.24}, "br_high_rejection", 0), ({"tasso_respinti": 0.25}, "br_high_rejection", 1),
    ({"tot_allarmi_log": 3.0, "tasso_chiusura": 0.05}, "br_low_closure", 0),
    ({"tot_allarmi_log": 3.1, "tasso_chiusura": 0.10}, "br_low_closure", 0),
    ({"tot_allarmi_log": 3.1, "tasso_chiusura": 0.09}, "br_low_closure", 1),
    ({"pct_interpol": 0.10, "pct_sdi": 0.09}, "br_multi_source", 0),
    ({"pct_interpol": 0.10, "pct_sdi": 0.10}, "br_multi_source", 1),
    ({"tasso_allarme_medio": 0.49}, "br_high_alarm_rate", 0), ({"tasso_allarme_medio": 0.50}, "br_high_alarm_rate", 1),
])
def test_rule_thresholds(spark, over, rule, expected):
    assert run(spark, **over)[rule] == expected


def test_rule_score_and_drivers(spark):
    r3 = run(spark, pct_interpol=0.35, pct_sdi=0.2, tasso_respinti=0.3)
    assert r3["br_score"] == pytest.approx(0.6)
    assert r3["risk_drivers"] == [K.RULE_LABELS["br_high_interpol"], K.RULE_LABELS["br_high_rejection"],
                                  K.RULE_LABELS["br_multi_source"]]
    r5 = run(spark, pct_interpol=0.35, pct_sdi=0.2, tasso_respinti=0.3, tot_allarmi_log=4.0, tasso_chiusura=0.0,
             tasso_allarme_medio=0.9)
    assert r5["br_score"] == pytest.approx(1.0)


def test_confidence_blend(spark):
    r = run(spark, ensemble_score=0.5, pct_interpol=0.35, pct_sdi=0.2, tasso_respinti=0.3)
    assert r["confidence"] == pytest.approx(round(0.6 * 0.5 + 0.4 * 0.6, 4), abs=1e-4)


@pytest.mark.parametrize("label,over,tier", [
    ("HIGH", {"pct_interpol": 0.35, "pct_sdi": 0.2}, "CRITICAL"),
    ("HIGH", {}, "HIGH"),
    ("MEDIUM", {"pct_interpol": 0.35, "pct_sdi": 0.2}, "HIGH"),
    ("MEDIUM", {}, "MEDIUM"),
    ("NORMAL", {"pct_interpol": 0.35, "pct_sdi": 0.2}, "LOW"),
    ("NORMAL", {}, "LOW"),
])
def test_tier_ladder(spark, label, over, tier):
    assert run(spark, anomaly_label=label, **over)["final_risk"] == tier


def test_missing_rule_column_counts_as_zero(spark):
    df = spark.createDataFrame([("A-B", "NORMAL", 0.1)], "ROTTA string, anomaly_label string, ensemble_score double")
    r = R.apply_rules(df).first()
    assert r["br_score"] == 0.0 and r["final_risk"] == "LOW"
