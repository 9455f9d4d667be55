"""Narration plan on both sides of its threshold; the number guardrail; exact costs; the run manifest."""

import pytest
from pyspark.sql import functions as F

from lanewatch.operators import explain as EX
from lanewatch.sources import files as FS

RISK = "ROTTA string, final_risk string, anomaly_label string, confidence double, ensemble_score double, risk_drivers array<string>"


def _rows(n):
    """n narrated routes in three patterns, and some of lower tiers."""
    rows = [(f"R{i:02d}", "HIGH" if i % 3 else "CRITICAL", "HIGH", i / 100, 0.5, ["b", "a"] if i % 2 else []) for i in range(n)]
    return rows + [("L1", "LOW", "NORMAL", 0.9, 0.1, []), ("L2", "medium", "HIGH", 0.9, 0.1, []),
                   ("N1", None, "NORMAL", None, 0.1, [])]


@pytest.mark.parametrize("n", [0, 1, 15, 16, 40])
def test_patterns_are_deduplicated_past_the_threshold(spark, n):
    rows = _rows(n)
    got = {r.ROTTA: r for r in EX.narration_plan(spark.createDataFrame(rows, RISK)).collect()}
    assert len(got) == len(rows)
    best = {}
    for route, tier, _, confidence, score, rules in rows[:n]:
        weight = confidence or score
        pattern = (tuple(sorted(rules)), tier)
        if pattern not in best or weight > best[pattern][0]:
            best[pattern] = (weight, route)
    reps = {route for _, route in best.values()}
    for route, *_ in rows[:n]:
        assert got[route].is_representative == (route in reps)
        assert got[route].source == ("llm" if n <= 15 or route in reps else "dedup_template")
    assert all(got[r].source == "template" and not got[r].is_representative for r in ("L1", "L2", "N1"))


def test_guardrail(spark):
    cases = [
        ("rate 0.35 and 1200 of 17", "rate 0.35, 1200 and 3", "rate 0.35, 1200 and 3", 0),      # small whole numbers stay
        ("rate 0.35 and 1200", "35 percent, 0.71, 99999", "35 percent, 0.35, 1200", 2),        # 35 = 0.35 * 100
        ("between 2 and 4.5", "3.0 and 3.25 or -8.5", "2 and 2 or 2", 3),                         # 3.25 lies halfway: the smaller one
        ("no figures", "0.5 stays", "0.5 stays", 0),
        (None, "100", "100", 0), ("1", None, "", 0), ("7", "", "", 0),
        ("12.5", "end 800.", "end 12.50", 1),
    ]
    df = spark.createDataFrame([(i, c, t) for i, (c, t, *_) in enumerate(cases)], "i int, context string, text string")
    got = EX.guardrail(df).orderBy("i").collect()
    assert [(r.guarded_text, r.guardrail_fixes) for r in got] == [(w, n) for *_, w, n in cases]


def test_costs_are_exact(spark):
    df = spark.createDataFrame([("g", "c" * 4, "t" * 4 * 267, 1.0, 0, False, 1)] * 2 + [("g", "c" * 4, "t" * 4 * 268, 1.0, 0, False, 1)] * 2,
                               "g string, context string, text string, faithfulness double, hallucinated_count int, empty boolean, sentences int")
    row = EX.quality_by_group(EX.token_cost(df, F.lit("claude-sonnet-4-5")), "g").collect()[0]
    assert row.cost_per_item == 0.004016 and row.run_17_usd == 0.068264      # 0.0040155 and 0.0682635, halves up


def test_manifest_returns_the_latest_run(spark, tmp_path):
    path = str(tmp_path / "manifest")
    assert FS.last_perimeter(spark, path) is None
    for year in (2020, 2024, 2021):
        FS.append_manifest(spark, path, {"anno": year, "zona": None}, {}, {})
        assert FS.last_perimeter(spark, path) == {"anno": year}
