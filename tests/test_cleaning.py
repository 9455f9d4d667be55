"""Hand-computed cleaning fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lanewatch import constants as K
from lanewatch.functions import cleaning as C
from lanewatch.operators import baseline as B


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_parse_date_shapes(spark):
    vals = ["2024-01-15 10:30:00", "2024-01-15T10:30:00", "2024-01-15", "2024/01/15", "15.01.2024", "15-01-24",
            "GEN 15 2024", "garbage", None, "15-01-70"]
    out = [r[0] for r in one_col(spark, vals).select(C.parse_date(F.col("x"))).collect()]
    assert [o.date() if o else None for o in out[:7]] == [dt.date(2024, 1, 15)] * 7
    assert out[7] is None and out[8] is None
    assert out[9].year == 1970


def test_extract_number(spark):
    out = [r[0] for r in one_col(spark, ["123 pax", "~45", "1,5", "20 voli", "abc"]).select(
        C.extract_number(F.col("x"))).collect()]
    assert out == [123.0, 45.0, 1.5, 20.0, None]


def test_count_domain(spark):
    out = [r[0] for r in one_col(spark, [-1.0, 1.5, 10000.0, 0.0, 9999.0], "double").select(
        C.count_domain(F.col("x"))).collect()]
    assert out == [None, None, None, 0.0, 9999.0]


def test_at_most_keeps_value_with_null_comparand(spark):
    df = spark.createDataFrame([(5.0, 6.0), (None, 6.0)], "a double, b double")
    out = [r[0] for r in df.select(F.coalesce(C.at_most(F.col("b"), F.col("a")), F.lit(0.0))).collect()]
    assert out == [0.0, 6.0]


def test_gender(spark):
    out = [r[0] for r in one_col(spark, ["M.", "Maschio", "donna", "1"]).select(C.gender(F.col("x"))).collect()]
    assert out == ["M", "M", "F", None]


def test_null_tokens(spark):
    out = [r[0] for r in one_col(spark, K.NULL_TOKENS + ["ND "]).select(C.null_tokens(F.col("x"))).collect()]
    assert out[:-1] == [None] * len(K.NULL_TOKENS) and out[-1] == "ND "


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (1, "b"), (2, None)], "g int, v string")
    out = {r[0]: r[1] for r in df.groupBy("g").agg(F.coalesce(F.mode("v", True), F.lit("ND"))).collect()}
    assert out == {1: "a", 2: "ND"}


def test_percentile_linear(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("x"))
    assert df.agg(F.percentile("x", 0.97)).first()[0] == pytest.approx(97.03)


def test_robust_z_fallbacks(spark):
    # f1: MAD > 0; f2: MAD = 0 but std > 0 (sparse); f3: constant
    rows = [(f"r{i}", float(i), 0.0 if i < 8 else 5.0, 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "ROTTA string, f1 double, f2 double, f3 double")
    out = B.robust_zscores(df, ["f1", "f2", "f3"]).orderBy("ROTTA").collect()
    import numpy as np
    f1 = np.arange(10.0)
    med = np.median(f1)
    mad = np.median(np.abs(f1 - med))
    assert out[0]["z_f1"] == pytest.approx((0 - med) / (1.4826 * mad))
    f2 = np.array([0.0] * 8 + [5.0] * 2)
    assert out[9]["z_f2"] == pytest.approx((5.0 - np.median(f2)) / f2.std(ddof=1))
    assert all(r["z_f3"] == 0.0 for r in out)


def test_shares_use_all_motives(spark):
    from lanewatch.operators.features import alarm_entity_aggregate
    rows = [(i, "R", "INTERPOL" if i == 0 else "OTHER", 1.0, None, 1, "X") for i in range(4)]
    df = spark.createDataFrame(rows, "_rid long, ROTTA string, MOTIVO_ALLARME string, TOT double, "
                                     "OCCORRENZE string, ZONA int, PAESE_PART string")
    r = alarm_entity_aggregate(df).first()
    assert r["pct_interpol"] == pytest.approx(0.25)


def test_date_rules_filed_by_separator_equal_all_rules_in_turn(spark):
    vals = ["2024-01-15 10:30:00", "2024-1-5T1:3:0", "2024-01-15", "2024/1/15", "15.01.2024", "15-1-24", "15-01-70", "5/1/2024", "5/1/2024 1:30",
            "5/1/2024 1:30:07", "15-01-2024", "15 1 2024", "Jan 15 2024", "2024-01-15\n", "1/2", "T", "1.2.2024T", "1-2/2024", ":", "", None]
    turn = F.col("x")
    for rule in [r for _, rules in C._CANONICAL for r in rules]:
        turn = F.regexp_replace(turn, *rule)
    for r in one_col(spark, vals).select("x", C.canonical_date_text("x").alias("a"), turn.alias("b")).collect():
        assert r["a"] == r["b"], r


@pytest.mark.parametrize("feed", ["alarm", "traveller"])
def test_cleaning_methods_are_short_enough_to_be_compiled(spark, feed):
    from lanewatch.operators import cleaning as CL
    from lanewatch.sources import proxy
    from tests.conftest import SMALL
    df = {"alarm": CL.clean_alarms, "traveller": CL.clean_travellers}[feed](getattr(proxy, f"raw_{feed}_feed")(spark, SMALL))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000      # the JVM's limit
