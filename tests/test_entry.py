"""Driver contract: entry() runs, and a sample of queries agrees with the DuckDB oracle."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SMALL = "/root/testdata/sf0.001"
SAMPLE = ["entity_features", "risk_tiers", "clean_travellers", "rate_by_dimension", "lof_scores",
          "threshold_sensitivity", "text_quality", "monthly_drift"]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "final_risk" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_agreement(spark, name):
    con = duck(SMALL)
    a = E.queries()[name](spark, SMALL).toPandas()
    b = con.execute(E.oracle_sql()[name]).df()
    ok, msg = compare(a, b)
    assert ok, msg
