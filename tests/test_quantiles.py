"""Distributed quantiles against sorted values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lanewatch.operators import quantiles as Q

QS = [0.0, 0.025, 0.25, 0.5, 0.75, 0.97, 0.99, 1.0]


def expected(values, q):
    v = sorted(values)
    p = (len(v) - 1) * q
    a, b = math.floor(p), math.ceil(p)
    return v[a] if a == b else (b - p) * v[a] + (p - a) * v[b]


def rows(seed=1, n=6000):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        heavy = rng.random() < 0.4                                  # one value holds 40 % of the rows
        out.append((i, ("a", "b", None)[i % 3] if i % 50 else "rare", 7.5 if heavy else rng.gauss(0, 100),
                    None if rng.random() < 0.2 else 10.0 ** rng.randrange(-200, 200), 1.0, float(rng.randrange(5)), None))
    return out


SCHEMA = "k long, g string, heavy double, wide double, constant double, few double, nothing double"
COLS = ["heavy", "wide", "constant", "few", "nothing"]


@pytest.mark.parametrize("cap", [50_000, 700, 40, 3])
def test_columns_and_groups(spark, cap):
    """Whole ids sorted, one search, and searches inside searches give the same."""
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    accuracy = 10_000 if cap >= 700 else 50                         # a coarse sketch needs further rounds
    got = {(r.g, r.column): r for r in Q.quantiles_by(df, {c: c for c in COLS}, QS, ("g",), accuracy=accuracy, cap=cap).collect()}
    want = {}
    for r in data:
        for i, c in enumerate(COLS):
            if r[2 + i] is not None:
                want.setdefault((r[1], c), []).append(r[2 + i])
    assert set(got) == set(want)
    for key, values in want.items():
        assert got[key].n == len(values)
        for q, x in zip(QS, got[key].q):
            assert math.isclose(x, expected(values, q), rel_tol=1e-12), (key, q)


def test_equals_percentile(spark):
    df = spark.createDataFrame(rows(2, 3000), SCHEMA)
    got = Q.quantiles(df, {c: F.col(c) for c in COLS}, QS)
    want = df.agg(*[F.percentile(c, QS).alias(c) for c in COLS]).first()
    assert got["nothing"] == [None] * len(QS) and want.nothing is None
    for c in COLS[:-1]:
        assert got[c] == pytest.approx(want[c], rel=1e-12)


def test_known_bound_and_sketch(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    assert Q.quantiles(df, {"x": "x"}, [0.5, 0.97], at_most=101)["x"] == pytest.approx([50.0, 97.0])
    assert Q.quantiles(df, {"x": "x"}, [0.5], exact=False)["x"] == [50.0]


def test_empty(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert Q.quantiles(df, {"x": "x"}, [0.5]) == {"x": [None]}
    assert Q.quantiles_by(df, {"x": "x"}, [0.5], ("g",)).count() == 0


@pytest.mark.parametrize("cap", [50_000, 700, 40, 3])
def test_whole_columns_take_one_job_a_pass(spark, cap):
    """The same numbers by sorting, one search and searches inside searches, without tables of borders and counts."""
    data = rows(3)
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    sc = spark.sparkContext
    sc.setJobGroup(f"quantiles-{cap}", "search")
    try:
        got = Q.quantiles(df, {c: c for c in COLS}, QS, accuracy=10_000 if cap >= 700 else 50, cap=cap)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    for i, c in enumerate(COLS[:-1]):
        values = [r[2 + i] for r in data if r[2 + i] is not None]
        assert got[c] == pytest.approx([expected(values, q) for q in QS], rel=1e-12)
    assert got["nothing"] == [None] * len(QS)
    if cap >= 700:
        assert len(sc.statusTracker().getJobIdsForGroup(f"quantiles-{cap}")) <= 9     # three passes of two or three stages
