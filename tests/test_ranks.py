"""Two-level ranks equal plain window ranks."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lanewatch.operators.ranks import average_rank, average_rank_by, dense_position, dense_position_by


def test_dense_and_average_ranks(spark):
    rng = np.random.default_rng(3)
    n = 400
    pdf = pd.DataFrame({"k": [f"k{i:04d}" for i in range(n)], "g": rng.integers(0, 5, n),
                        "s": rng.integers(0, 30, n).astype(float)})
    df = spark.createDataFrame(pdf).repartition(6)
    pos = {r["k"]: r["rank"] for r in dense_position(df, [F.desc("s"), F.asc("k")]).collect()}
    exp = pdf.sort_values(["s", "k"], ascending=[False, True])["k"].tolist()
    assert [k for k, _ in sorted(pos.items(), key=lambda x: x[1])] == exp
    by = {r["k"]: r["rank"] for r in dense_position_by(df, "g", [F.asc("s"), F.asc("k")]).collect()}
    for _, grp in pdf.groupby("g"):
        order = grp.sort_values(["s", "k"])["k"].tolist()
        assert [by[k] for k in order] == list(range(1, len(order) + 1))
    avg = {r["k"]: r["r"] for r in average_rank_by(df, "g", "s", "k", "r").collect()}
    exp_avg = pdf.assign(r=pdf.groupby("g")["s"].rank(method="average"))
    assert all(abs(avg[k] - r) < 1e-9 for k, r in zip(exp_avg["k"], exp_avg["r"]))
    glob = {r["k"]: r["r"] for r in average_rank(df, "s", "k", "r", descending=True).collect()}
    exp_g = (-pdf["s"]).rank(method="average")
    assert all(abs(glob[k] - r) < 1e-9 for k, r in zip(pdf["k"], exp_g))


def test_shuffled_positions_are_a_bijection(spark):
    from pyspark.sql import functions as F

    from lanewatch.functions.columns import shuffled_position
    for n in (1, 2, 3, 5, 17, 625, 1000):
        df = spark.range(n).select("id", *[shuffled_position("id", n, F.lit(7), F.lit(s)).alias(f"p{s}") for s in range(3)])
        rows = df.collect()
        assert all(sorted(r[f"p{s}"] for r in rows) == list(range(n)) for s in range(3))
        if n > 100:
            assert [r.p0 for r in rows] != [r.p1 for r in rows] and sum(r.p0 == r.id for r in rows) < 10
