"""Standard scaling with population std, zero-variance safe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewatch.operators.baseline import one_row


def standard_scale(df: DataFrame, features: list[str], fill: float = 0.0, by: tuple[str, ...] = ()) -> DataFrame:
    """(x - mean) / std_pop per feature (std 0 -> 1), over the table or every group of ``by``; nulls are filled first.

    One aggregation for all features; other columns pass through.
    """
    x = {c: F.coalesce(F.col(c).cast("double"), F.lit(fill)) for c in features}
    aggs = [e for i, c in enumerate(features) for e in (F.avg(x[c]).alias(f"m{i}"), F.stddev_pop(x[c]).alias(f"s{i}"))]
    if by:
        known = df.join(df.groupBy(*by).agg(*aggs), list(by))
        return known.withColumns({c: (x[c] - F.col(f"m{i}")) / F.when(F.col(f"s{i}") > 0, F.col(f"s{i}")).otherwise(F.lit(1.0))
                                  for i, c in enumerate(features)}).select(*df.columns)
    st = one_row(df.agg(*aggs))
    out = {}
    for i, c in enumerate(features):
        s = st[f"s{i}"]
        out[c] = (x[c] - st[f"m{i}"]) / F.when(s > 0, s).otherwise(F.lit(1.0))
    return df.withColumns(out)
