"""Month-over-month risk drift per entity (lag over each entity's own months)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewatch.functions.columns import safe_div


def monthly_drift(alarms: DataFrame, key: str = "ROTTA", ts: str = "DATA_PARTENZA", threshold: float = 0.20) -> DataFrame:
    """Per (entity, month): volume and INTERPOL share, their change versus the entity's
    previous month with data, and a drift flag when the share moves by >= threshold."""
    m = F.col("MOTIVO_ALLARME")
    g = (alarms.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
               .groupBy(key, F.date_format(ts, "yyyy-MM").alias("month"))
               .agg(F.count(F.lit(1)).alias("n_alarms"),
                    safe_div(F.count_if(m == "INTERPOL"), F.count(m)).alias("pct_interpol")))
    w = Window.partitionBy(key).orderBy("month")
    prev_n, prev_p = F.lag("n_alarms").over(w), F.lag("pct_interpol").over(w)
    g = g.select("*", prev_n.alias("prev_n_alarms"), (F.col("pct_interpol") - prev_p).alias("delta_pct_interpol"))
    return g.withColumn("drift", F.coalesce(F.abs("delta_pct_interpol") >= threshold, F.lit(False)))
