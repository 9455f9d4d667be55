"""Parquet table access for the driver-generated star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Resolved readers per (session, path): a lazy DataFrame holds no data, but
# resolving it lists files and reads parquet footers, which is worth doing once.
_READERS: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark._jsparkSession), path)
    df = _READERS.get(key)
    if df is None:
        df = _READERS[key] = spark.read.parquet(path)
    return df
