"""File sources and sinks (S1–S9): CSV with separator sniffing, typed reads,
partitioned parquet / CSV / JSON writes and a run manifest.

Writes go to shared storage (the caller's path, or a folder under the
session's ``spark.checkpoint.dir``), never to a machine-local temp folder.
"""

from __future__ import annotations

import csv
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from lanewatch.session import checkpoint_dir

SEPARATORS = [",", ";", "\t"]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _header(spark: SparkSession, path: str) -> str:
    head = spark.read.text(path).limit(1).collect()
    if not head:
        raise ValueError(f"cannot load {path}: empty file")
    return head[0][0]


def _columns(line: str, sep: str) -> list[str]:
    """Names in a header line; a separator inside quotes belongs to the name."""
    return [c.strip() for c in next(csv.reader([line], delimiter=sep))]


def _separator(line: str, path: str) -> str:
    for sep in SEPARATORS:
        if len(_columns(line, sep)) > 1:
            return sep
    raise ValueError(f"cannot load {path}: no separator among {SEPARATORS!r}")


def sniff_separator(spark: SparkSession, path: str) -> str:
    """The first of , ; tab that splits the header line into more than one column."""
    return _separator(_header(spark, path), path)


def load_csv(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """All-string CSV read with an explicit schema built from the header line (read once)."""
    head = _header(spark, path)
    sep = sep or _separator(head, path)
    schema = StructType([StructField(c, StringType()) for c in _columns(head, sep)])
    return (spark.read.schema(schema).option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
                 .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
                 .option("nullValue", None).csv(path))


def load_typed(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
               timestamp_format: str | None = None) -> DataFrame:
    """Typed read with an explicit schema (missing path -> AnalysisException)."""
    r = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format)
    return r.load(path)


def flatten_lists(df: DataFrame, sep: str = " | ") -> DataFrame:
    """array<string> columns joined for CSV output."""
    return df.select(*[F.array_join(F.col(f.name), sep).alias(f.name)
                       if isinstance(f.dataType, ArrayType) else F.col(f.name) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    """S4 (CSV flavour): header, lists flattened, whitespace preserved."""
    (flatten_lists(df).write.mode("overwrite").option("header", True).option("sep", sep)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def write_parquet(df: DataFrame, path: str, partition_by=()) -> str:
    """Parquet, optionally partitioned (e.g. by year / month for feeds)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """JSON lines of struct rows (NaN / infinities written as null)."""
    out = df.select(*[F.when(F.col(f.name).isin(float("inf"), float("-inf")) | F.isnan(F.col(f.name)), None)
                      .otherwise(F.col(f.name)).alias(f.name)
                      if f.dataType.typeName() in ("double", "float") else F.col(f.name) for f in df.schema.fields])
    out.write.mode("overwrite").json(path)
    return path


def to_records(df: DataFrame, col: str = "record") -> DataFrame:
    """Each row as a JSON record string (ISO timestamps)."""
    return df.select(F.to_json(F.struct(*df.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"}).alias(col))


def from_records(df: DataFrame, schema: StructType, col: str = "record") -> DataFrame:
    """Parse JSON record strings back with an explicit schema."""
    return df.select(F.from_json(F.col(col), schema, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"}).alias("r")).select("r.*")


def append_manifest(spark: SparkSession, path: str, perimeter: dict, stats: dict, outputs: dict) -> None:
    """Append one JSON row describing a run (perimeter, stats, output paths)."""
    row = {"run_id": f"{time.time_ns():020d}-{uuid.uuid4().hex}", "perimeter": json.dumps(perimeter, sort_keys=True),
           "stats": json.dumps(stats, sort_keys=True, default=str), "outputs": json.dumps(outputs, sort_keys=True)}
    spark.createDataFrame([row]).write.mode("append").json(path)


def last_perimeter(spark: SparkSession, path: str) -> dict | None:
    """Perimeter of the latest manifest row (run ids start with their time), null keys dropped."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    df = spark.read.json(path)
    rows = df.orderBy(F.desc("run_id")).limit(1).collect()
    if not rows:
        return None
    p = json.loads(rows[0]["perimeter"])
    return {k: v for k, v in p.items() if v is not None}
