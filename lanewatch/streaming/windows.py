"""Stream-static scoring of arriving alarm records (Structured Streaming).

Line items arrive as a file stream (one file or a directory of part files, in any
order of time); each micro-batch is joined to the static dimensions (orders,
customers, suppliers, nations) and aggregated per (tumbling window, route). The
aggregates are sums and counts, so a batch's part of a window is written on its own,
under the batch's number, and a window is the sum of its parts: the stream holds no
state, however long it runs and however late a record is. The watermark (largest
event time of earlier batches less ``delay``) says which windows are closed; parts that
arrive for a closed window are marked as corrections and counted, not dropped. A
batch that runs again overwrites its own folder; after every ``compact`` batches the
parts are summed into one folder, so their number stays bounded. Windows are then scored
with the window-level business rules against the frozen batch feature table. Sink and
checkpoint live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewatch import constants as K
from lanewatch.functions.columns import lookup, safe_div
from lanewatch.sources.files import scratch_path
from lanewatch.sources.proxy import MOTIVE_OF_PRIORITY
from lanewatch.sources.tables import table


def is_directory(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


def alarm_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """Streaming alarm records."""
    path = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    reader = (spark.readStream.schema(table(spark, sf_dir, "lineitem").schema)
                   .option("maxFilesPerTrigger", files_per_trigger))
    raw = reader.parquet(path) if is_directory(spark, path) else \
        reader.option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir)
    li = (raw.withColumn("ts", F.col("l_shipdate").cast("timestamp"))
             .filter(F.col("l_returnflag") == "R"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation")
    ns = nation.select(F.col("n_nationkey").alias("ns_key"), F.col("n_name").alias("ns_name"))
    nc = nation.select(F.col("n_nationkey").alias("nc_key"), F.col("n_name").alias("nc_name"))
    j = (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(cust, F.col("o_custkey") == F.col("c_custkey"))
           .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
           .join(ns, F.col("s_nationkey") == F.col("ns_key"))
           .join(nc, F.col("c_nationkey") == F.col("nc_key")))
    return j.select("ts", F.concat(F.upper("ns_name"), F.lit("-"), F.upper("nc_name")).alias("ROTTA"),
                    F.col("l_quantity").alias("TOT"),
                    lookup(MOTIVE_OF_PRIORITY, F.col("o_orderpriority")).alias("MOTIVO_ALLARME"))


SUMS = ["n_alarms", "tot", "n_interpol", "n_sdi", "n_motives"]
KEYS = ["window_start", "window_end", "ROTTA"]


def windowed_route_aggregates(records: DataFrame, window: str = "30 days") -> DataFrame:
    """A batch's part of every (window, route), and the largest event time in it."""
    m = F.col("MOTIVO_ALLARME")
    parts = records.groupBy(F.window("ts", window).alias("w"), "ROTTA").agg(
        F.count(F.lit(1)).alias("n_alarms"), F.sum("TOT").alias("tot"), F.count_if(m == "INTERPOL").alias("n_interpol"),
        F.count_if(m == "SDI").alias("n_sdi"), F.count(m).alias("n_motives"), F.max("ts").alias("latest"))
    return parts.select("w.start", "w.end", "ROTTA", *SUMS, "latest")


def summed(parts: DataFrame) -> DataFrame:
    """Windows from their parts."""
    return parts.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS], F.sum("corrections").alias("corrections"),
                                    F.max("latest").alias("latest"))


class PartsSink:
    """Writes each micro-batch's parts to ``folder/batch=n``; earlier parts are summed into one folder now and then."""

    def __init__(self, spark: SparkSession, folder: str, window: str, delay: str, compact: int = 50):
        self.spark, self.folder, self.window, self.delay, self.every = spark, folder, window, delay, compact
        self.latest = self.done = None

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _folders(self) -> list[str]:
        """Folders that count: the last sum and the batches behind it."""
        top = self._path("")
        fs = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(top) if fs.exists(self._path(f"{f.getPath().getName()}/_SUCCESS"))] \
            if fs.exists(top) else []
        upto = max((int(n.split("=")[1]) for n in names if n.startswith("upto=")), default=-1)
        return [f"upto={upto}"] * (upto >= 0) + sorted((n for n in names if n.startswith("batch=") and int(n.split("=")[1]) > upto),
                                                       key=lambda n: int(n.split("=")[1]))

    def parts(self, before: int | None = None) -> DataFrame | None:
        names = [n for n in self._folders() if before is None or int(n.split("=")[1]) < before]
        return self.spark.read.parquet(*[f"{self.folder}/{n}" for n in names]) if names else None

    def __call__(self, batch: DataFrame, number: int) -> None:
        if self.latest is None:                # also after a restart: what earlier batches saw
            earlier = self.parts(before=number)
            self.latest = earlier.agg(F.max("latest")).first()[0] if earlier is not None else None
        closed = F.col("end") <= F.lit(self.latest) - F.expr(f"INTERVAL {self.delay}") if self.latest is not None else F.lit(False)
        text = {c: F.date_format(c.removeprefix("window_"), "yyyy-MM-dd HH:mm:ss").alias(c) for c in KEYS[:2]}
        out = windowed_route_aggregates(batch, self.window).select(
            *text.values(), "ROTTA", *SUMS, F.when(closed, F.col("n_alarms")).otherwise(0).cast("long").alias("corrections"), "latest")
        out.write.mode("overwrite").parquet(f"{self.folder}/batch={number}")
        seen = self.spark.read.parquet(f"{self.folder}/batch={number}").agg(F.max("latest")).first()[0]
        self.latest = max(x for x in (self.latest, seen) if x is not None) if seen or self.latest else None
        names = self._folders()
        if number % self.every == self.every - 1 and f"upto={number}" not in names:
            summed(self.parts()).write.mode("overwrite").parquet(f"{self.folder}/upto={number}")
            for name in names:                 # their sum is written
                self._path(name).getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(self._path(name), True)


def run_window_job(spark: SparkSession, sf_dir: str, window: str = "30 days", delay: str = "90 days",
                   timeout_s: int = 600, compact: int = 50, progress: list | None = None) -> DataFrame:
    """Run the stream to the end of the available input and return all windows with every record, and how many of
    their alarms were ``corrections`` (came after the window had closed).

    Event times are wall-clock values; the job runs in UTC so window boundaries do not
    depend on the caller's session time zone, and writes them as text. ``progress`` takes the query's reports.
    """
    base = scratch_path(spark, "stream-windows")
    tz = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        sink = PartsSink(spark, f"{base}/out", window, delay, compact)
        q = (alarm_stream(spark, sf_dir).writeStream.outputMode("append").foreachBatch(sink)
             .option("checkpointLocation", f"{base}/checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination(timeout_s)
        if q.isActive:
            q.stop()
            raise TimeoutError("window stream did not finish")
        if progress is not None:
            progress += q.recentProgress
        parts = sink.parts()
    finally:
        spark.conf.set("spark.sql.session.timeZone", tz)
    if parts is None:
        return spark.createDataFrame([], "window_start string, window_end string, ROTTA string, n_alarms long, tot double, "
                                         "n_interpol long, n_sdi long, n_motives long, corrections long")
    return summed(parts).select(*KEYS, *SUMS, "corrections")


def score_windows(windows: DataFrame, frozen: DataFrame, key: str = "ROTTA") -> DataFrame:
    """Window-level rules R1 / R4 and the drift of the INTERPOL share against the frozen baseline."""
    t = K.RULE_THRESHOLDS
    pi = safe_div(F.col("n_interpol"), F.col("n_motives"))
    ps = safe_div(F.col("n_sdi"), F.col("n_motives"))
    w = windows.select("window_start", "window_end", key,
                       "n_alarms", "tot", pi.alias("pct_interpol_window"), ps.alias("pct_sdi_window"))
    f = frozen.select(key, F.col("pct_interpol").alias("pct_interpol_baseline"))
    out = w.join(f, on=key, how="left")
    return out.select("*",
                      (F.col("pct_interpol_window") >= t["high_interpol_pct"]).cast("int").alias("br_high_interpol"),
                      ((F.col("pct_interpol_window") >= t["multi_source_pct"])
                       & (F.col("pct_sdi_window") >= t["multi_source_pct"])).cast("int").alias("br_multi_source"),
                      (F.col("pct_interpol_window") - F.coalesce("pct_interpol_baseline", F.lit(0.0)))
                      .alias("interpol_drift"))
