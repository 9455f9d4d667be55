"""No record is lost, whatever the number and the order of the streamed files."""

import os

import pytest
from pyspark.sql import functions as F

from lanewatch.streaming import windows as SW
from tests.conftest import SMALL


@pytest.mark.parametrize("files", [0, 1, 4])
def test_all_alarms_reach_a_window(spark, tmp_path, files):
    where = SMALL
    if files:      # the table as a directory of part files
        where = str(tmp_path)
        for name in os.listdir(SMALL):
            if name != "lineitem.parquet":
                os.symlink(f"{SMALL}/{name}", f"{where}/{name}")
        spark.read.parquet(f"{SMALL}/lineitem.parquet").repartition(files).write.parquet(f"{where}/lineitem.parquet")
    alarms = spark.read.parquet(f"{SMALL}/lineitem.parquet").filter("l_returnflag = 'R'")
    progress = []
    got = SW.run_window_job(spark, where, compact=2, progress=progress)
    assert len(progress) >= max(1, files) and not any(p["stateOperators"] for p in progress)      # no state, so none grows
    assert got.count() == got.select("window_start", "ROTTA").distinct().count()
    n, total = got.agg(F.sum("n_alarms"), F.sum("tot")).first()
    assert n == alarms.count() and float(total) == pytest.approx(float(alarms.agg(F.sum("l_quantity")).first()[0]))


def test_late_records_correct_closed_windows(spark, tmp_path):
    """The newest records come first, so all others are late: marked, counted and part of their windows."""
    import time
    where = str(tmp_path)
    for name in os.listdir(SMALL):
        if name != "lineitem.parquet":
            os.symlink(f"{SMALL}/{name}", f"{where}/{name}")
    rows = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    middle = rows.filter("l_returnflag = 'R'").agg(F.expr("date_add(DATE'1970-01-01', int(percentile(datediff(l_shipdate, DATE'1970-01-01'), 0.5)))")).first()[0]
    for part in (rows.filter(F.col("l_shipdate") >= middle), rows.filter(F.col("l_shipdate") < middle)):
        part.coalesce(1).write.mode("append").parquet(f"{where}/lineitem.parquet")
        time.sleep(1.2)                        # files are read in order of their times
    got = SW.run_window_job(spark, where, delay="60 days")
    whole = SW.run_window_job(spark, SMALL, delay="60 days")
    assert sorted(map(tuple, got.drop("corrections").collect())) == sorted(map(tuple, whole.drop("corrections").collect()))
    late = rows.filter((F.col("l_returnflag") == "R") & (F.col("l_shipdate") < middle)).count()
    assert 0 < got.agg(F.sum("corrections")).first()[0] <= late
    assert whole.agg(F.sum("corrections")).first()[0] == 0


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    import datetime as dt
    sink = SW.PartsSink(spark, str(tmp_path / "out"), "30 days", "30 days", compact=3)
    def batch(day):
        return spark.createDataFrame([(dt.datetime(2024, 1, day), "A-B", 2.0, "SDI")], "ts timestamp, ROTTA string, TOT double, MOTIVO_ALLARME string")
    for number, day in [(0, 3), (1, 4), (1, 4), (2, 5), (2, 5), (3, 6)]:
        sink(batch(day), number)
    again = SW.PartsSink(spark, str(tmp_path / "out"), "30 days", "30 days", compact=3)
    again(batch(7), 4)
    assert [r.n_alarms for r in SW.summed(again.parts()).collect()] == [5]
    assert again._folders() == ["upto=2", "batch=3", "batch=4"]
