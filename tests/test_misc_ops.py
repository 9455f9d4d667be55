"""Function-level operators without a registered query: sparse drop, schema aliases,
legacy labels, run manifest, route geometry, perimeter validation."""

import pytest
from pyspark.sql import functions as F

from lanewatch.operators import cleaning as CL
from lanewatch.operators import explain as EX
from lanewatch.sources import files as FS


def test_drop_sparse_columns_keeps_contract(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x"), (3, None, None)], "a int, b string, c string")
    out, dropped = CL.drop_sparse_columns(df, 0.5, keep=["c"])
    assert dropped == ["b"] and out.columns == ["a", "c"]


def test_check_schema_aliases(spark):
    df = spark.createDataFrame([("x", 1)], "AEROPORTO_ARRIVO string, TOT int")
    out, missing = CL.check_schema(df, ["AREOPORTO_ARRIVO", "TOT", "ZONA"], {"AEROPORTO_ARRIVO": "AREOPORTO_ARRIVO"})
    assert "AREOPORTO_ARRIVO" in out.columns and missing == ["ZONA"]


def test_legacy_labels(spark):
    df = spark.createDataFrame([(" alta ",), ("CRITICO",), ("HIGH",)], "x string")
    assert [r[0] for r in df.select(CL.legacy_label(F.col("x"))).collect()] == ["HIGH", "CRITICAL", "HIGH"]


def test_perimeter_validation(spark):
    with pytest.raises(ValueError):
        CL.normalise_perimeter({"continent": "EU"})
    assert CL.normalise_perimeter({"aeroporto_arrivo": " fco ", "zona": None}) == {"aeroporto_arrivo": "FCO"}


def test_manifest_roundtrip(spark):
    path = FS.scratch_path(spark, "manifest")
    FS.append_manifest(spark, path, {"anno": 2024, "zona": None}, {"rows": 10}, {"risk": "/x"})
    assert FS.last_perimeter(spark, path) == {"anno": 2024}


def test_route_geometry_drops_unmapped(spark):
    df = spark.createDataFrame([("AAA-BBB", "HIGH", 0.9, "text"), ("AAA-ZZZ", "LOW", 0.1, "t")],
                               "ROTTA string, final_risk string, ensemble_score double, explanation string")
    coords = spark.createDataFrame([("AAA", 1.0, 2.0), ("BBB", 3.0, 4.0)], "code string, lat double, lon double")
    out = EX.route_geometry(df, coords).collect()
    assert len(out) == 1 and out[0]["arr_lat"] == 3.0
