"""Every registered query with SQL against DuckDB on the smallest tables, and the sources, streams and pipelines."""

import json

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from waymark.plans import catalogue, pipelines
from waymark.sources import io

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    """A value as Python has it; whole numbers are integers, as pandas makes integers with nulls floats on one side."""
    x = x.item() if isinstance(x, np.generic) else x
    return None if x is pd.NA or isinstance(x, float) and x != x else int(x) if isinstance(x, float) and x.is_integer() else x


def compare(spark, sf, name, queries, oracles):
    got = queries[name](spark, sf).toPandas()
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(oracles[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    norm = lambda f: sorted(str(tuple(map(plain, r))) for r in f[cols].itertuples(index=False, name=None))
    assert norm(got) == norm(want)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_sql(spark, sf, name):
    compare(spark, sf, name, catalogue.QUERIES, catalogue.ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_rows_only(spark, sf, name):
    out = catalogue.QUERIES[name](spark, sf)
    n = out.count()
    assert n > 0
    if "site_id" in out.columns:
        assert out.select("site_id").distinct().count() == n


def test_pipeline_invariants(spark, sf):
    rows = catalogue.QUERIES["pipeline_multi_source"](spark, sf).collect()
    for r in rows:
        assert (r["coord_status"] == "suspect") <= (r["coord_rejection_reason"] != "-")
        assert r["coord_fallback_from"] == "-" or r["coord_fallback_from"] != r["coord_source"]
        assert (r["latitude"] == -1) == (r["coord_status"] == "no_coords")


def test_institutions(spark):
    polys = spark.createDataFrame([(1, "P1", "Name", "U", "a", [[(116.5, 5.0), (126.0, 5.0), (126.0, 20.0), (116.5, 20.0)]])], "polygon_ord int, adm2 string, adm2_name string, adm3 string, adm4 string, rings array<array<struct<x:double,y:double>>>")
    rows = [(1, "c", "N", "Region 01", "COTABATO", "X Municipality", 10.0, 120.0), (2, "c", "N", "Region 01", "COTABATO", "X", 10.0, 120.0), (3, "c", "M", "Region 02", None, "Y", 121.0, 11.0), (4, None, "O", "?", None, "Z", 50.0, 60.0)]
    df = spark.createDataFrame(rows, "_ord long, code string, name string, region string, province string, city_municipality string, latitude double, longitude double")
    out = {r["name"]: r for r in pipelines.institutions(df, polys).collect()}
    assert len(out) == 3 and out["N"]["region"] == "Region I" and out["N"]["province"] == "NORTH COTABATO" and out["N"]["is_multi"] and out["N"]["city_municipality"] == "X"
    assert out["M"]["latitude"] == 11.0 and out["M"]["province"] == "Name" and out["O"]["coord_status"] == "out_of_bounds" and out["O"]["observed_adm3"] is None


def test_sources(spark, tmp_path):
    csv = tmp_path / "t.csv"
    csv.write_text("title,,\nby,,\nid,name,name\n1,a,b\n2,c,d\n")
    out = io.read_offset_table(spark, str(csv), 2)
    assert out.columns == ["id", "name", "name.1", "_ord"] and [r["name.1"] for r in out.orderBy("_ord").collect()] == ["b", "d"]
    geo = tmp_path / "t.json"
    feature = lambda ref, kind, c: {"type": "Feature", "properties": {"ref": ref}, "geometry": {"type": kind, "coordinates": c}}
    geo.write_text(json.dumps({"type": "FeatureCollection", "features": [feature("1;2", "Point", [1, 2]), feature(" ", "Point", [0, 0]), feature(None, "Point", [0, 0])]}))
    assert [(r["ref"], r["coordinates"].replace(" ", "")) for r in io.read_geojson(spark, str(geo)).collect()] == [("1;2", "[1,2]")]
    root = str(tmp_path)
    df = spark.createDataFrame([("a", "Public"), ("b", "private")], "site_id string, sector string")
    io.write_silver(df, root, "x")
    assert io.read_silver(spark, root, "x", "public").count() == 1 and io.read_optional(spark, root, "none") is None
    with pytest.raises(FileNotFoundError):
        io.read_silver(spark, root, "none")
    io.write_gold(df, f"{root}/gold", ["site_id", "sector", "more"], ["site_id"])
    assert io.read_published(spark, f"{root}/gold").columns == ["site_id", "sector", "more"]
    described = {r["field"]: r["value"] for r in io.describe_output(df, {"sector": "who runs it"}).collect()}
    assert described == {"rows": "2", "site_id": " (2 rows)", "sector": "who runs it (2 rows)"}
