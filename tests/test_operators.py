import random

from pyspark.sql import functions as F

from waymark.operators import audit, cascade, crosswalk, dedup, enrich, metrics, quality, search, spatial


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def xw(spark, pairs):
    return spark.createDataFrame([(h, c, i) for i, (h, c) in enumerate(pairs)], "historical_id string, canonical_id string, _ord long")


def test_identity_first(spark):
    for pairs in ([("101701", "500376"), ("101701", "101701")], [("101701", "101701"), ("101701", "500376")]):
        assert rows(dedup.identity_first(xw(spark, pairs)), "historical_id", "canonical_id") == [("101701", "101701")]
    assert rows(dedup.identity_first(xw(spark, [("A", "X"), ("A", "Y")])), "canonical_id") == [("X",)]


def test_remap_and_consolidate(spark):
    look = xw(spark, [("101701", "500376"), ("101701", "101701"), ("500376", "500376"), ("OLD123", "NEW456")])
    df = spark.createDataFrame([("101701",), ("500376",), ("OLD123",), ("other",)], "site_id string")
    assert rows(crosswalk.remap(df, look)) == [("101701", False), ("500376", False), ("NEW456", True), ("other", False)]
    both = spark.createDataFrame([(1, "A", None, None, "n"), (2, "A", 1.0, 2.0, None), (3, "B", None, None, ""), (4, "B", None, None, "name")], "_ord long, site_id string, latitude double, longitude double, site_name string")
    assert rows(dedup.consolidate(both), "_ord") == [(2,), (4,)]


def test_history(spark):
    m = spark.createDataFrame([(1, "1100005", None, "900005", None), (2, "100006.0", "100006", "800006", " 700006 ")], "_ord long, canonical_id string, sy_2005 string, sy_2010 string, old_school_id string")
    out = crosswalk.official_layer(m, spark.createDataFrame([("100005",)], "site_id string"))
    assert out.count() == 6
    found = {(r["historical_id"], r["canonical_id"]): (r["year_first_seen"], r["year_last_seen"]) for r in out.collect()}
    assert found[("1100005", "100005")] == (2024, 2024) and found[("900005", "100005")] == (2010, 2010) and found[("700006", "100006")] == (None, None)


def test_near_pairs_equal_brute_force(spark):
    random.seed(1)
    pts = lambda p: [(f"{p}{i}", 21.4 + random.random() / 200, 120 + random.random() / 200, i) for i in range(60)]
    schema = "site_id string, latitude double, longitude double, _ord long"
    a, b = spark.createDataFrame(pts("a"), schema), spark.createDataFrame(pts("b"), schema)
    got = crosswalk.near_pairs(a, b)
    assert "NestedLoop" not in got._jdf.queryExecution().toString() and "Cartesian" not in got._jdf.queryExecution().toString()
    from waymark.functions.geo import haversine_km

    x, y = a.alias("x"), b.alias("y")
    want = x.crossJoin(y).where(haversine_km(F.col("x.latitude"), F.col("x.longitude"), F.col("y.latitude"), F.col("y.longitude")) <= 0.1).select("x.site_id", "y.site_id")
    assert rows(got, "l_site_id", "r_site_id") == rows(want) != []


def test_polygons(spark):
    ring = lambda *p: [(float(x), float(y)) for x, y in p]
    square, hole = ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), ring((1, 1), (2, 1), (2, 2), (1, 2), (1, 1))
    polys = spark.createDataFrame([(1, "U1", "a", [square, hole]), (2, "U2", "b", [ring((3, 3), (6, 3), (6, 6), (3, 6))])], "polygon_ord int, adm3 string, adm4 string, rings array<array<struct<x:double,y:double>>>")
    pts = [("in", 0.5, 0.5, "U1"), ("hole", 1.5, 1.5, "U1"), ("corner", 0.0, 0.0, "U1"), ("edge", 4.0, 1.0, "U1"), ("both", 3.5, 3.5, "U2"), ("both1", 3.5, 3.5, None), ("far", 9.0, 9.0, "U1"), ("near", 4.001, 1.0, "U1"), ("null", None, 1.0, "U1")]
    df = spark.createDataFrame(pts, "site_id string, longitude double, latitude double, claimed_adm3 string")
    out = {r["site_id"]: r["observed_adm3"] for r in spatial.point_in_polygon(df, polys).collect()}
    assert out == {"in": "U1", "hole": None, "corner": None, "edge": None, "both": "U2", "both1": "U1", "far": None, "near": None, "null": None}
    assert {r[0] for r in rows(spatial.within_buffer(df, polys))} == {"in", "corner", "edge", "both", "near"}


def test_suspect(spark):
    df = spark.createDataFrame(
        [("p", 14.57929, 121.06494, "m"), ("r", 14.0, 121.0, "m"), ("c1", 14.5793, 121.2, "a"), ("c2", 14.5793, 121.2, "b"), ("c3", 14.5793, 121.2, "c"), ("s1", 15.5793, 121.2001, "a"), ("s2", 15.5793, 121.2001, "a"), ("s3", 15.5793, 121.2001, "A "), ("ok", 14.12345, 121.6789, "m")],
        "site_id string, latitude double, longitude double, municipality string",
    ).withColumns({"coord_status": F.lit("valid"), "coord_rejection_reason": F.lit(None).cast("string")})
    out = {r["site_id"]: r["coord_rejection_reason"] for r in quality.detect_suspect(df).collect()}
    assert out == {"p": "placeholder_default", "r": "round_coordinates", "c1": "coordinate_cluster", "c2": "coordinate_cluster", "c3": "coordinate_cluster", "s1": None, "s2": None, "s3": None, "ok": None}


def test_codes(spark):
    df = spark.createDataFrame([("valid", "1", "1"), ("suspect", "1", "1"), ("no_coords", "1", "1"), ("valid", "1", "2"), ("fixed_swap", "1", "1"), ("valid", "None", "1")], "coord_status string, claimed_code string, observed_code string")
    assert [r["psgc_validation"] for r in quality.validate_codes(df).collect()] == ["match", "no_validation", "no_validation", "mismatch", "match", "no_validation"]
    bare = spark.createDataFrame([(1.0, 2.0, "1", "1"), (None, 2.0, "1", "1")], "latitude double, longitude double, claimed_code string, observed_code string")
    assert [r["psgc_validation"] for r in quality.validate_codes(bare).collect()] == ["match", "no_validation"]
    units = spark.createDataFrame([("1380601000", "1380600"), ("1380601000", "1380602"), ("0102906000", "0102906")], "c string, o string")
    assert [r[0] for r in units.select(quality.same_unit(F.col("c"), F.col("o"))).collect()] == [True, False, True]


def test_cascades(spark):
    long = spark.createDataFrame(
        [("A", "osmapaaralan", 2, 1, 10.0, 120.0, None, None), ("A", "nsbi_2324", 3, 1, 11.0, 121.0, "n", "R1"), ("B", "nsbi_2324", 3, 2, None, None, "b", None), ("B", "drrms_imrs", 5, 2, 12.0, 122.0, "x", "R2")],
        "site_id string, source string, priority int, _ord long, latitude double, longitude double, site_name string, region string",
    )
    u = enrich.universe([long])
    got = {r["site_id"]: (r["latitude"], r["coord_source"], r["sources_available"]) for r in cascade.priority_cascade(u, long).collect()}
    assert got == {"A": (10.0, "osmapaaralan", "osmapaaralan,nsbi_2324"), "B": (12.0, "drrms_imrs", "drrms_imrs")}
    assert rows(cascade.column_cascade(u, long, "site_name")) == [("A", "n"), ("B", "b")]
    assert rows(cascade.group_cascade(u, long, ["region"]), "site_id", "region", "location_source") == [("A", "R1", "nsbi_2324"), ("B", "R2", "drrms_imrs")]


def test_fallback_skips_what_is_outside_too(spark):
    polys = spark.createDataFrame([(1, "U", "a", [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]])], "polygon_ord int, adm3 string, adm4 string, rings array<array<struct<x:double,y:double>>>")
    long = spark.createDataFrame([("A", "osmapaaralan", 2, 9.0, 9.0), ("A", "nsbi_2324", 3, 8.0, 8.0), ("A", "geolocation_deped", 4, 1.0, 1.0)], "site_id string, source string, priority int, latitude double, longitude double")
    df = spark.createDataFrame([("A", "U", "osmapaaralan", "suspect", "wrong_municipality", 9.0, 9.0, None, None)], "site_id string, claimed_adm3 string, coord_source string, coord_status string, coord_rejection_reason string, latitude double, longitude double, observed_adm3 string, observed_adm4 string")
    r = cascade.cascade_fallback(df, long, polys).first()
    assert (r["coord_source"], r["coord_fallback_from"], r["coord_status"], r["coord_rejection_reason"], r["latitude"], r["observed_adm4"]) == ("geolocation_deped", "osmapaaralan", "valid", None, 1.0, "a")


def test_sets_and_membership(spark):
    a = spark.createDataFrame([("1", "x"), ("2", None)], "site_id string, sector string")
    b = spark.createDataFrame([("2",), ("3",)], "site_id string")
    assert rows(enrich.expand_universe(a.select("site_id"), b)) == [("1", False), ("2", False), ("3", True)]
    assert rows(enrich.tag_membership(a, b), "site_id", "enrollment_status") == [("1", "no_enrollment_reported"), ("2", "active")]
    assert rows(enrich.append_aligned(a, b, {"sector": "new"}), "site_id") == [("1",), ("2",), ("2",), ("3",)]
    assert rows(enrich.exclude_sector(spark.createDataFrame([("PSO",), (None,), ("public",)], "sector string")).na.fill("-")) == [("-",), ("public",)]


def test_metrics_diff(spark):
    a = metrics.value_counts(spark.createDataFrame([("x",), (None,), ("x",)], "c string"), ["c"])
    b = metrics.value_counts(spark.createDataFrame([("x",), ("y",)], "c string"), ["c"])
    assert rows(metrics.diff_metrics(a, b), "key", "change") == [("__null__", "REMOVED"), ("x", "CHANGED"), ("y", "ADDED")]
    assert not metrics.has_changed(metrics.diff_metrics(a, a))


def test_search_and_bounds(spark):
    df = spark.createDataFrame([("7", "Alpha", 1), ("Alpha", "none", 2), ("9", "the alpha", 3), ("8", None, 4)], "site_id string, site_name string, _ord int")
    assert [r["site_id"] for r in search.search(df, "Alpha").collect()] == ["Alpha", "7", "9"]
    total, part = search.page(df.orderBy("_ord"), 2, 1)
    assert total == 4 and [r["_ord"] for r in part.collect()] == [2, 3]
    pts = spark.createDataFrame([("R", float(i), float(i)) for i in range(9)] + [("R", 500.0, 3.0), ("S", 1.0, 2.0)], "region string, latitude double, longitude double")
    assert rows(search.robust_bounds(pts)) == [("R", 10, 0.0, 8.0, 0.0, 8.0), ("S", 1, 1.0, 1.0, 2.0, 2.0)]


def test_stratified_cap(spark):
    df = spark.createDataFrame([(i, "public" if i % 4 else "private", 1.0) for i in range(100)], "_ord long, sector string, latitude double")
    got = [r["_ord"] for r in search.stratified_cap(df, 10).orderBy("_ord").collect()]
    pub, priv = [i for i in range(100) if i % 4], [i for i in range(100) if not i % 4]
    want = sorted([pub[int(i * 75 / 8)] for i in range(8)] + [priv[int(i * 25 / 2)] for i in range(2)])
    assert got == want


def test_audit(spark):
    df = spark.createDataFrame([("100", "A ES", "m", "b1"), ("1100", "A Elementary School", "m", "b2"), ("3", "A ES", "m", "b1")], "site_id string, site_name string, municipality string, barangay string").withColumns({"region": F.lit("r"), "province": F.lit("p")})
    assert rows(audit.near_identical_names(df), "n_names", "n") == [(2, 3)]
    assert rows(audit.prefixed_pairs(df), "short_id", "kind") == [("100", "different_name")]
    assert rows(audit.duplicate_names(df, "a"), "n") == [(2,)] and rows(audit.duplicate_names(df, "b")) == []
