from pyspark.sql import functions as F

from waymark.functions import cleaning as C


def values(spark, rows, schema, **exprs):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*[e.alias(n) for n, e in exprs.items()]).collect()]


def test_normalize_id(spark):
    cases = {None: None, "123.0": "123", "  123456  ": "123456", "789.00": "789.00", "1.01": "1.01", "10.01": "10.01", "1001.0": "1001", " ": None}
    out = values(spark, [(k,) for k in cases], "x string", a=C.normalize_id("x"))
    assert [r[0] for r in out] == list(cases.values())


def test_normalize_id_padded(spark):
    out = values(spark, [("12345",), ("ABC12",), ("123456.0",), ("1234567",)], "x string", a=C.normalize_id("x", 6))
    assert [r[0] for r in out] == ["012345", "ABC12", "123456", "1234567"]


def test_to_double(spark):
    out = values(spark, [("14.5",), ("abc",), ("14.5d",), ("nan",), (None,), (" 7 ",)], "x string", a=C.to_double("x"))
    assert [r[0] for r in out] == [14.5, None, None, None, None, 7.0]


def test_swap_and_bounds(spark):
    df = spark.createDataFrame([(124.94, 11.0), (14.5, 121.0), (50.0, 60.0), (None, None)], "latitude double, longitude double")
    out = [tuple(r) for r in C.fix_swapped(df).collect()]
    assert out == [(11.0, 124.94, True), (14.5, 121.0, False), (50.0, 60.0, False), (None, None, False)]
    kept = [tuple(r) for r in C.reject_out_of_bounds(df).collect()]
    assert kept == [(None, None), (14.5, 121.0), (None, None), (None, None)]


def test_valid_coords(spark):
    rows = [(14.5, 121.0), (None, 121.0), (float("nan"), 1.0), (float("inf"), 1.0)]
    assert [r[0] for r in values(spark, rows, "a double, b double", x=C.has_valid_coords("a", "b"))] == [True, False, False, False]


def test_names(spark):
    rows = [("o'neil ana-b",), ("SAN  JOSE ,x",), (" car ",), ("region iv-a",), (None,)]
    out = values(spark, rows, "x string", t=C.py_title("x"), p=C.normalize_location("x"))
    assert out[0] == ("O'Neil Ana-B", "O'Neil Ana-B") and out[1][1] == "San Jose, X" and out[2][1] == "CAR" and out[3][1] == "Region iv-a" and out[4] == (None, None)


def test_mojibake(spark):
    out = values(spark, [("PeÃ±a",), ("plain",), ("nan",), ("Peña",)], "x string", a=C.fix_mojibake("x"))
    assert [r[0] for r in out] == ["Peña", "plain", None, "Pe�a"]


def test_centroids(spark):
    rows = [("Point", "[1, 2]"), ("Polygon", "[[[0,0],[4,0],[4,4],[0,0]]]"), ("MultiPolygon", "[[[[0,0],[2,0],[0,0]]],[[[4,4],[4,4]]]]"), ("LineString", "[[0,0],[2,4]]"), ("Other", "[1]"), (None, None)]
    out = [r[0] for r in values(spark, rows, "k string, c string", a=C.vertex_centroid("k", "c"))]
    assert [tuple(x) if x else None for x in out] == [(1.0, 2.0), (2.0, 1.0), ((2 / 3 + 4) / 2, 2.0), (1.0, 2.0), None, None]


def test_decimal_places(spark):
    assert [r[0] for r in values(spark, [(14.0,), (14.5,), (14.12345,), (None,)], "x double", a=C.decimal_places("x"))] == [0, 1, 5, None]


def test_flags_and_lists(spark):
    df = spark.createDataFrame([("True", "3", "0"), ("True", "", "nan"), ("False", "3", "1")], "offers_shs string, g11_abm_male string, g12_stem_female string")
    assert [r[0] for r in C.strand_offerings(df).select("shs_strand_offerings").collect()] == ["ABM", None, None]
    out = values(spark, [("a;b; ;c",), (";",)], "x string", x=F.col("x"))
    assert len(out) == 2
    assert [r[0] for r in C.explode_ids(spark.createDataFrame([("a;b; ;c",), (";",)], "x string"), "x").collect()] == ["a", "b", "c"]


def test_similarity_is_of_the_order_given(spark):
    rows = [("San Jose ES", "san jose es "), ("", "x"), ("abcd", "bcde")]
    out = [round(r[0], 4) for r in values(spark, rows, "a string, b string", s=C.name_similarity("a", "b"))]
    assert out == [1.0, 0.0, 0.75]
