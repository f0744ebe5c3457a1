"""Feature collections in one split and in many, against the json module."""

import json
import random

import pytest

from waymark.sources import geojson, io


def collection(seed, n=120):
    rng = random.Random(seed)
    odd = ["{", "}", '"', "\\", "[", "]", "é😀", '{"type": "Feature"}', "\\u007b", "plain", "\n", "}}{{[[", '\\"']
    text = lambda: "".join(rng.choice(odd) for _ in range(rng.randint(0, 6)))
    shapes = {"Point": lambda: [rng.random(), 2], "Polygon": lambda: [[[rng.random(), rng.random()] for _ in range(rng.randint(3, 9))]], "MultiPolygon": lambda: [[[[1, 2], [3, 4]]], [[[5, 6]]]]}
    out = []
    for i in range(n):
        kind = rng.choice(list(shapes))
        out.append({"type": "Feature", "id": i, "properties": {"ref": str(i) if i % 7 else " ", "name": text(), text(): text(), "more": {"a": [{"b": text()}]}}, "geometry": {"type": kind, "coordinates": shapes[kind]()} if i % 11 else None})
    return {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x{", "list": [1, {"a": [2]}]}}, "features": out, "tail": {"z": [{"q": 1}]}}


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(("size", "indent"), [(300, None), (1700, 2), (5000, None), (1 << 27, 1)])
def test_features_of_any_splits(spark, tmp_path, small_splits, size, indent):
    made = [collection(k) for k in (size, size + 1)]
    for k, c in enumerate(made):
        (tmp_path / f"{k}.json").write_text(json.dumps(c, indent=indent, ensure_ascii=k == 0))
    small_splits(size)
    got = sorted(json.dumps(json.loads(r[0]), sort_keys=True) for r in geojson.read_features(spark, str(tmp_path)).collect())
    assert got == sorted(json.dumps(f, sort_keys=True) for c in made for f in c["features"])


def test_collection_equals_lines(spark, tmp_path, small_splits):
    c = collection(5)
    (tmp_path / "c.json").write_text(json.dumps(c))
    (tmp_path / "l.json").write_text("\n".join(json.dumps(f) for f in c["features"]))
    small_splits(2000)
    rows = lambda df: sorted((r["ref"], r["kind"] or "", r["coordinates"] or "", sorted(r["properties"].items())) for r in df.collect())
    whole, lines = io.read_geojson(spark, str(tmp_path / "c.json")), io.read_geojson(spark, str(tmp_path / "l.json"), lines=True)
    assert rows(whole) == rows(lines) and whole.count() == sum(i % 7 > 0 for i in range(120))


def test_collections_without_features(spark, tmp_path):
    for k, text in enumerate(['{"type": "FeatureCollection", "features": []}', "", "{}", '{"features": null}']):
        (tmp_path / f"{k}.json").write_text(text)
    assert geojson.read_features(spark, str(tmp_path)).collect() == []
    assert io.read_geojson(spark, str(tmp_path)).collect() == []
