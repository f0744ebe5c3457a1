"""CSV exports with titles, in one split and in many, against the csv module."""

import csv
import io as text_io
import random

import pytest

from waymark.sources import io


def export(path, rows):
    out = text_io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    path.write_text(out.getvalue())
    return str(path)


def test_titles_of_any_width_and_blank_rows(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('List of schools\n\nas of 2024\nid,name,x\n1,"a,b",\n2,"line\nbreak ""q""",3\n\n4\n')
    out = io.read_offset_table(spark, str(path), 3)
    assert out.columns == ["id", "name", "x", "_ord"]
    assert sorted(map(tuple, out.collect()), key=lambda r: r[3]) == [("1", "a,b", None, 4), ("2", 'line\nbreak "q"', "3", 5), (None, None, None, 6), ("4", None, None, 7)]


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("size", [900, 4001, 1 << 27])
def test_splits_give_the_rows_of_one_reader(spark, tmp_path, small_splits, size):
    rng = random.Random(size)
    cells = ["plain", "a,b", 'q"q', '"', '""', "two\nlines", 'a\n\n"x",\nb', "", " ", "é" * 30, "\n"]
    rows = [["Title, with comma"], [], ["x", "y\nz", "", "", ""], ["id", "note", "note", "last"], *[[str(i), rng.choice(cells), rng.choice(cells), rng.choice(["", "z"])] for i in range(800)]]
    path = export(tmp_path / "b.csv", rows)
    small_splits(size)
    out = io.read_offset_table(spark, path, 3)
    assert out.columns == ["id", "note", "note.1", "last", "_ord"]
    want = [tuple(c if c.strip() else None for c in r) + (i,) for i, r in enumerate(rows) if i > 3]
    assert sorted(map(tuple, out.collect()), key=lambda r: r[-1]) == want
    assert size > 10_000 or io._numbered_lines(spark, path).select("start").distinct().count() > 4


def test_several_files_have_titles_of_their_own(spark, tmp_path):
    for k in range(3):
        export(tmp_path / f"{k}.csv", [["t"] * k, ["id", "v"], [f"{k}", "x"]])
    out = io.read_offset_table(spark, str(tmp_path), 1)
    assert sorted(map(tuple, out.collect())) == [("0", "x", 2), ("1", "x", 2), ("2", "x", 2)]
    export(tmp_path / "3.csv", [["t"], ["id", "w"], ["3", "y"]])
    with pytest.raises(ValueError, match="differ"):
        io.read_offset_table(spark, str(tmp_path), 1)


def test_what_cannot_be_read_raises(spark, tmp_path):
    with pytest.raises(ValueError, match="no row 5"):
        io.read_offset_table(spark, export(tmp_path / "a.csv", [["id"], ["1"]]), 5)
    (tmp_path / "b.csv").write_text('id\n"1\n2\n')
    with pytest.raises(ValueError, match="without its pair"):
        io.read_offset_table(spark, str(tmp_path / "b.csv"), 0)
    wide = io.read_offset_table(spark, export(tmp_path / "c.csv", [["id", "v"], ["1", "2", "3"]]), 0)
    with pytest.raises(Exception, match="row 1 has 3 cells, the header 2"):
        wide.collect()
    (tmp_path / "d.csv").write_text("")
    with pytest.raises(ValueError, match="no row 0"):
        io.read_offset_table(spark, str(tmp_path / "d.csv"), 0)
    assert io.read_offset_table(spark, export(tmp_path / "e.csv", [["id", "v"], ["1", "2", "", " "]]), 0).collect() == [("1", "2", 1)]


def test_byte_order_mark_and_windows_line_ends(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_bytes(b"\xef\xbb\xbfid,v\r\n1,x\r\n")
    assert io.read_offset_table(spark, str(path), 0).collect() == [("1", "x", 1)]
    assert io.read_offset_table(spark, str(path), 0).columns == ["id", "v", "_ord"]


def test_metrics_document(spark):
    table = spark.createDataFrame([("b", "x", 2), ("a", "y", 1), ("b", "w", 3)], "metric string, key string, value long")
    assert io.metrics_document(table) == '{\n  "a": {\n    "y": 1\n  },\n  "b": {\n    "w": 3,\n    "x": 2\n  }\n}'
