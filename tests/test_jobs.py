"""The job from sources to published tables."""

import pytest
from pyspark.sql import functions as F

from waymark.plans import adapters as A
from waymark.plans import catalogue, jobs
from waymark.sources import io


def test_build(spark, sf, tmp_path):
    root = str(tmp_path)
    programs, layer = catalogue.institution_tables(spark, sf)
    silver = {
        "observations": catalogue.located_observations(spark, sf), "history": A.mapping(spark, sf), "enrolment": catalogue.enrolment(spark, sf), "codes": catalogue.codes(spark, sf), "polygons": layer,
        "programs": programs.withColumns({"program_level": F.lit("BS"), "more": F.lit(1)}),
    }
    assert jobs.build(spark, root, "silver", silver) == []
    written = io.read_published(spark, f"{root}/silver/programs.parquet")
    assert "more" not in written.columns and written.where("sector is not null").count() == 0
    assert jobs.build(spark, root, "gold") == ["public", "institutions"]  # the private one's tables aren't there
    want = catalogue.QUERIES["pipeline_multi_source"](spark, sf)
    got = io.read_published(spark, f"{root}/gold/public")
    assert got.count() == want.count() and {r[0] for r in got.select("site_id").collect()} == {r[0] for r in want.select("site_id").collect()}
    changes = {(r["metric"], r["key"]): r["value"] for r in spark.read.json(f"{root}/gold/public-changes").collect()}
    wanted = {r["source"]: r for r in catalogue.QUERIES["pipeline_changes"](spark, sf).collect()}
    assert all(changes[m, s] == r[m] for s, r in wanted.items() for m in ("rows", "remapped", "merged", "removed", "promoted")) and any(m == "apart" for m, _ in changes)
    values = {(r["metric"], r["key"]): r["value"] for r in spark.read.json(f"{root}/gold/institutions-metrics").collect()}
    assert values["program_level", "BS"] == values["program_rows", "total"] == programs.count() and values["rows", "total"] == io.read_published(spark, f"{root}/gold/institutions").count()
    with pytest.raises(ValueError):
        jobs.build(spark, root, "bronze")
