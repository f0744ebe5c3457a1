"""Registered queries for sources, sinks and streams: the driver's tables written in the formats that the readers take, and read again."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark import schema as S
from waymark.functions import cleaning as C
from waymark.operators import search
from waymark.plans import adapters as A
from waymark.plans.catalogue import register
from waymark.sources import io
from waymark.streaming import reports


def export_sheets(df: DataFrame, name: str, titles: list[str]) -> str:
    """df as CSV files, one a partition, each with the titles (lines as they are) and a header row above its rows; their path."""
    path, head = io.shared_path(df.sparkSession, name), ",".join(f'"{c}"' for c in df.columns)
    lines = df.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"escape": '"', "quoteAll": "true"}).alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [*titles, head]})
        yield from batches

    lines.mapInArrow(run, "value string").write.text(path)
    return path


@register("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || CASE c_custkey % 3 WHEN 0 THEN ', "' || c_mktsegment || '"' WHEN 1 THEN chr(10) || chr(10) || c_mktsegment ELSE '' END AS full_name,
  CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS note, true AS numbered FROM customer""")
def source_offset_table(spark, d):
    """Titles of several widths, a blank row and a quoted line break above the header; cells with commas, quotes and line breaks below."""
    name = F.concat(F.col("c_name"), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(', "'), "c_mktsegment", F.lit('"'))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("\n\n"), "c_mktsegment")).otherwise(""))
    rows = A.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), name.alias("full\nname"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("note"))
    path = export_sheets(rows, "offset", ["List of customers", "", '"as of,\n2024",,,,', "a,b"])
    out = io.read_offset_table(spark, path, 4)
    return out.select("id", F.col("`full\nname`").alias("full_name"), "note", (F.col("_ord") > 4).alias("numbered"))


@register("""SELECT CAST(s_suppkey AS VARCHAR) AS site_id, s_name AS name, s_acctbal AS latitude, 'Class ' || s_suppkey % 3 AS income_class, 0 AS sheet FROM supplier
UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name, p_retailprice, NULL, 1 FROM part""")
def source_stacked_sheets(spark, d):
    """Two sheets with headers of their own, columns by position; a column is found by a part of its header in the one, and is missing in the other."""
    s = A.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("LIS ID"), F.col("s_name").alias("Name"), F.col("s_acctbal").cast("string").alias("Lat"), F.lit("x").alias("x"), F.lit("other").alias("INCOME.1"), F.concat(F.lit("Class "), (F.col("s_suppkey") % 3).cast("string")).alias("INCOME\nCLASS"))
    p = A.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("part"), F.col("p_retailprice").cast("string").alias("price"))
    sheets = [io.read_offset_table(spark, export_sheets(df, "sheet", ["Title"]), 1) for df in (s, p)]
    sheets = [io.resolve_column(x, lambda c: "INCOME" in c and ".1" not in c, "income_class") for x in sheets]
    places = [[x.columns.index(c) for c in ("income_class",)][0] for x in sheets]
    sheets = [x.select(*x.columns[:3], x.columns[i]) for x, i in zip(sheets, places, strict=True)]
    out = io.stack_by_position(sheets, {0: "site_id", 1: "name", 2: "latitude", 3: "income_class"})
    return out.select("site_id", "name", C.to_double("latitude").alias("latitude"), "income_class", F.col("_sheet").alias("sheet"))


@register("SELECT p_partkey, p_name, p_retailprice, CASE WHEN p_partkey % 4 = 0 THEN p_brand || ', \"' || p_type || '\"' ELSE p_brand END AS label FROM part")
def source_csv_round_trip(spark, d):
    """Written as gold CSV, read as strings."""
    label = F.when(F.col("p_partkey") % 4 == 0, F.concat("p_brand", F.lit(', "'), "p_type", F.lit('"'))).otherwise(F.col("p_brand"))
    path = io.shared_path(spark, "gold-csv")
    io.write_gold_csv(A.table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice", label.alias("label")), path)
    read = io.read_csv_strings(spark, path)
    assert {t for _, t in read.dtypes} == {"string"}
    return read.select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", F.col("p_retailprice").cast("double").alias("p_retailprice"), "label")


@register("SELECT site_id, site_name || ' \"{[\\' AS name, round(lon0, 6) AS x, round(lat0, 6) AS y FROM site", "site")
def source_geojson(spark, d):
    """The sites as feature collections, one a partition, each on a single line; names hold braces and quotes."""
    path, at = io.shared_path(spark, "features"), F.array("lon0", "lat0")
    name = F.concat("site_name", F.lit(' "{[\\'))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("site_id").alias("ref"), name.alias("name")).alias("properties"), F.struct(F.lit("Point").alias("type"), at.alias("coordinates")).alias("geometry"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = '{"type": "FeatureCollection", "crs": {"type": "name"}, "features": ['
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"value": [lead + batch.column(0)[0].as_py(), *["," + x for x in batch.column(0).to_pylist()[1:]]]})
            lead = ","
        yield pa.RecordBatch.from_pydict({"value": ["]}" if lead == "," else lead + "]}"]})

    A.site(spark, d).select(F.to_json(feature).alias("value")).mapInArrow(run, "value string").write.option("lineSep", " ").text(path)
    out = io.read_geojson(spark, path)
    c = C.vertex_centroid("kind", "coordinates")
    return out.select(F.col("ref").alias("site_id"), F.col("properties")["name"].alias("name"), F.round(c["x"], 6).alias("x"), F.round(c["y"], 6).alias("y"))


@register("SELECT polygon_ord, adm3, adm4, 4 AS corners FROM poly", "poly")
def source_polygon_layer(spark, d):
    """A layer whose codes have the country's prefix."""
    path = io.shared_path(spark, "layer")
    A.poly(spark, d).withColumns({c: F.concat(F.lit("PH"), c) for c in ("adm3", "adm4")}).write.parquet(path)
    return io.read_polygons(spark, path).select(F.col("polygon_ord").cast("long").alias("polygon_ord"), "adm3", "adm4", F.size(F.col("rings")[0]).alias("corners"))


@register("SELECT site_id, coord_status FROM published WHERE coord_status IN ('valid', 'fixed_swap')", "published")
def reliable_sites(spark, d):
    return C.reliable(A.published(spark, d)).select("site_id", "coord_status")


@register("SELECT o_custkey, o_orderkey, o_orderdate, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def stream_earliest_reports(spark, d):
    """The orders as reports in three deliveries, each taken up by a run of the stream; later ones bring earlier orders."""
    rows = A.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", F.col("o_totalprice").cast("double").alias("o_totalprice"))
    sent, log, state = (io.shared_path(spark, f"reports-{k}") for k in ("in", "log", "state"))
    settings = reports.STATE_STORE | reports.few_partitions(spark)
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for k in range(3):
            rows.where(F.col("o_orderkey") % 3 == 2 - k).write.mode("append").parquet(sent)
            reports.earliest_report_log(reports.report_stream(spark, sent, rows.schema), "o_custkey", ["o_orderdate", "o_orderkey"], log, state).awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return reports.read_earliest(spark, log, "o_custkey", ["o_orderdate", "o_orderkey"]).select(*rows.columns)


@register("SELECT o_orderkey, o_custkey, p // 500 AS page FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS p FROM orders) WHERE p // 500 IN (1, (SELECT count(*) - 1 FROM orders) // 500)")
def pages_by_marks(spark, d):
    """The second and the last page of the orders, published in order: pages are the feature."""
    path = io.shared_path(spark, "published")
    rows = A.table(spark, d, "orders")
    io.write_gold(rows, path, ["o_orderkey", "o_custkey"], ["o_orderkey"], find=["o_custkey"])
    table = io.read_published(spark, path)
    marks = io.silver(search.page_marks(table, 500, "o_orderkey"), "marks")
    last = marks.agg(F.max("page")).first()[0]
    first, end = (search.seek_page(table, marks, k, "o_orderkey").withColumn("page", F.lit(k).cast("long")) for k in (1, last))
    return first.unionByName(end).select("o_orderkey", "o_custkey", "page")


@register("SELECT site_id, CASE WHEN site_id = 'o 12 E' THEN 0 WHEN starts_with(lower(site_name), 'o 12 e') THEN 1 ELSE 2 END AS score FROM published WHERE site_id = 'o 12 E' OR contains(lower(site_name), 'o 12 e')", "published")
def search_indexed(spark, d):
    """Ranked search by a published index of three characters."""
    p, path = A.published(spark, d), io.shared_path(spark, "grams")
    io.write_gold(search.name_grams(p), path, ["gram", "site_id"], ["gram", "site_id"])
    return search.search_by_grams(p, io.read_published(spark, path), "o 12 E").select("site_id", "score")
