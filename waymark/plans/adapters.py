"""Sites, observations of five sources, polygons and histories derived from the driver's tables. The texts run in Spark and DuckDB alike."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SITE = """
SELECT c_custkey AS _ord, CAST(100000 + c_custkey AS STRING) AS site_id,
  CONCAT('Barrio ', CAST(c_custkey % 40 AS STRING), CASE WHEN c_custkey % 2 = 0 THEN ' Elementary School' ELSE ' ES' END) AS site_name,
  CASE WHEN c_custkey % 3 = 0 THEN 'public' WHEN c_custkey % 3 = 1 THEN 'private' ELSE 'PSO' END AS sector,
  c_nationkey AS unit_key, CONCAT(CAST(1000000 + c_nationkey * 100 + 1 AS STRING), '000') AS claimed_adm3_10,
  CAST(118 AS DOUBLE) + CAST(c_nationkey % 5 AS DOUBLE) + CAST((c_custkey * 7919) % 100000 AS DOUBLE) / CAST(100000 AS DOUBLE) AS lon0,
  CAST(6 AS DOUBLE) + CAST(2 AS DOUBLE) * (CAST(c_nationkey - c_nationkey % 5 AS DOUBLE) / CAST(5 AS DOUBLE)) + CAST((c_custkey * 104729) % 200000 AS DOUBLE) / CAST(100000 AS DOUBLE) AS lat0
FROM {customer}"""

OBS = """
SELECT s._ord, p.priority, p.source,
  CASE WHEN p.priority = 2 AND s._ord % 40 = 5 THEN CONCAT('1', s.site_id) WHEN p.priority = 2 AND s._ord % 33 = 2 THEN CAST(900000 + s._ord AS STRING) ELSE s.site_id END AS site_id,
  CASE WHEN s._ord % 29 = 0 AND p.priority > 2 THEN NULL ELSE s.site_name END AS site_name,
  CASE WHEN p.priority = 5 AND s._ord % 9 = 0 THEN s.lon0 WHEN p.priority = 3 AND s._ord % 50 = 1 THEN CAST(0 AS DOUBLE)
    WHEN s._ord % 97 = 0 THEN CAST(6 AS DOUBLE) + CAST(s._ord % 10 AS DOUBLE) / CAST(10 AS DOUBLE)
    WHEN p.priority = 3 AND s._ord % 61 = 3 THEN CAST(14.57929 AS DOUBLE)
    ELSE s.lat0 + CAST(p.priority - 1 AS DOUBLE) / CAST(4000 AS DOUBLE) END AS latitude,
  CASE WHEN p.priority = 5 AND s._ord % 9 = 0 THEN s.lat0 WHEN p.priority = 3 AND s._ord % 50 = 1 THEN CAST(0 AS DOUBLE)
    WHEN s._ord % 97 = 0 THEN CAST(120 AS DOUBLE) + CAST(s._ord % 10 AS DOUBLE) / CAST(10 AS DOUBLE)
    WHEN p.priority = 3 AND s._ord % 61 = 3 THEN CAST(121.06494 AS DOUBLE)
    WHEN p.priority <= 2 AND s._ord % 25 = 4 THEN s.lon0 + CAST(1.5 AS DOUBLE) ELSE s.lon0 END AS longitude
FROM {site} s CROSS JOIN (SELECT 1 AS priority, 'monitoring_validated' AS source UNION ALL SELECT 2, 'osmapaaralan' UNION ALL SELECT 3, 'nsbi_2324'
  UNION ALL SELECT 4, 'geolocation_deped' UNION ALL SELECT 5, 'drrms_imrs') p
WHERE (p.priority = 1 AND s._ord % 6 = 0) OR (p.priority = 2 AND s._ord % 10 < 8) OR (p.priority = 3 AND s._ord % 20 <> 7)
  OR (p.priority = 4 AND s._ord % 20 <> 3) OR (p.priority = 5 AND s._ord % 3 = 0)"""

POLY = """
SELECT n_nationkey * 2 + t.tri AS polygon_ord, CAST(1000000 + n_nationkey * 100 + 1 AS STRING) AS adm3,
  CONCAT(CAST(1000000 + n_nationkey * 100 + 1 AS STRING), CASE WHEN t.tri = 0 THEN '001' ELSE '002' END) AS adm4,
  CAST(118 + n_nationkey % 5 AS DOUBLE) AS x0, CAST(119 + n_nationkey % 5 AS DOUBLE) AS x1,
  CAST(6 AS DOUBLE) + CAST(2 AS DOUBLE) * (CAST(n_nationkey - n_nationkey % 5 AS DOUBLE) / CAST(5 AS DOUBLE)) AS y0, t.tri
FROM {nation} CROSS JOIN (SELECT 0 AS tri UNION ALL SELECT 1) t WHERE n_nationkey <> 24"""

MAPPING = """
SELECT c_custkey AS _ord, CASE WHEN c_custkey % 40 = 5 THEN CONCAT('1', CAST(100000 + c_custkey AS STRING)) ELSE CAST(100000 + c_custkey AS STRING) END AS canonical_id,
  CASE WHEN c_custkey % 33 = 2 THEN CAST(900000 + c_custkey AS STRING) END AS sy_2008,
  CASE WHEN c_custkey % 33 = 2 THEN CAST(900000 + c_custkey AS STRING) WHEN c_custkey % 7 = 3 THEN CAST(800000 + c_custkey AS STRING) ELSE CAST(100000 + c_custkey AS STRING) END AS sy_2012,
  CASE WHEN c_custkey % 11 = 4 THEN CAST(99999 + c_custkey AS STRING) ELSE CONCAT(CAST(100000 + c_custkey AS STRING), '.0') END AS sy_2020,
  CASE WHEN c_custkey % 13 = 1 THEN CONCAT(' ', CAST(700000 + c_custkey AS STRING), ' ') END AS old_school_id,
  CASE WHEN c_custkey % 17 = 5 THEN CAST(600000 + c_custkey AS STRING) ELSE '' END AS legacy_id
FROM {customer}"""

#: Sites with places, coordinates, status and enrolment, as published.
PUBLISHED = """
SELECT s._ord, s.site_id, s.site_name, CASE WHEN s.sector = 'PSO' THEN 'private' ELSE s.sector END AS sector,
  TRIM(r.r_name) AS region, TRIM(n.n_name) AS province, CONCAT(TRIM(n.n_name), ' ', CAST(s._ord % 7 AS STRING)) AS municipality,
  CONCAT('Barangay ', CAST(s._ord % 11 AS STRING)) AS barangay,
  CASE WHEN s._ord % 19 = 0 THEN NULL WHEN s._ord % 41 = 0 THEN CAST(14.57929 AS DOUBLE) WHEN s._ord % 43 = 0 THEN CAST(12.5 AS DOUBLE) WHEN s._ord % 47 = 0 THEN CAST(10.12345 AS DOUBLE) ELSE s.lat0 END AS latitude,
  CASE WHEN s._ord % 19 = 0 THEN NULL WHEN s._ord % 41 = 0 THEN CAST(121.06494 AS DOUBLE) WHEN s._ord % 43 = 0 THEN CAST(121.25 AS DOUBLE) WHEN s._ord % 47 = 0 THEN CAST(122.54321 AS DOUBLE) ELSE s.lon0 END AS longitude,
  CASE WHEN s._ord % 19 = 0 THEN 'no_coords' WHEN s._ord % 23 = 0 THEN 'fixed_swap' WHEN s._ord % 29 = 0 THEN 'suspect' ELSE 'valid' END AS coord_status,
  CASE WHEN s._ord % 19 = 0 THEN 'no_coordinate_source' WHEN s._ord % 23 = 0 THEN NULL WHEN s._ord % 58 = 0 THEN 'wrong_municipality' WHEN s._ord % 29 = 0 THEN 'outside_all_polygons' END AS coord_rejection_reason,
  CASE WHEN s._ord % 19 = 0 THEN NULL WHEN s._ord % 2 = 0 THEN 'osmapaaralan' ELSE 'nsbi_2324' END AS coord_source,
  CASE WHEN s._ord % 5 = 0 THEN 'no_enrollment_reported' ELSE 'active' END AS enrollment_status
FROM {site} s JOIN {nation} n ON s.unit_key = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey"""


def ctes(*names: str) -> str:
    """WITH clause of the views named, in DuckDB's terms."""
    views = {"site": SITE, "obs": OBS, "poly": POLY, "mapping": MAPPING, "published": PUBLISHED}
    need = [v for v in views if v in names or v == "site" and {"obs", "published"} & set(names)]
    plain = {t: t for t in ("customer", "nation", "region", "site")}
    return "WITH " + ",\n".join(f"{v} AS ({views[v].format(**plain)})" for v in need)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SITE, customer=table(spark, sf_dir, "customer"))


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(OBS, site=site(spark, sf_dir))


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MAPPING, customer=table(spark, sf_dir, "customer"))


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PUBLISHED, site=site(spark, sf_dir), nation=table(spark, sf_dir, "nation"), region=table(spark, sf_dir, "region"))


def poly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles as rings of a general polygon layer."""
    base = spark.sql(POLY, nation=table(spark, sf_dir, "nation"))
    at = lambda x, y: F.struct(F.col(x).alias("x"), y.alias("y"))
    y0, y1 = F.col("y0"), F.col("y0") + 2
    low = F.array(at("x0", y0), at("x1", y0), at("x1", y1), at("x0", y0))
    high = F.array(at("x0", y0), at("x1", y1), at("x0", y1), at("x0", y0))
    return base.select("polygon_ord", "adm3", "adm4", F.array(F.when(F.col("tri") == 0, low).otherwise(high)).alias("rings"))
