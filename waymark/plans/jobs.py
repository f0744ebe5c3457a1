"""The job: sources to silver tables, silver tables to published ones.

    python -m waymark.plans.jobs --root DIR --stage silver|gold|all --sources module:function

The function takes a session and returns a DataFrame for each silver table that is to be written (names of SILVER)."""

import argparse
from collections.abc import Callable, Mapping
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waymark import schema as S
from waymark.operators import cascade, metrics
from waymark.plans import pipelines
from waymark.sources import io

_PLACES = ", ".join(f"{c} string" for c in S.LOCATION_COLS)
#: Columns of the silver tables. Tables of other columns are brought to these: what is missing is null, what is more is left.
SILVER = {
    "observations": f"_ord long, priority int, source string, site_id string, site_name string, latitude double, longitude double, _was_swapped boolean, {_PLACES}",
    "history": "_ord long, canonical_id string, " + ", ".join(f"{c} string" for c in (*S.SCHOOL_YEARS, "old_school_id", "`old_school_id.1`", "legacy_id")),
    "enrolment": f"_ord long, site_id string, site_name string, sector string, {_PLACES}, old_region string, " + ", ".join(f"{c} string" for c in S.ENROLMENT_COLS),
    "codes": "site_id string, claimed_adm3 string, code_name string",
    "polygons": f"polygon_ord int, adm1 string, adm2 string, adm2_name string, adm3 string, adm4 string, rings {S.RING_TYPE}",
    "universe": "site_id string, site_name string, region string, municipality string, sector string",
    "submissions": "_ord long, site_id string, latitude double, longitude double, municipality string",
    "programs": "_ord long, code string, name string, sector string, program_level string, region string, province string, city_municipality string, latitude double, longitude double",
}


def write_silver(spark: SparkSession, root: str, sources: Mapping[str, DataFrame]) -> None:
    for name, df in sources.items():
        io.write_silver(io.conform(df, StructType.fromDDL(SILVER[name])), f"{root}/silver", name)


def write_gold(spark: SparkSession, root: str) -> list[str]:
    """Runs each pipeline whose tables are there and writes its rows and metrics. Returns their names."""

    def tables(*names: str) -> list[DataFrame] | None:
        found = [io.read_optional(spark, f"{root}/silver", n) for n in names]
        return None if any(t is None for t in found) else found

    done = []
    if (t := tables("observations", "history", "enrolment", "polygons", "codes")) is not None:
        parts: dict[str, DataFrame] = {}
        rows = pipelines.multi_source(*t, parts=parts)
        done.append(_publish(rows, f"{root}/gold/public", ["site_id"], lambda df: metrics.public_metrics(df, parts["crosswalk"])))
        apart = cascade.discrepancy_counts(parts["sources"]).select(F.lit("apart").alias("metric"), F.concat_ws("|", "source_a", "source_b").alias("key"), F.col("n").alias("value"))
        io.write_metrics(metrics.changes_as_metrics(parts["changes"]).unionByName(apart), f"{root}/gold/public-changes")
    if (t := tables("universe", "submissions", "enrolment", "polygons", "codes")) is not None:
        done.append(_publish(pipelines.self_reported(*t), f"{root}/gold/private", ["site_id"], metrics.private_metrics))
    if (t := tables("programs", "polygons")) is not None:
        done.append(_publish(pipelines.institutions(*t), f"{root}/gold/institutions", ["region", "name"], lambda df: metrics.institution_metrics(df, t[0])))
    return done


def _publish(df: DataFrame, path: str, key: list[str], measure: Callable[[DataFrame], DataFrame]) -> str:
    """Written once; the metrics are those of what was written."""
    io.write_gold(df, path, df.columns, key)
    io.write_metrics(measure(io.read_published(df.sparkSession, path)), f"{path}-metrics")
    return path.rpartition("/")[2]


def build(spark: SparkSession, root: str, stage: str = "all", sources: Mapping[str, DataFrame] | None = None) -> list[str]:
    if stage not in ("silver", "gold", "all"):
        raise ValueError(f"{stage} is no stage")
    if stage != "gold":
        write_silver(spark, root, sources or {})
    return write_gold(spark, root) if stage != "silver" else []


def main() -> None:
    args = argparse.ArgumentParser(description="Builds silver and gold tables.")
    args.add_argument("--root", required=True)
    args.add_argument("--stage", choices=("silver", "gold", "all"), default="all")
    args.add_argument("--sources", help="module:function that gives the silver tables")
    given = args.parse_args()
    spark = SparkSession.builder.appName("waymark").getOrCreate()
    sources = None
    if given.sources:
        module, _, name = given.sources.partition(":")
        sources = getattr(import_module(module), name)(spark)
    print(*build(spark, given.root, given.stage, sources))


if __name__ == "__main__":
    main()
