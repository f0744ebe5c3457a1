"""One row per key. All are aggregates with partial sums (min_by, max_by of a row), so a key of any number of rows is no burden on one task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.cleaning import has_valid_coords, is_blank


def _best(df: DataFrame, keys: Sequence[str], order: Column, last: bool = False) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    pick = F.max_by(row, order) if last else F.min_by(row, order)
    named = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]
    return df.groupBy(*named).agg(pick.alias("__row")).select("__row.*")


def keep_first(df: DataFrame, keys: Sequence[str], order: str = "_ord") -> DataFrame:
    """The first row of each key in the order of arrival; null keys are one key."""
    return _best(df, keys, F.col(order))


def keep_last(df: DataFrame, keys: Sequence[str], order: str = "_ord") -> DataFrame:
    return _best(df, keys, F.col(order), last=True)


def consolidate(df: DataFrame, key: str = "site_id", name: str = "site_name", order: str = "_ord", by: Sequence[str] = ()) -> DataFrame:
    """After a remap: of the rows of a key (and of the columns by, as the source) one with coordinates, then one with a name, then the first."""
    placed = [~has_valid_coords("latitude", "longitude")] if "latitude" in df.columns else []
    return _best(df, [*by, key], F.struct(*placed, is_blank(name), F.col(order)))


def mark_merged(df: DataFrame, key: str = "site_id", name: str = "site_name", order: str = "_ord", by: Sequence[str] = ()) -> DataFrame:
    """df with _merged, true for the rows that consolidate would drop; order doesn't repeat within a source."""
    stays = consolidate(df, key, name, order, by).select(*by, key, F.col(order).alias("__stays"))
    return df.join(stays, [*by, key], "left").withColumn("_merged", F.coalesce(F.col(order) != F.col("__stays"), F.lit(False))).select(*df.columns, "_merged")


def merged_count(before: DataFrame, key: str = "site_id") -> DataFrame:
    """merged: rows beyond one per key."""
    return before.groupBy(key).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("merged"))


def identity_first(crosswalk: DataFrame, order: str = "_ord") -> DataFrame:
    """One canonical ID per historical one: itself if it maps to itself, else the first given."""
    return _best(crosswalk, ["historical_id"], F.struct(F.col("historical_id") != F.col("canonical_id"), F.col(order)))


def distinct_pairs(crosswalk: DataFrame, order: str = "_ord") -> DataFrame:
    """Of equal (historical, canonical) pairs the first."""
    return _best(crosswalk, ["historical_id", "canonical_id"], F.col(order))


def pick_polygon(hits: DataFrame, key: str = "point_id", claimed: str | None = "claimed_adm3") -> DataFrame:
    """Of several polygons hit by a point, one of the claimed unit, else the first."""
    order = F.col("polygon_ord")
    return _best(hits, [key], F.struct(F.coalesce(F.col("adm3") != F.col(claimed), F.lit(True)), order) if claimed else order)
